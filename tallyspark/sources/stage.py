"""Written intermediate tables, so that what reads them starts from columns and not from the rules that made them."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a local session without one, as in tests, gets a temporary folder."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top and (given := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        top = given.get()
    if not top:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set; a cluster needs a folder that all executors share")
        top = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", top)
    return top


# Tables that this process has written, oldest first.
_STAGED: list[str] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again. It stays there, as later results are read from it, until it is released."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/listings-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """How many tables are staged by now."""
    return len(_STAGED)


def release(spark: SparkSession, since: int) -> None:
    """Deletes the tables staged after a mark, for a job whose results are stored."""
    for path in _STAGED[since:]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    del _STAGED[since:]
