"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.sources.stage import shared_dir

# ASCII white space, as the word definitions of the contracts have it: space and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


# Tables that this process has written to the shared folder, oldest first.
_WRITTEN: list[str] = []


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tally-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def written() -> int:
    """A mark: how many tables materialize has written so far."""
    return len(_WRITTEN)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _WRITTEN.remove(path)


def _held(path: str, files: list[str]) -> bool:
    name = path.rsplit("/", 1)[-1]
    return any(f"/{name}/" in f for f in files)


def release(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Delete the tables written after the mark, but for those that keep is read from; for callers whose results are stored."""
    held = keep.inputFiles() if keep is not None else []
    for path in _WRITTEN[since:]:
        if not _held(path, held):
            _delete(spark, path)


def rewrite(df: DataFrame, old: DataFrame, tag: str) -> DataFrame:
    """df as materialize writes it, in place of old, a table of materialize that nothing else is read from: its files are deleted."""
    new, files = materialize(df, tag), old.inputFiles()
    for path in [p for p in _WRITTEN if _held(p, files)]:
        _delete(df.sparkSession, path)
    return new


def hidden(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of df has, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null and blank texts have none."""
    core = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, SPACE))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, by modulus; a null id counts as learnt from (its row has no place in the split)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@contextmanager
def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """What runs within goes to Python workers in batches of about size bytes, and no smaller than a row, so that a task
    holds little at once; else it is 10,000 rows, however long their texts are."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def task_rows(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partitions so that a task gets about per_task rows, and no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))
