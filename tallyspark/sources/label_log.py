"""The label store as a log: saving labels costs as much as those labels.

Labels are appended as a segment of their own, and a pointer (see commits) lists the segments that count. A segment that was
written but not committed is not seen, so a crash at any step leaves the old store or the new one. Reading takes the newest
label of each id: by time, then by commit, then by the order within it. When a store has COMPACT segments, an append
also rewrites them as one, of the newest labels alone. Segments that no kept pointer names are removed by vacuum.

Defined results: a store that does not exist is empty. Labels without an id are kept in the log, but have no newest one. An
append of no labels commits an empty segment.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import labels as lab
from tallyspark.sources import commits

SCHEMA = f"{lab.SCHEMA}, seq bigint, commit bigint"
COMPACT = 50
TRIES = 20


def segments(spark: SparkSession, top: str) -> list[str]:
    return commits.read(spark, top)


def history(spark: SparkSession, top: str, parts: list[str] | None = None) -> DataFrame:
    """All labels of the segments, with seq and the number of their commit."""
    parts = segments(spark, top) if parts is None else parts
    return spark.read.schema(SCHEMA).parquet(*[f"{top}/{s}" for s in parts]) if parts else spark.createDataFrame([], SCHEMA)


def _newest(rows: DataFrame) -> DataFrame:
    rest = [c for c in rows.columns if c != "asin"]
    newest = F.max_by(F.struct(*rest), F.struct("ts", "commit", "seq")).alias("_r")
    return rows.filter("asin IS NOT NULL").groupBy("asin").agg(newest).select("asin", "_r.*")


def read(spark: SparkSession, top: str) -> DataFrame:
    """The newest label of each id."""
    return _newest(history(spark, top)).drop("seq", "commit")


def stage(labels: DataFrame, top: str, number: int) -> str:
    """Writes labels as a segment for a commit of that number, and returns its name; nothing sees it yet."""
    columns = [c.split()[0] for c in lab.SCHEMA.split(", ")]
    kinds = dict(c.split() for c in lab.SCHEMA.split(", "))
    seq = F.col("seq").cast("bigint") if "seq" in labels.columns else F.lit(0).cast("bigint")
    name = f"segment-{uuid.uuid4().hex}"
    found = labels.select(*[(F.col(c) if c in labels.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in columns], seq.alias("seq"), F.lit(number).cast("bigint").alias("commit"))
    found.write.parquet(f"{top}/{name}")
    return name


def append(labels: DataFrame, top: str, compact: int = COMPACT) -> int:
    """Adds labels to the store and returns the number of the commit. Another writer in between costs one more try."""
    spark = labels.sparkSession
    for _ in range(TRIES):
        number = commits.version(spark, top) + 1
        name = stage(labels, top, number)
        if commits.put(spark, top, number, [*segments(spark, top), name]):
            if len(segments(spark, top)) >= compact:
                rewrite(spark, top)
            return number
        commits.remove(spark, f"{top}/{name}")
    raise OSError(f"{top} is written by others all the time")


def rewrite(spark: SparkSession, top: str) -> bool:
    """One segment of the newest labels in place of all segments; False if another commit came in between, and nothing is changed."""
    number = commits.version(spark, top)
    old = commits.read(spark, top, number)
    name = f"segment-{uuid.uuid4().hex}"
    _newest(history(spark, top, old)).select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.parquet(f"{top}/{name}")
    done = commits.put(spark, top, number + 1, [name])
    if not done:
        commits.remove(spark, f"{top}/{name}")
    return done


def vacuum(spark: SparkSession, top: str, keep: int = 2) -> list[str]:
    """Removes what only pointers before the newest ones name, and what no commit took up; for times without writers."""
    live = set(commits.forget(spark, top, keep))
    gone = [n for n in commits.names(spark, top) if n.startswith("segment-") and n not in live]
    for n in gone:
        commits.remove(spark, f"{top}/{n}")
    return gone
