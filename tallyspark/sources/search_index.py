"""Text search over a written queue by trigrams.

The queue is written in blocks of rows, each a file or pages of one, beside a table of postings (trigram, block, row) of the
lower-cased ids and titles and a table of how often each trigram occurs. A regular expression that needs certain literal
texts can only match rows that hold their trigrams, so the rarest of these are looked up, and the blocks with such rows are read;
the expression itself decides among them. An expression that needs no text of three characters is searched for in all blocks.

Postings lie in PARTS folders by a hash of the trigram, in its order, so a lookup reads few files; a common trigram's
are dealt to several tasks. Defined results: null ids and titles match nothing; repeated rows are found each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = 64
BLOCK_ROWS = 20_000
TASK_ROWS = 50_000
MAX_FILES = 512  # of the queue, or a few for each task; blocks within a file are pages that are skipped by their numbers
RAREST = 3
FULL_SHARE = 0.5  # of the blocks; from there on all are read

_parse, _ops = re._parser, re._constants


def needed(pattern: str) -> list[list[str]] | None:
    """For each way an expression can match, texts that every match holds; None if the expression is not understood."""
    try:
        return _ways(_parse.parse(pattern))
    except (re.error, RecursionError, OverflowError):
        return None


def _ways(items) -> list[list[str]]:  # noqa: ANN001
    """Ways of a sequence: of its branches one is matched, all else is matched by each way."""
    ways: list[list[str]] = [[]]
    run = ""

    def cut(also: list[list[str]] | None = None) -> None:
        nonlocal run, ways
        ways = [[*w, *([run] if run else []), *a] for w in ways for a in (also or [[]])]
        run = ""

    for op, value in items:
        if op is _ops.LITERAL:
            run += chr(value)
        elif op is _ops.SUBPATTERN:
            cut(_ways(value[3]))
        elif op in (_ops.MAX_REPEAT, _ops.MIN_REPEAT, _ops.POSSESSIVE_REPEAT):
            cut(_ways(value[2]) if value[0] >= 1 else None)
        elif op is _ops.ATOMIC_GROUP:
            cut(_ways(value))
        elif op is _ops.BRANCH:
            cut(list(chain.from_iterable(_ways(x) for x in value[1])))
        else:
            cut()
        if len(ways) > 64:
            raise OverflowError
    cut()
    return ways


def trigrams(text: str) -> list[str]:
    return sorted({text[i : i + 3] for i in range(len(text) - 2)})


def trigram_array(text: Column) -> Column:
    """The distinct trigrams of a text."""
    chars = F.split(text, "")
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(chars) - 3), lambda i: F.array_join(F.slice(chars, i + 1, F.lit(3)), "")))


def search(queue: DataFrame, word: str) -> DataFrame:
    """The rows whose id or title matches a lower-case expression: a scan."""
    return queue.filter(F.coalesce(F.lower("asin").rlike(word), F.lit(False)) | F.coalesce(F.lower("title").rlike(word), F.lit(False)))


@dataclass(frozen=True)
class Index:
    """A written queue with its postings; see build and find."""

    spark: SparkSession
    top: str

    def queue(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.top}/queue")

    def candidates(self, word: str) -> DataFrame | None:
        """(block, row) of the rows that hold the trigrams needed; None if all rows may match."""
        ways = needed(word)
        wanted = [sorted({t for run in w for t in trigrams(run)}) for w in ways or []]
        if not wanted or not all(wanted):
            return None
        every = sorted(set(chain.from_iterable(wanted)))
        counts = {r["tri"]: r["n"] for r in self.spark.read.parquet(f"{self.top}/counts").filter(F.col("tri").isin(every)).collect()}
        rarest = [sorted(w, key=lambda t: (counts.get(t, 0), t))[:RAREST] for w in wanted if all(t in counts for t in w)]
        postings = self.spark.read.parquet(f"{self.top}/postings")
        out = postings.select("block", "row").limit(0)
        for way in rarest:
            parts = self.spark.range(1).select(*[_part(F.lit(t)).alias(f"p{i}") for i, t in enumerate(way)]).first()
            rows = postings.filter(F.col("part").isin(list(parts)) & F.col("tri").isin(way))
            out = out.unionByName(rows.groupBy("block", "row").agg(F.count("*").alias("n")).filter(F.col("n") == len(way)).select("block", "row"))
        return out.distinct()

    def find(self, search_word: str) -> DataFrame:
        """The rows of the queue that match, as a scan of it would give them."""
        word, queue = search_word.strip().lower(), self.queue()
        hidden = queue.drop("_block", "_at")
        if not word:
            return hidden
        found = self.candidates(word)
        if found is None:
            return search(hidden, word)
        blocks = [r["block"] for r in found.select("block").distinct().collect()]  # a number for each block of rows
        total = self.spark.read.parquet(f"{self.top}/blocks").first()["n"]
        if len(blocks) >= max(2, FULL_SHARE * total):
            return search(hidden, word)
        return search(queue.filter(F.col("_block").isin(blocks)), word).drop("_block", "_at")


def _part(tri: Column) -> Column:
    return F.pmod(F.xxhash64(tri), F.lit(PARTS)).cast("int")


def build(queue: DataFrame, top: str, block_rows: int = BLOCK_ROWS) -> Index:
    """Writes a queue (asin, title and any other columns) and its index under top. Rows with like titles get near each other, so a
    search meets few blocks.

    Rows are dealt to tasks by ranges of titles, TASK_ROWS each, and cut into blocks there, so that what is sampled for the ranges and
    what tasks report do not grow with the number of blocks. A block's number is the place of its first row.
    """
    spark = queue.sparkSession
    count = queue.count()
    tasks = max(1, -(-count // max(TASK_ROWS, block_rows)))
    dealt = queue.repartitionByRange(tasks, F.col("title"), F.col("asin")) if tasks > 1 else queue.coalesce(1)
    numbered = dealt.sortWithinPartitions("title", "asin").withColumn("_at", F.monotonically_increasing_id())
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))  # the rest is the task
    blocked = numbered.withColumn("_block", F.col("_at") - F.pmod(within, F.lit(block_rows)))
    blocks = -(-count // block_rows)
    at_most = block_rows * max(1, blocks // MAX_FILES)
    blocked.write.option("maxRecordsPerFile", at_most).option("parquet.page.row.count.limit", block_rows).parquet(f"{top}/queue")
    rows = spark.read.parquet(f"{top}/queue").select(F.col("_block").alias("block"), F.col("_at").alias("row"), F.lower("asin").alias("a"), F.lower("title").alias("t"))
    of = lambda c: F.when(F.length(c) >= 3, trigram_array(F.col(c))).otherwise(F.array().cast("array<string>"))
    each = rows.select("block", "row", F.explode(F.array_union(of("a"), of("t"))).alias("tri")).withColumn("part", _part(F.col("tri")))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tasks)
    each.repartitionByRange(n, "part", "tri", "block").sortWithinPartitions("part", "tri", "block").write.partitionBy("part").parquet(f"{top}/postings")
    counts = spark.read.parquet(f"{top}/postings").groupBy("tri").agg(F.count("*").alias("n"))
    counts.repartitionByRange(max(1, n // 8), "tri").sortWithinPartitions("tri").write.parquet(f"{top}/counts")
    spark.read.parquet(f"{top}/queue").agg(F.count_distinct("_block").alias("n")).write.parquet(f"{top}/blocks")
    return Index(spark, top)
