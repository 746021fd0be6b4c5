"""The batch job: listing and catalogue files in; parsed inputs, results, labelling sample and run summary out.

publish() writes a run into a folder of its own and makes it the current one in a single step, so readers see all outputs of
one run or all of another. Parsed inputs and results are in the same buckets of files.ROW, the place of a listing in its
file: they join without a shuffle, and listings of one id, or of none, stay apart.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.rules import DEFAULT, Rules
from tallyspark.operators import catalog as cat
from tallyspark.operators import labels as lab
from tallyspark.operators import listings as ops
from tallyspark.operators import review
from tallyspark.sources import commits, files, records, stage
from tallyspark.sources.stage import staged

PARSED = (*files.LISTING_COLUMNS, *cat.FIELDS, "keepa_present")
# The generated columns in their order.
RESULTS = (
    "is_pure_bath_bomb", "exclude_reason", "needs_review", "purity_source",
    *(f"cand_{c}{x}" for c in ("title", "size", "bullets", "description") for x in ("", "_pattern")),
    "cand_number_of_items", "cand_keepa_number_of_items", "cand_keepa_package_qty", "cand_unit_num", "cand_label_unit_num", "n_bomb_balls", "count_confidence",
    "count_source", "count_unable", "count_conflict", "seller_counts_pack_as_one",
)


BUCKET_BYTES = 64 << 20
PIECE_BYTES = 2 << 20


@dataclass(frozen=True)
class Outputs:
    """Where the job writes; no sample without a path for it. buckets: of parsed and results, unless they are plain files."""

    parsed: str
    results: str
    sample: str | None = None
    buckets: int | None = None


def summary(scored: DataFrame) -> DataFrame:
    """(class_label, listings, matched): all listings by class, and how many of them the catalogue knows."""
    return scored.groupBy(ops.class_label().alias("class_label")).agg(F.count("*").alias("listings"), F.count_if("keepa_present").alias("matched"))


def run(
    spark: SparkSession, listings: str, catalog: str | None, out: Outputs, rules: Rules = DEFAULT, sample_size: int = 300, seed: int = 42
) -> DataFrame:
    """Writes the outputs and returns the run's summary. A catalogue that is absent leaves its fields null; rows of one id
    stay apart. The scored rows are written once to the shared folder, so results, sample and summary score nothing again."""
    parsed = cat.attach(files.read_listings(spark, listings, numbered=out.buckets is not None), files.read_catalog(spark, catalog))
    if out.buckets is None:
        files.write_parquet(parsed, out.parsed, PARSED)
        scored = staged(ops.score(spark.read.parquet(out.parsed), rules), "scored")
        files.write_parquet(scored, out.results, ("asin", *RESULTS))
    else:
        pieces = pieces_for(spark, files.newest_csv(spark, listings))
        # As a multiple of the buckets, rows dealt by the same hash are of one bucket in each piece; a piece is a file.
        dealt = parsed.select(*PARSED, files.ROW).repartition(out.buckets * -(-pieces // out.buckets), files.ROW)
        files.write_buckets(dealt, out.parsed, out.buckets)
        # Scored piece by piece, so results fall into the same buckets as they are; a task takes several small pieces.
        table, by_file = f"{out.results}-scored", records.pinned(spark, BUCKET_BYTES)
        whole = files.read_buckets(by_file, out.parsed, out.buckets).coalesce(max(pieces, spark.sparkContext.defaultParallelism))
        files.write_buckets(ops.score(whole, rules), table, out.buckets)
        scored = files.read_buckets(spark, table, out.buckets)
        files.write_buckets(scored.select("asin", *RESULTS, files.ROW), out.results, out.buckets)
        scored = scored.drop(files.ROW)
    if out.sample is not None:
        files.write_csv(lab.projected(lab.labeling_sample(review.with_labels(scored), sample_size, seed)), out.sample)
    return summary(scored)


def buckets_for(spark: SparkSession, path: str) -> int:
    """One for each BUCKET_BYTES of the file, and no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-commits.size(spark, path) // BUCKET_BYTES))


def pieces_for(spark: SparkSession, path: str) -> int:
    """One for each PIECE_BYTES of the file, so that the tasks that score grow with it, however few the buckets."""
    return max(1, -(-commits.size(spark, path) // PIECE_BYTES))


def publish(
    spark: SparkSession, listings: str, catalog: str | None, top: str, rules: Rules = DEFAULT, sample_size: int = 300, seed: int = 42
) -> Outputs:
    """A run in a new folder under top, which becomes the current one when all of it is written; what fails before leaves the old one."""
    at, mark = f"{top}/run-{uuid.uuid4().hex}", stage.mark()
    out = Outputs(f"{at}/parsed", f"{at}/results", f"{at}/sample", buckets_for(spark, files.newest_csv(spark, listings)))
    files.write_parquet(run(spark, listings, catalog, out, rules, sample_size, seed), f"{at}/summary")
    commits.remove(spark, f"{out.results}-scored")
    stage.release(spark, mark)
    lines = [at.rsplit("/", 1)[1], str(out.buckets)]
    while not commits.put(spark, top, commits.version(spark, top) + 1, lines):
        pass  # another run was published meanwhile; the later one is current
    return out


def latest(spark: SparkSession, top: str) -> Outputs | None:
    """The outputs of the current run; None if there is none."""
    lines = commits.read(spark, top)
    if not lines:
        return None
    at = f"{top}/{lines[0]}"
    return Outputs(f"{at}/parsed", f"{at}/results", f"{at}/sample", int(lines[1]))


def read_run(spark: SparkSession, top: str) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """(parsed, results, summary) of the current run."""
    out = latest(spark, top)
    if out is None:
        return None
    parsed, results = (files.read_buckets(spark, p, out.buckets) for p in (out.parsed, out.results))
    return parsed, results, spark.read.parquet(f"{out.parsed.removesuffix('/parsed')}/summary")


def full_view(spark: SparkSession, top: str) -> DataFrame | None:
    """Every listing of the current run with its results."""
    found = read_run(spark, top)
    return found and review.recombine(found[0], found[1]).drop(files.ROW)


def clear(spark: SparkSession, top: str, keep: int = 2) -> list[str]:
    """Removes the folders of runs that are neither among the newest ones nor being written; for times without a running job."""
    live = set(commits.forget(spark, top, keep))
    gone = [n for n in commits.names(spark, top) if n.startswith("run-") and n not in live]
    for n in gone:
        commits.remove(spark, f"{top}/{n}")
    return gone
