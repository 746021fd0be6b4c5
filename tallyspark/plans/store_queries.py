"""Registered queries of files, stores and indexes, and their SQL: each writes what it reads under the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import labels as lab
from tallyspark.operators import listings as ops
from tallyspark.operators import pages
from tallyspark.plans import batch, review_queries, vote_queries
from tallyspark.plans.queries import parsed
from tallyspark.sources import files, fixtures, label_log, records, search_index
from tallyspark.sources.stage import shared_dir

SAMPLE, SEED = review_queries.SAMPLE, review_queries.SEED
SEARCHES = ("case pack 4", "dry shampoo.*ring", "b00000012|soap co")
SPLIT = 16 << 10
COMMITS = 3


def _top(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _listing_files(spark: SparkSession, sf_dir: str, top: str) -> tuple[str, str]:
    raw = fixtures.listings(spark, sf_dir)
    have = {c: F.col(c) if c in raw.columns else F.lit(None).cast("string") for c in files.LISTING_COLUMNS}
    files.write_csv(raw.select(*[c.alias(n) for n, c in have.items()]), f"{top}/listings/2024.csv")
    # The last row of an id wins, so rows go to the file in their order.
    files.write_csv(fixtures.catalog(spark, sf_dir).repartition("asin").sortWithinPartitions("asin", "pos").drop("pos"), f"{top}/catalog/2024.csv")
    return f"{top}/listings", f"{top}/catalog"


def csv_in_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with line breaks and quotes in their fields, written as CSV and read in splits of 16 KB."""
    top = _top(spark, "csv")
    told = F.concat("title", F.lit('\n"'), "brand", F.lit('",\n\nlast line of '), "asin")
    files.write_csv(fixtures.listings(spark, sf_dir).select("asin", told.alias("text"), "size"), f"{top}/listings.csv")
    return records.read_csv(spark, f"{top}/listings.csv", SPLIT).select("asin", "text", "size")


def label_store_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms saved in three commits, with a crash before a fourth is made: the newest labels, read from the log."""
    top, forms = _top(spark, "labels"), review_queries.forms(spark, sf_dir)
    for i in range(COMMITS):
        label_log.append(forms.filter(F.col("seq") % COMMITS == i), top, compact=COMMITS)
    label_log.stage(forms.withColumns({"notes": F.lit("lost"), "ts": F.col("ts") + 1e9}), top, COMMITS + 2)
    return label_log.read(spark, top)


def label_agreement_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The agreement of a label store written as CSV, upserted and read again, with predictions."""
    path, forms = f"{_top(spark, 'store')}/labels.csv", review_queries.forms(spark, sf_dir)
    files.write_labels(lab.latest(forms.filter("seq % 2 = 0")).drop("seq"), path)
    files.write_labels(lab.upsert(files.read_labels(spark, path), forms.filter("seq % 2 = 1")), path)
    store = files.read_labels(spark, path)
    return store.groupBy("class_label", F.coalesce("is_pure_bath_bomb_manual", F.lit("")).alias("verdict"), F.coalesce("exclude_reason_manual", F.lit("")).alias("reason")).agg(
        F.count("*").alias("labels"), F.sum("n_bomb_balls_manual").alias("balls")
    )


def results_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job over listings and catalogue written as CSV files: its results, and whether a row is in its sample."""
    top = _top(spark, "batch")
    out = batch.publish(spark, *_listing_files(spark, sf_dir, top), top, sample_size=SAMPLE, seed=SEED)
    sampled = spark.read.option("header", True).csv(out.sample).select(F.col("asin").alias("_asin"), F.lit(True).alias("_in"))
    found = batch.read_run(spark, top)[1].drop(files.ROW)
    return found.join(sampled, F.col("asin") == F.col("_asin"), "left").select(*found.columns, F.coalesce("_in", F.lit(False)).alias("sampled"))


def run_full_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published run, its two outputs read back and joined by row."""
    top = _top(spark, "runs")
    batch.publish(spark, *_listing_files(spark, sf_dir, top), top, sample_size=SAMPLE, seed=SEED)
    return batch.full_view(spark, top).select("asin", "title", "keepa_present", "is_pure_bath_bomb", "exclude_reason", "purity_source")


def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results of a published run, which a later run that breaks off leaves as they are."""
    top = _top(spark, "runs")
    at = _listing_files(spark, sf_dir, top)
    batch.publish(spark, *at, top, sample_size=SAMPLE, seed=SEED)
    with_more = batch.Outputs(f"{top}/run-broken/parsed", f"{top}/run-broken/results", None, 2)
    batch.run(spark, *at, with_more, sample_size=SAMPLE)  # written as a whole, but never made current
    _, results, _ = batch.read_run(spark, top)
    return results.drop(files.ROW)


def results_only_pure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results with the fast mode; candidates and the seller flag of excluded listings are those of the full mode left out."""
    found = ops.score(parsed(spark, sf_dir), only_pure=True)
    return found.select("asin", "is_pure_bath_bomb", "n_bomb_balls", "count_confidence", "count_source", "count_conflict", "needs_review", "seller_counts_pack_as_one")


def review_search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several searches of a queue with a trigram index."""
    index = search_index.build(parsed(spark, sf_dir).select("asin", "title"), _top(spark, "index"), block_rows=200)
    out = None
    for word in SEARCHES:
        found = index.find(word).select(F.lit(word).alias("word"), "asin", "title")
        out = found if out is None else out.unionByName(found)
    return out


def page_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as snapshots, many to a file, and read back by id, with what the page queries take from them."""
    folder = f"{_top(spark, 'pages')}"
    files.write_pages(fixtures.listing_pages(spark, sf_dir), folder)
    html = F.col("html")
    return files.read_pages(spark, folder).select("asin", F.md5(html).alias("md5"), pages.quick_image(html).alias("image"), pages.quick_price(html).alias("price"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (csv_in_splits, label_store_log, label_agreement_stored, results_from_files, run_full_view, run_results, results_only_pure, review_search_indexed, page_snapshots)
}

_STORED = review_queries._FORMS
SQL: dict[str, str] = {
    "csv_in_splits": f"""SELECT asin, concat(title, chr(10), '"', brand, '",', chr(10), chr(10), 'last line of ', asin) AS text, size
FROM ({fixtures.LISTINGS}) WHERE title IS NOT NULL UNION ALL SELECT asin, NULL, size FROM ({fixtures.LISTINGS}) WHERE title IS NULL""",
    "label_store_log": _STORED + f"""SELECT asin, class_label, is_pure_bath_bomb_manual, n_bomb_balls_manual, exclude_reason_manual, notes, ts FROM forms
QUALIFY row_number() OVER (PARTITION BY asin ORDER BY ts DESC, seq % {COMMITS} DESC, seq DESC) = 1""",
    "label_agreement_stored": _STORED + """, last AS (SELECT * FROM forms QUALIFY row_number() OVER (PARTITION BY asin ORDER BY ts DESC, seq % 2 DESC, seq DESC) = 1)
SELECT class_label, is_pure_bath_bomb_manual AS verdict, exclude_reason_manual AS reason, count(*) AS labels, CAST(sum(n_bomb_balls_manual) AS BIGINT) AS balls FROM last GROUP BY ALL""",
    "results_from_files": f"""SELECT r.*, s.asin IS NOT NULL AS sampled FROM ({vote_queries.SQL["results"]}) r LEFT JOIN ({review_queries._SAMPLE} SELECT asin FROM sample) s ON s.asin = r.asin""",
    # An empty field of a file is a missing one.
    "run_full_view": f"""SELECT asin, nullif(title, '') AS title, keepa_present, is_pure_bath_bomb, exclude_reason, purity_source FROM ({review_queries.SQL["full_view"]})""",
    "run_results": vote_queries.SQL["results"],
    "results_only_pure": f"""SELECT asin, is_pure_bath_bomb, n_bomb_balls, count_confidence, count_source, count_conflict, needs_review,
  seller_counts_pack_as_one AND is_pure_bath_bomb AS seller_counts_pack_as_one FROM ({vote_queries.SQL["results"]})""",
    "review_search_indexed": " UNION ALL ".join(
        f"SELECT '{w}' AS word, asin, title FROM ({fixtures.LISTINGS}) WHERE regexp_matches(lower(asin), '{w}') OR regexp_matches(lower(title), '{w}')" for w in SEARCHES
    ),
    "page_snapshots": f"""WITH p AS ({fixtures.LISTING_PAGES}) SELECT p.asin, md5(html) AS md5, m.image, m.price FROM p JOIN ({review_queries.SQL["page_media"]}) m ON m.asin = p.asin""",
}
