"""Registered queries over listings derived from the part table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import catalog as cat
from tallyspark.operators import listings as ops
from tallyspark.sources import fixtures

RESULTS = ["n_bomb_balls", "count_confidence", "count_source", "count_unable", "count_conflict", "needs_review", "seller_counts_pack_as_one"]


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.attach(fixtures.listings(spark, sf_dir), fixtures.catalog(spark, sf_dir))


def parsed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).select("asin", "title", *cat.FIELDS, "keepa_present")


def parsed_no_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.attach(fixtures.listings(spark, sf_dir), None).select("asin", "title", "keepa_title", "keepa_image_count", "keepa_present")


def catalog_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.latest(fixtures.catalog(spark, sf_dir)).select("asin", "pos", F.col("numberOfItems").alias("number_of_items"))


def purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.purity(parsed(spark, sf_dir)).select("asin", "is_pure_bath_bomb", "exclude_reason", "purity_source")


def class_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.purity(parsed(spark, sf_dir)).select("asin", ops.class_label().alias("class_label"))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ops.purity(parsed(spark, sf_dir))
    return found.groupBy(ops.class_label().alias("class_label")).agg(F.count("*").alias("listings"), F.count_if("keepa_present").alias("matched"))


def count_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ops.count_candidates(parsed(spark, sf_dir))
    return found.select("asin", *[c for c in found.columns if c.startswith("cand_")])


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ops.score(parsed(spark, sf_dir))
    cands = [c for c in found.columns if c.startswith("cand_")]
    return found.select("asin", "is_pure_bath_bomb", "exclude_reason", "purity_source", *cands, *RESULTS)


def count_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.score(parsed(spark, sf_dir)).select("asin", ops.count_label().alias("count_label"))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.quality_report(ops.score(parsed(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (parsed_listings, parsed_no_catalog, catalog_latest, purity, class_labels, run_summary, count_candidates, results, count_labels, quality_report)
}

_WORDS = r"""
WITH l AS (%s), c AS (%s),
last AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY asin ORDER BY pos DESC) = 1),
t AS (SELECT l.asin, k.asin IS NOT NULL AS present,
  lower(coalesce(nullif(l.title, ''), CASE WHEN lower(trim(k.title)) NOT IN ('', 'nan') THEN trim(k.title) END, '')) AS t FROM l LEFT JOIN last k ON l.asin = k.asin),
-- Phrases that a guard exempts are blanked out first; positions come from a prefix that ends before the first hit.
g AS (SELECT asin, present, t, regexp_replace(regexp_replace(regexp_replace(t, 'soaps?\s*-?\s*free', 'x', 'g'), 'soaps?\s*&?\s*co(mpany|\.|\b)', 'x', 'g'), 'bubble bath\s+bombs?', 'x', 'g') AS u FROM t),
f AS (SELECT asin, present,
  nullif(regexp_extract(t, '(?s)^(.*?)(\bbath bombs?\b|\bbath fizz(y|ies|er|ers)?\b|\bbath bursts?\b|\bbath blasters?\b|\bshower bombs?\b|\baromabombs?\b)', 2), '') IS NOT NULL AS target,
  length(regexp_extract(t, '(?s)^(.*?)(\bbath bombs?\b|\bbath fizz(y|ies|er|ers)?\b|\bbath bursts?\b|\bbath blasters?\b|\bshower bombs?\b|\baromabombs?\b)', 1)) AS pos0,
  regexp_matches(t, '\b(craft kit|diy|make[- ]your[- ]own|making kit|moulds?|molds?|book\s*&\s*kit)\b') AS kit,
  regexp_matches(u, '\b(soaps?|candles?|lotions?|shampoos?|body butters?|bath creamers?|body wash|shower gel|conditioners?|diffusers?|pedicure|bubble bath|cauldrons?|necklaces?|rings?|toys?)\b')
    OR (regexp_matches(t, '\bsurprise\b') AND regexp_matches(t, '\b(in|inside|hidden)\b')) AS bundle,
  regexp_matches(t, '\b(bath salts?|bath powder|bath beads?|shower (steamer|melt|tablet|disc|fizzy|fizzies|fizzers?)s?|bath melts?|tablets?|bath drops?)\b') AS sub,
  length(regexp_extract(t, '(?s)^(.*?)\b(bath salts?|bath powder|bath beads?|shower (steamer|melt|tablet|disc|fizzy|fizzies|fizzers?)s?|bath melts?|(fizz )?tablets?|bath drops?)\b', 1)) AS sub_at,
  regexp_matches(t, '\b(citric acid|baking soda)\b') AS ing, length(regexp_extract(t, '(?s)^(.*?)\b(citric acid|baking soda)\b', 1)) AS ing_at
  FROM g),
r AS (SELECT asin, present, CASE WHEN NOT target THEN 0 WHEN kit THEN 1 WHEN bundle THEN 2 WHEN sub AND sub_at < pos0 THEN 3 WHEN ing AND ing_at < pos0 THEN 4 ELSE 5 END AS rule FROM f)
""" % (fixtures.LISTINGS, fixtures.CATALOG)
_REASON = "['no-bath-bomb', 'craft_kit', 'bundle', 'substitute', 'ingredients', NULL][rule + 1]"

SQL: dict[str, str] = {
    "purity": _WORDS + f"SELECT asin, rule = 5 AS is_pure_bath_bomb, {_REASON} AS exclude_reason, ['rule_no_bomb', 'rule_craft_kit', 'rule_bundle', 'rule_substitute', 'rule_ingredient', 'rule_positive'][rule + 1] AS purity_source FROM r",
    "class_labels": _WORDS + f"SELECT asin, coalesce({_REASON}, 'pure') AS class_label FROM r",
    "run_summary": _WORDS + f"SELECT coalesce({_REASON}, 'pure') AS class_label, count(*) AS listings, count(*) FILTER (present) AS matched FROM r GROUP BY 1",
    "catalog_latest": f"WITH c AS ({fixtures.CATALOG}) SELECT asin, pos, \"numberOfItems\" AS number_of_items FROM c QUALIFY row_number() OVER (PARTITION BY asin ORDER BY pos DESC) = 1",
    "parsed_no_catalog": f"SELECT asin, title, CAST(NULL AS VARCHAR) AS keepa_title, CAST(NULL AS INTEGER) AS keepa_image_count, FALSE AS keepa_present FROM ({fixtures.LISTINGS})",
}
