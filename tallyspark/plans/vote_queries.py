"""Registered queries of word positions, single votes, the weighted vote and its confidence; and their SQL.

The vote's queries read counts derived from part, so that SQL can hold every rule of the vote against many mixtures of
nulls, ones, ties and conflicts; `results` runs the same operator over parsed listings. Its SQL runs the patterns over the
texts with another engine and votes on what they give.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import listings as ops
from tallyspark.plans.detail_queries import _HITS
from tallyspark.plans.queries import _REASON, _WORDS, parsed
from tallyspark.sources import fixtures


def lexicon_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ops.lexicon_hits(parsed(spark, sf_dir))
    return found.select("asin", "target_at", (F.col("kit_at") > 0).alias("has_kit"), "substitute_at", "ingredient_at")


def votes_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fixtures.reports(spark, sf_dir).select("asin", F.explode(ops.votes()).alias("v"))
    return found.select("asin", "v.source", "v.ord", "v.n", (F.col("v.n") > 1).alias("multi"))


def consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.consensus(fixtures.reports(spark, sf_dir)).select("asin", "n_bomb_balls", "count_source", "count_conflict", "needs_review")


def confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.consensus(fixtures.reports(spark, sf_dir)).select("asin", "count_confidence", "seller_counts_pack_as_one")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (lexicon_hits, votes_long, consensus, confidence)}

# Weight, whether it is text, and base level (0 low to 2 high) of each source, in voting order.
_SOURCES = {
    "title": (5, True, 2), "bullets": (3, True, 2), "size": (2, True, 1), "description": (3, True, 1), "number_of_items": (2, False, 1),
    "keepa_number_of_items": (2, False, 1), "keepa_package_quantity": (1, False, 0), "label_unit_num": (1, False, 0), "unit_num": (1, False, 0),
}
_LONG = " UNION ALL ".join(
    f"SELECT asin, '{s}' AS source, {i} AS ord, {w} AS w, {t} AS txt, {b} AS base, {'cand_keepa_package_qty' if s == 'keepa_package_quantity' else 'cand_' + s} AS n FROM k"
    for i, (s, (w, t, b)) in enumerate(_SOURCES.items())
)
_VOTE = f"""
WITH k AS ({fixtures.REPORTS}), v AS (SELECT * FROM ({_LONG}) x WHERE n IS NOT NULL),
tally AS (SELECT asin, n, sum(w) AS w, bool_or(txt) AS txt, count(*) AS backers FROM v WHERE n > 1 GROUP BY asin, n),
win AS (SELECT * FROM tally QUALIFY row_number() OVER (PARTITION BY asin ORDER BY w DESC, txt DESC, n DESC) = 1),
rival AS (SELECT t.asin, max(t.w) AS w FROM tally t JOIN win ON t.asin = win.asin AND t.n <> win.n GROUP BY t.asin),
lead AS (SELECT v.* FROM v JOIN win ON v.asin = win.asin AND v.n = win.n QUALIFY row_number() OVER (PARTITION BY v.asin ORDER BY v.w DESC, v.ord) = 1),
one AS (SELECT asin, bool_or(source IN ('title', 'bullets', 'size', 'number_of_items')) AS firm,
  bool_or(source IN ('number_of_items', 'keepa_number_of_items', 'keepa_package_quantity', 'unit_num')) AS listed FROM v WHERE n = 1 GROUP BY asin),
many AS (SELECT asin, bool_or(txt) AS txt FROM v WHERE n > 1 GROUP BY asin),
r AS (SELECT k.asin, k.is_pure_bath_bomb AS pure, win.n, win.txt, win.backers, lead.source, lead.w AS best, lead.base, rival.w IS NOT NULL AS conflict,
  coalesce(win.w < 2 * rival.w, FALSE) AS weak, one.asin IS NOT NULL AS single, coalesce(one.firm, FALSE) AS firm,
  coalesce(one.listed, FALSE) AND coalesce(many.txt, FALSE) AS seller
  FROM k LEFT JOIN win ON k.asin = win.asin LEFT JOIN lead ON k.asin = lead.asin LEFT JOIN rival ON k.asin = rival.asin
  LEFT JOIN one ON k.asin = one.asin LEFT JOIN many ON k.asin = many.asin),
lv AS (SELECT *, CASE WHEN weak THEN 0 WHEN backers >= 2 THEN least(2, base + 1) WHEN best <= 1 THEN greatest(0, base - 1) ELSE base END AS lvl FROM r)
"""

_BEST = ", ".join(f"CAST(CASE WHEN {c}.n <= 1000 THEN {c}.n END AS INTEGER) AS cand_{c}, CASE WHEN {c}.n <= 1000 THEN {c}.tag END AS cand_{c}_pattern" for c in ("title", "size", "bullets", "description"))
_CANDIDATES = _HITS.rstrip() + f""", p AS (SELECT concat('B', lpad(CAST(p_partkey AS VARCHAR(20)), 9, '0')) AS asin, p_partkey AS k, p_size AS s, p_partkey % 11 <> 0 AS matched FROM part)
SELECT p.asin, {_BEST},
  CAST(CASE k % 6 WHEN 0 THEN 1 WHEN 1 THEN s WHEN 2 THEN 2 END AS INTEGER) AS cand_number_of_items,
  CAST(CASE WHEN matched AND s % 5 - 1 + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END > 0 THEN s % 5 - 1 + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END END AS INTEGER) AS cand_keepa_number_of_items,
  CAST(CASE WHEN matched THEN nullif(s % 4, 0) END AS INTEGER) AS cand_keepa_package_qty, CAST(CASE WHEN k % 3 = 0 THEN s END AS INTEGER) AS cand_unit_num,
  CAST(CASE WHEN k % 4 = 0 THEN nullif(s % 9, 0) END AS INTEGER) AS cand_label_unit_num
FROM p {" ".join(f"LEFT JOIN h AS {c} ON {c}.asin = p.asin AND {c}.field = '{c}' AND {c}.best" for c in ("title", "size", "bullets", "description"))}"""
_VERDICTS = _WORDS + f"""SELECT asin, rule = 5 AS is_pure_bath_bomb, {_REASON} AS exclude_reason,
  ['rule_no_bomb', 'rule_craft_kit', 'rule_bundle', 'rule_substitute', 'rule_ingredient', 'rule_positive'][rule + 1] AS purity_source FROM r"""
_COUNT = "CASE WHEN pure THEN coalesce(n, 1) END"
_CONFIDENCE = """CASE WHEN NOT pure THEN 'n/a' WHEN n IS NOT NULL THEN ['low', 'medium', 'high'][1 + CASE WHEN lvl = 2 AND NOT txt THEN 1 ELSE lvl END]
  WHEN firm THEN 'medium' ELSE 'low' END"""
_REVIEW = "pure AND CASE WHEN n IS NOT NULL THEN weak ELSE NOT firm END"
_BY = "CASE WHEN pure THEN CASE WHEN n IS NOT NULL THEN source WHEN single THEN 'single_default' ELSE 'assumed_single' END END"
_SCORED = _VOTE.replace(fixtures.REPORTS, f"SELECT q.*, c.* EXCLUDE (asin) FROM ({_VERDICTS}) q JOIN ({_CANDIDATES}) c ON q.asin = c.asin")

_EVIDENCE = " UNION ALL ".join(
    f"SELECT asin, '{f}' AS field, cand_{f} AS count, coalesce({f'cand_{f}_pattern' if i < 4 else 'NULL'}, '') AS pattern FROM c WHERE cand_{f} IS NOT NULL"
    for i, f in enumerate(("title", "bullets", "size", "description", "number_of_items", "keepa_number_of_items", "keepa_package_qty", "label_unit_num", "unit_num"))
)

SQL: dict[str, str] = {
    "evidence_long": f"WITH c AS ({_CANDIDATES}) {_EVIDENCE}",
    "title_highlight": f"""WITH c AS ({_CANDIDATES}), l AS ({fixtures.LISTINGS}) SELECT l.asin, CASE WHEN cand_title IS NULL THEN title
  ELSE regexp_replace(title, '(^|[^0-9])(' || cand_title || ')([^0-9]|$)', '\\1**\\2**\\3') END AS title FROM l JOIN c ON l.asin = c.asin""",
    "review_queue": _SCORED + f"""SELECT asin, 'pure' AS class_label, CASE WHEN seller THEN 'pack_as_one' WHEN coalesce(n, 1) >= 50 THEN 'extreme_count' WHEN n > 1 THEN 'multi_pack' ELSE 'single' END AS count_label,
  'low' AS count_confidence FROM lv WHERE {_REVIEW} AND {_CONFIDENCE} = 'low'""",
    "count_candidates": _CANDIDATES,
    "results": _SCORED + f"""SELECT k.*, {_COUNT} AS n_bomb_balls, {_CONFIDENCE} AS count_confidence, {_BY} AS count_source, FALSE AS count_unable,
  pure AND conflict AS count_conflict, {_REVIEW} AS needs_review, seller AS seller_counts_pack_as_one FROM lv JOIN k ON lv.asin = k.asin""",
    "count_labels": _SCORED + """SELECT asin, CASE WHEN NOT pure THEN 'n/a' WHEN seller THEN 'pack_as_one' WHEN coalesce(n, 1) >= 50 THEN 'extreme_count' WHEN n > 1 THEN 'multi_pack' ELSE 'single' END AS count_label FROM lv""",
    "quality_report": _SCORED + f""", f AS (SELECT 'class' AS facet, CASE WHEN pure THEN 'pure' ELSE coalesce(k.exclude_reason, 'no-bath-bomb') END AS value FROM lv JOIN k ON lv.asin = k.asin
  UNION ALL SELECT 'confidence', {_CONFIDENCE} FROM lv WHERE pure UNION ALL SELECT 'conflict', 'true' FROM lv WHERE pure AND conflict UNION ALL SELECT 'review', 'true' FROM lv WHERE {_REVIEW})
SELECT facet, value, count(*) AS listings, count(*) / CAST(CASE WHEN facet = 'class' THEN (SELECT count(*) FROM lv) ELSE (SELECT count(*) FROM lv WHERE pure) END AS DOUBLE) AS share FROM f GROUP BY facet, value""",
    "lexicon_hits": _WORDS + """SELECT asin, CAST(CASE WHEN target THEN pos0 + 1 ELSE 0 END AS INTEGER) AS target_at, kit AS has_kit,
  CAST(CASE WHEN sub THEN sub_at + 1 ELSE 0 END AS INTEGER) AS substitute_at, CAST(CASE WHEN ing THEN ing_at + 1 ELSE 0 END AS INTEGER) AS ingredient_at FROM f""",
    "votes_long": _VOTE + "SELECT asin, source, ord, n, n > 1 AS multi FROM v",
    "consensus": _VOTE + f"SELECT asin, {_COUNT} AS n_bomb_balls, {_BY} AS count_source, pure AND conflict AS count_conflict, {_REVIEW} AS needs_review FROM r",
    "confidence": _VOTE + f"SELECT asin, {_CONFIDENCE} AS count_confidence, seller AS seller_counts_pack_as_one FROM lv",
}
