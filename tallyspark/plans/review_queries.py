"""Registered queries of labels, review queue and pages, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.rules import CLASS_LABELS
from tallyspark.operators import labels as lab
from tallyspark.operators import listings as ops
from tallyspark.operators import pages, review
from tallyspark.plans import detail_queries, vote_queries
from tallyspark.plans.queries import _REASON, _WORDS, parsed
from tallyspark.sources import fixtures
from tallyspark.sources.stage import staged

SAMPLE, SEED, SEARCH = 300, 42, " Pack of|ct$ "
REASONS = tuple(c for c in CLASS_LABELS if c != "pure")


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored listings, written once: filters and facets over the open rule expressions would repeat them in the plan."""
    return review.with_labels(staged(ops.score(parsed(spark, sf_dir)), "scored"))


def forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lab.submissions_to_labels(fixtures.submissions(spark, sf_dir))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lab.latest(forms(spark, sf_dir))


def labeling_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lab.projected(lab.labeling_sample(queue(spark, sf_dir), SAMPLE, SEED))


def label_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.submissions(spark, sf_dir).select("seq", lab.tri_state(F.col("verdict")).alias("verdict"), lab.whole(F.col("n")).alias("n"))


def label_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forms(spark, sf_dir)


def labels_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir)


def accept_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lab.accept_predictions(queue(spark, sf_dir), 0.0)


def full_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parsed(spark, sf_dir)
    verdicts = ops.purity(rows).select("asin", "is_pure_bath_bomb", "exclude_reason", "purity_source")
    return review.recombine(rows.select("asin", "title", "keepa_present"), verdicts)


def queue_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    classed = ops.purity(parsed(spark, sf_dir)).withColumn("class_label", ops.class_label())
    return review.enrich(lab.labeling_sample(classed, SAMPLE, SEED).select("asin", "class_label"), parsed(spark, sf_dir).select("asin", "brand", "size", "keepa_present"))


def queue_unlabeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.unlabelled(parsed(spark, sf_dir).select("asin", "title"), stored(spark, sf_dir))


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = review.pick(queue(spark, sf_dir), needs_review=True, classes=("pure",), confidences=("low",))
    return found.select("asin", "class_label", "count_label", "count_confidence")


def review_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.pick(parsed(spark, sf_dir), search=SEARCH).select("asin", "title")


def review_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.facets(queue(spark, sf_dir))


def review_prefill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.prefill(queue(spark, sf_dir), stored(spark, sf_dir), REASONS)


def review_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.progress(parsed(spark, sf_dir), stored(spark, sf_dir))


def agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lab.agreement(stored(spark, sf_dir), queue(spark, sf_dir))


def evidence_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.evidence(queue(spark, sf_dir))


def evidence_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.catalog_evidence(parsed(spark, sf_dir))


def evidence_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.text_evidence(parsed(spark, sf_dir)).select("asin", F.array_join("bullets", ";").alias("bullets"), "description")


def title_highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(ops.count_candidates(parsed(spark, sf_dir)).select("asin", "title", "cand_title"), "titles").select("asin", review.title_highlight().alias("title"))


def page_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", pages.sanitize(F.col("html")).alias("html"))


def page_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return fixtures.listing_pages(spark, sf_dir).select("asin", pages.quick_image(html).alias("image"), pages.quick_price(html).alias("price"))


def page_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = pages.clean_text(pages.text_of(F.col("html")))
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", text.alias("text"), pages.first_number(text).alias("number"))


def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fixtures.listing_pages(spark, sf_dir).select("asin", pages.page_fields(F.col("html")).alias("f"))
    return found.select("asin", "f.title", F.array_join("f.bullets", " | ").alias("bullets"), "f.description", "f.number_of_items", "f.unit_count", "f.size")


def page_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fixtures.listing_pages(spark, sf_dir).select("asin", pages.page_fields(F.col("html"), 15, 1600).alias("f"))
    card = found.select("asin", *[c.alias(n) for n, c in pages.reader_card(F.col("f")).items()])
    details = F.array_join(F.transform(F.map_entries("details"), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), "; ")
    return card.select("asin", "title", "image", "price", "brand", F.array_join("bullets", " | ").alias("bullets"), "description", details.alias("details"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        labeling_sample, label_flags, label_submissions, labels_latest, accept_predictions, full_view, queue_enriched, queue_unlabeled, review_queue, review_search,
        review_facets, review_prefill, review_progress, agreement, evidence_long, evidence_catalog, evidence_text, title_highlight, page_sanitize, page_media,
        page_clean_text, page_fields, page_reader,
    )
}

_FORMS = f"""
WITH s AS ({fixtures.SUBMISSIONS}),
v AS (SELECT *, lower(trim(verdict)) AS lv, CAST(trunc(try_cast(n AS DOUBLE)) AS INTEGER) AS k FROM s),
p AS (SELECT *, CASE WHEN lv IN ('1', 'true', 'yes', 'y', '1.0') THEN 'true' WHEN lv IN ('0', 'false', 'no', 'n', '0.0') THEN 'false' ELSE 'unsure' END AS pv FROM v),
forms AS (SELECT asin, class_label, CASE WHEN pv = 'unsure' THEN '' ELSE pv END AS is_pure_bath_bomb_manual, CASE WHEN pv = 'true' AND k > 0 THEN k END AS n_bomb_balls_manual,
  CASE WHEN pv = 'false' THEN coalesce(reason, '') ELSE '' END AS exclude_reason_manual, notes, ts, seq FROM p),
stored AS (SELECT * FROM forms QUALIFY row_number() OVER (PARTITION BY asin ORDER BY ts DESC, seq DESC) = 1)
"""
_SAMPLE = _WORDS + f""", k AS (SELECT r.asin, coalesce({_REASON}, 'pure') AS class_label, title FROM r JOIN l ON r.asin = l.asin),
n AS (SELECT *, row_number() OVER (PARTITION BY class_label ORDER BY md5('{SEED}|' || asin), asin) AS rank, greatest(1, {SAMPLE} // (SELECT count(DISTINCT class_label) FROM k)) AS per FROM k),
m AS (SELECT *, row_number() OVER (ORDER BY (rank > per)::INT, md5('{SEED}|' || asin), asin) AS place FROM n),
sample AS (SELECT asin, class_label, title FROM m WHERE rank <= per OR place <= {SAMPLE})
"""
_PAGES = "SELECT asin, p_partkey, p_name, p_brand, p_type, p_size FROM (SELECT *, concat('B', lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS asin FROM part)"

_RESULTS, _COUNTS, _PARSED = vote_queries.SQL["results"], vote_queries.SQL["count_labels"], detail_queries.SQL["parsed_listings"]
_TEXTS = ("l.brand", "l.unit_text", "l.number_of_items", "l.size")
_NUMBERS = ("p.keepa_number_of_items", "p.keepa_package_quantity", "p.keepa_item_weight_g", "p.keepa_image_count", "p.keepa_variation_count")
_FIELDS = ", ".join(
    [f"""'"{c[2:]}":"' || {c} || '"'""" for c in _TEXTS] + [f"""'"{c[2:]}":' || {c}""" for c in _NUMBERS]
)

SQL: dict[str, str] = {
    "labeling_sample": f"""SELECT s.asin, s.class_label, c.count_label, s.title, l.number_of_items, l.size, r.is_pure_bath_bomb, r.n_bomb_balls, r.count_source, r.exclude_reason,
  r.seller_counts_pack_as_one, p.keepa_main_image_url, p.keepa_image_count FROM ({_SAMPLE} SELECT * FROM sample) s JOIN ({_COUNTS}) c ON c.asin = s.asin
  JOIN ({_RESULTS}) r ON r.asin = s.asin JOIN ({_PARSED}) p ON p.asin = s.asin JOIN ({fixtures.LISTINGS}) l ON l.asin = s.asin""",
    "accept_predictions": f"""SELECT asin, coalesce(exclude_reason, 'pure') AS class_label, CASE WHEN is_pure_bath_bomb THEN 'true' ELSE 'false' END AS is_pure_bath_bomb_manual,
  n_bomb_balls AS n_bomb_balls_manual, coalesce(exclude_reason, '') AS exclude_reason_manual, 'accepted rule prediction' AS notes, CAST(0 AS DOUBLE) AS ts FROM ({_RESULTS})""",
    "review_facets": f"""WITH q AS (SELECT r.*, coalesce(exclude_reason, 'pure') AS class_label, c.count_label FROM ({_RESULTS}) r JOIN ({_COUNTS}) c ON c.asin = r.asin),
f AS (SELECT 'class_label' AS facet, class_label AS value FROM q UNION ALL SELECT 'count_label', count_label FROM q UNION ALL SELECT 'count_confidence', count_confidence FROM q
  UNION ALL SELECT 'needs_review', 'true' FROM q WHERE needs_review UNION ALL SELECT 'count_conflict', 'true' FROM q WHERE count_conflict)
SELECT facet, value, count(*) AS n,
  CASE facet WHEN 'class_label' THEN list_position({list(CLASS_LABELS)}, value) WHEN 'count_label' THEN list_position({list(review.COUNT_LABELS)}, value) ELSE 0 END AS place FROM f GROUP BY ALL""",
    "review_prefill": _FORMS + f"""SELECT r.asin, CASE WHEN s.asin IS NULL THEN CAST(is_pure_bath_bomb AS VARCHAR) ELSE coalesce(nullif(is_pure_bath_bomb_manual, ''), 'unsure') END AS verdict,
  CASE WHEN s.asin IS NULL THEN n_bomb_balls ELSE n_bomb_balls_manual END AS n,
  CASE WHEN s.asin IS NULL THEN coalesce(exclude_reason, '') ELSE exclude_reason_manual END AS reason, CASE WHEN s.asin IS NULL THEN '' ELSE s.notes END AS notes, s.asin IS NOT NULL AS already
FROM ({_RESULTS}) r LEFT JOIN stored s ON s.asin = r.asin""",
    "agreement": _FORMS + f""", b AS (SELECT is_pure_bath_bomb_manual AS m, n_bomb_balls_manual AS mn, r.is_pure_bath_bomb AS p, r.n_bomb_balls AS n FROM stored s JOIN ({_RESULTS}) r ON r.asin = s.asin)
SELECT count(*) FILTER (m <> '') AS labelled, avg(((m = 'true') = p)::INT) FILTER (m <> '') AS verdict_share,
  count(*) FILTER (m = 'true' AND mn IS NOT NULL AND n IS NOT NULL) AS counted, avg((mn = n)::INT) FILTER (m = 'true' AND mn IS NOT NULL AND n IS NOT NULL) AS count_share FROM b""",
    "evidence_catalog": f"""SELECT l.asin, '{{' || array_to_string(list_filter([{_FIELDS}], lambda x: x IS NOT NULL), ',') || '}}' AS fields
FROM ({fixtures.LISTINGS}) l JOIN ({_PARSED}) p ON p.asin = l.asin""",
    "queue_enriched": _SAMPLE + "SELECT sample.asin, class_label, l.brand, l.size, present AS keepa_present FROM sample JOIN l ON l.asin = sample.asin JOIN r ON r.asin = l.asin",
    "full_view": _WORDS + f"SELECT r.asin, title, present AS keepa_present, rule = 5 AS is_pure_bath_bomb, {_REASON} AS exclude_reason, ['rule_no_bomb', 'rule_craft_kit', 'rule_bundle', 'rule_substitute', 'rule_ingredient', 'rule_positive'][rule + 1] AS purity_source FROM r JOIN l ON l.asin = r.asin",
    "label_flags": _FORMS + "SELECT seq, pv AS verdict, k AS n FROM p",
    "label_submissions": _FORMS + "SELECT * FROM forms",
    "labels_latest": _FORMS + "SELECT * FROM stored",
    "queue_unlabeled": _FORMS + f"SELECT asin, title FROM ({fixtures.LISTINGS}) WHERE asin NOT IN (SELECT asin FROM stored)",
    "review_progress": _FORMS + f""", q AS (SELECT DISTINCT asin FROM ({fixtures.LISTINGS}))
SELECT (SELECT count(*) FROM stored) AS labelled, count(*) AS queued, count(*) FILTER (asin NOT IN (SELECT asin FROM stored)) AS unlabelled FROM q""",
    "review_search": f"SELECT asin, title FROM ({fixtures.LISTINGS}) WHERE regexp_matches(lower(asin), '{SEARCH.strip().lower()}') OR regexp_matches(lower(title), '{SEARCH.strip().lower()}')",
    "evidence_text": f"""WITH l AS ({fixtures.LISTINGS}), c AS ({fixtures.CATALOG}),
k AS (SELECT asin, CASE features WHEN '["fizzy", "4 pack"]' THEN 'fizzy;4 pack' ELSE features END AS f FROM c QUALIFY row_number() OVER (PARTITION BY asin ORDER BY pos DESC) = 1)
SELECT l.asin, coalesce(feature, f, '') AS bullets, product_description AS description FROM l LEFT JOIN k ON k.asin = l.asin""",
    "page_sanitize": f"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script>', '', 'g'), '(?is)<noscript\\b[^>]*>.*?</noscript>', '', 'g'),
  '(?i)<meta[^>]+http-equiv=[''"]?refresh[''"]?[^>]*>', '', 'g') AS h FROM pages)
SELECT page_id, CASE WHEN regexp_matches(h, '(?i)<head[^>]*>') THEN regexp_replace(h, '(?i)(<head[^>]*>)', '\\1{pages.BASE}') ELSE '{pages.BASE}' || h END AS html FROM a""",
    "page_media": f"SELECT asin, CASE WHEN p_partkey % 2 = 0 THEN concat('https://img.example.org/', p_partkey, '.jpg') WHEN p_partkey % 3 = 0 THEN 'https://img.example.org/landing.jpg' END AS image, concat('$', p_size, '.99') AS price FROM ({_PAGES})",
    "page_clean_text": """WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<(script|style)\\b[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g') AS h FROM pages),
b AS (SELECT page_id, trim(regexp_replace(trim(regexp_replace(h, '\\s+', ' ', 'g')), '\\s*:\\s*', ': ', 'g'), ' :') AS text FROM a)
SELECT page_id, text, CAST(nullif(regexp_extract(replace(text, ',', ''), '(\\d+(\\.\\d+)?)', 1), '') AS DOUBLE) AS number FROM b""",
    "page_fields": f"SELECT asin, p_name || ' bath bomb' AS title, 'Fizzy & fresh | ' || p_type AS bullets, 'About: ' || p_name AS description, CAST(1000 + p_size + 100 + 0.5 AS DOUBLE) AS number_of_items, CAST(p_size AS DOUBLE) AS unit_count, concat(p_size, ' Count') AS size FROM ({_PAGES})",
    "page_reader": f"""SELECT asin, p_name || ' bath bomb' AS title, concat(CASE WHEN p_partkey % 2 = 0 THEN 'https://img.example.org/' ELSE '/' END, p_partkey, '.jpg') AS image, concat('$', p_size, '.99') AS price, p_brand AS brand,
  'Fizzy & fresh | ' || p_type AS bullets, 'About: ' || p_name AS description, concat('Number of items=', 1100 + p_size, '.5; Unit count=', p_size, '.0; Item package quantity=; Size=', p_size, ' Count; Item weight=') AS details FROM ({_PAGES})""",
}
