"""Listings, catalogue, pages and label forms derived from part and orders, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TITLES = (
    "'Lavender Bath Bomb'", "'Bath Salts'", "'Craft Kit for Kids'", "'DIY Bath Bomb Mould'", "'Bath Bomb Gift with Candle'", "'Bath Bombs with Surprise Inside'",
    "'Bath Bombs Surprise'", "'Bath Salts & Bath Bomb'", "'Bath Bomb & Bath Salts'", "'Bath Bomb with Citric Acid'", "'Citric Acid Bath Bomb'", "'Soap Free Bath Bomb'",
    "'Soap Co. Bath Bomb'", "'Bath Bomb and Soap'", "'Bath Bomb & Bubble Bath'", "'Shower Steamer Shower Bomb'", "CAST(NULL AS VARCHAR(9))", "''",
    "concat('Set of ', p_size, ' Bath Bombs')", "concat('Bath Bombs 2 Pack of ', p_size)", "concat('Bath Bombs ', p_size, ' Pack of 2 oz')", "'Six Bath Bombs'",
    "'Eight (8) Bath Bombs'", "concat(p_size, ' x 40g Bath Bombs')", "concat('Bath Bombs ', p_size, ' x 2.0 oz')", "concat(p_size, ' oz Bath Bomb')",
    "concat(p_size, ' Handmade Organic Bath Bombs')", "concat('Bath Bomb Case Pack ', p_size)", "concat('Bath Bomb 5000 ct, ', p_size, ' pcs')",
    "concat('Bath Bomb ', p_size, ' ct')", "concat('Bath Bomb ', p_size, ' Pack ', p_name)", "concat(p_size, '-pk Bath Fizzies')", "concat(p_size, ' balloons Bath Bomb')",
    "concat('Bath Bombs Pack of ', p_size)",
    "concat('Bath Bombs Pack of ', p_size, ' oz')", "concat('5 oz ', p_size, ' Pack Bath Bombs')", "concat(p_size, ' Scents Bath Bombs')", "'DOZEN bath bombs'",
    "concat('Three (3) Pack of ', p_size, ' bath balls')", "concat(p_size, ' count Shower Bombs, set of ', p_size + 1)", "concat('Bath Bomb Gift Set of 4 with Dry Shampoo ', p_name)",
    "concat('Bubble Bath Bomb ', p_size, 'ct')", "concat(p_size, ' × 1.6 oz bath fizz')", "concat('Case of ', p_size, ' Aromabombs')", "'Make-Your-Own Bath Bomb, 2 pcs'",
    "'Book & Kit Bath Bombs (8 pieces)'", "concat('Bath Fizzies ', p_size * 100000, ' count')", "concat(p_size, ' Sets of 3, 12 bath blasters')",
    "concat('Soap-free shower bomb ', p_size, ' - pk')", "concat('Baking Soda bath burst x', p_size, ' balls')",
)
_TITLE = f"CASE p_partkey % {len(TITLES)} " + " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(TITLES)) + " END"

LISTINGS = f"""
SELECT concat('B', lpad(CAST(p_partkey AS VARCHAR(20)), 9, '0')) AS asin, {_TITLE} AS title, p_brand AS brand,
  CASE p_partkey % 6 WHEN 0 THEN '1' WHEN 1 THEN CAST(p_size AS VARCHAR(9)) WHEN 2 THEN '2.9' WHEN 3 THEN 'abc' WHEN 4 THEN '-1' END AS number_of_items,
  CASE p_partkey % 5 WHEN 0 THEN concat(p_size, ' Count') WHEN 1 THEN '6 Count' WHEN 2 THEN '5 oz' END AS size,
  CASE p_partkey % 7 WHEN 0 THEN '6 pieces' WHEN 1 THEN concat('pack of ', p_size) END AS feature,
  CASE p_partkey % 8 WHEN 0 THEN '1 pc' WHEN 1 THEN concat('case of ', p_size, ' bath bombs') END AS product_description,
  CASE p_partkey % 3 WHEN 0 THEN 'Count' WHEN 1 THEN 'Ounce' END AS unit_text, CAST(p_size AS VARCHAR(9)) AS unit_num,
  CASE p_partkey % 4 WHEN 0 THEN 'Count per pack' END AS label_unit, CAST(p_size % 9 AS VARCHAR(9)) AS label_unit_num
FROM part"""

CATALOG = """
SELECT concat('B', lpad(CAST(p_partkey AS VARCHAR(20)), 9, '0')) AS asin, pos, CASE WHEN p_partkey % 17 = 0 THEN 'nan' ELSE ' Bath Bomb ' END AS title,
  p_brand AS brand, CAST(p_size % 5 - 1 + pos AS VARCHAR(9)) AS "numberOfItems", CAST(p_size % 4 AS VARCHAR(9)) AS "packageQuantity",
  CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'a.jpg,,b.jpg' WHEN 2 THEN 'c.jpg' END AS "imagesCSV",
  CASE p_partkey % 5 WHEN 0 THEN '["fizzy", "4 pack"]' WHEN 1 THEN 'plain' END AS features
FROM part CROSS JOIN (SELECT 0 AS pos UNION ALL SELECT 1 AS pos) q
WHERE p_partkey % 11 <> 0 AND (pos = 0 OR p_partkey % 7 = 0)"""

# Counts that the nine sources of a listing report, without any text to parse: nulls, ones, ties and conflicts of many kinds.
_REPORT = "CASE WHEN (p_partkey * {a} + p_size * {b}) % {c} < {d} THEN CAST((p_partkey * {b} + p_size * {a}) % {e} + 1 AS INTEGER) END AS {name}"
_MIXED = (
    ("cand_title", 3, 5, 7, 3, 4), ("cand_bullets", 5, 3, 11, 4, 4), ("cand_size", 7, 2, 5, 2, 3), ("cand_description", 2, 7, 9, 3, 4),
    ("cand_number_of_items", 11, 3, 8, 3, 3), ("cand_keepa_number_of_items", 13, 5, 6, 2, 4), ("cand_keepa_package_qty", 17, 4, 7, 2, 3),
    ("cand_label_unit_num", 19, 6, 9, 2, 4), ("cand_unit_num", 23, 8, 10, 3, 3),
)
REPORTS = f"""
SELECT concat('B', lpad(CAST(p_partkey AS VARCHAR(20)), 9, '0')) AS asin, p_partkey % 10 <> 0 AS is_pure_bath_bomb,
  {", ".join(_REPORT.format(name=n, a=a, b=b, c=c, d=d, e=e) for n, a, b, c, d, e in _MIXED)}
FROM part"""

# Forms, several for each listing of every other pair; seq settles equal times.
SUBMISSIONS = """
SELECT concat('B', lpad(CAST(o_orderkey % (SELECT count(*) FROM part) - o_orderkey % (SELECT count(*) FROM part) % 4 + o_orderkey % 2 AS VARCHAR(20)), 9, '0')) AS asin, o_orderkey AS seq, 'pure' AS class_label,
  CASE o_orderkey % 7 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN '1' WHEN 3 THEN ' no ' WHEN 4 THEN 'maybe' WHEN 6 THEN '1.0' END AS verdict,
  CASE o_orderkey % 5 WHEN 0 THEN '6' WHEN 1 THEN '4.0' WHEN 2 THEN '-2' WHEN 3 THEN 'six' END AS n,
  CASE o_orderkey % 3 WHEN 0 THEN 'bundle' WHEN 1 THEN 'craft_kit' END AS reason, o_orderpriority AS notes,
  CAST((year(o_orderdate) * 372 + month(o_orderdate) * 31 + day(o_orderdate)) * 86400.0 AS DOUBLE) AS ts
FROM orders"""

# Pages of listings, with known values.
LISTING_PAGES = """
SELECT concat('B', lpad(CAST(p_partkey AS VARCHAR(20)), 9, '0')) AS asin,
  concat('<html><head><meta property="og:image" content="', CASE WHEN p_partkey % 2 = 0 THEN 'https://img.example.org/' ELSE '/' END, p_partkey, '.jpg"><script>var a = "<p>";</script></head><body>',
    '<span id="productTitle"> ', p_name, '  bath bomb </span><a id="bylineInfo">', p_brand, '</a><div class="a-price"><span class="a-offscreen">$', p_size, '.99</span></div>',
    CASE WHEN p_partkey % 3 = 0 THEN '<img id="landingImage" src="https://img.example.org/landing.jpg">' ELSE '' END,
    '<table id="productDetails_techSpec_section_1"><tr><th>Number of Items</th><td>1,', p_size + 100, '.5 pcs</td></tr><tr><th> Item  Size :</th><td>', p_size, ' Count</td></tr></table>',
    '<div id="detailBullets_feature_div"><ul><li><span>Unit Count : </span><span>', p_size, '</span></li></ul></div>',
    '<div id="feature-bullets"><ul><li>Fizzy &amp; fresh</li><li> </li><li>Related videos</li><li>', p_type, '</li></ul></div><div id="productDescription"><p>About : ', p_name, '</p></div></body></html>') AS html
FROM part"""


ROWS_A_TASK = 5_000


def spread(table: DataFrame) -> DataFrame:
    """The rows dealt to tasks by their number: a million narrow rows are one or two splits of a file, but each makes a page or a listing to score."""
    tasks = -(-table.count() // ROWS_A_TASK)
    return table.repartition(tasks) if tasks > 1 else table


def _run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("part", "orders") if f"FROM {t}" in sql}
    if "orders" not in tables:
        tables["part"] = spread(tables["part"])
    return spark.sql(_quoted(sql), **tables)


def _quoted(sql: str) -> str:
    """Identifiers in Spark's quotes; the double quotes within string literals stay."""
    parts = sql.replace("FROM part", "FROM {part}").replace("FROM orders", "FROM {orders}").split("'")
    return "'".join(p if i % 2 else p.replace('"', "`") for i, p in enumerate(parts))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, LISTINGS)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, CATALOG)


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, REPORTS)


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, SUBMISSIONS)


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, LISTING_PAGES)
