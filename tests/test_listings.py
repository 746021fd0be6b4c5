import pytest

from tallyspark.functions.rules import DEFAULT, Rules
from tallyspark.operators import catalog as cat
from tallyspark.operators import listings as ops
from tallyspark.sources import rule_files

COLUMNS = ["asin", "title", "brand", "number_of_items", "size", "feature", "product_description", "unit_text", "unit_num", "label_unit", "label_unit_num"]
SCHEMA = ", ".join(f"{c} string" for c in COLUMNS)

# title to reason; None: the product itself
VERDICTS = {
    "Lavender Bath Bomb": None, "Bath Salts": "no-bath-bomb", "Craft Kit for Kids": "no-bath-bomb", "DIY Bath Bomb Mould": "craft_kit", "Bath Bomb Gift with Candle": "bundle",
    "Bath Bombs with Surprise Inside": "bundle", "Bath Bombs Surprise": None, "Bath Salts & Bath Bomb": "substitute", "Bath Bomb & Bath Salts": None,
    "Bath Bomb with Citric Acid": None, "Citric Acid Bath Bomb": "ingredients", "Soap Free Bath Bomb": None, "Soap Co. Bath Bomb": None, "Bath Bomb and Soap": "bundle",
    "Bath Bomb & Bubble Bath": "bundle", "Shower Steamer Shower Bomb": "substitute", "": "no-bath-bomb",
}
TITLES = {
    "Set of 6 Bath Bombs": (6, "set_of"), "Bath Bombs 2 Pack of 6": (12, "pack_mult"), "Bath Bombs 6 Pack of 2 oz": (6, "near_pack"), "Six Bath Bombs": (6, "word_count"),
    "Eight (8) Bath Bombs": (8, "word_paren"), "6 x 40g Bath Bombs": (6, "n_x_bombs"), "Bath Bombs 6 x 2.0 oz": (6, "n_x_weight"), "5 oz Bath Bomb": (None, None),
    "12 Handmade Organic Bath Bombs": (12, "near_bombs"), "Bath Bomb Case Pack 72": (72, "case_pack"), "Bath Bomb 5000 ct, 6 pcs": (None, None), "Bath Bomb 1 ct": (1, "near_ct"),
    "Bath Bomb 1 Pack": (None, None), "12-pk Bath Fizzies": (12, "near_pk"), "2 balloons Bath Bomb": (2, "near_ball"), "Bath Bombs Pack of 4": (4, "pack_of"),
    "Bath Bomb 99999999999999999999 ct, 6 pcs": (None, None),
}
TWELVE = "Bath Bombs 12 ct"
VOTES = [  # fields, then n, source, confidence, conflict, review, seller flag
    ({"title": TWELVE, "number_of_items": "1"}, (12, "title", "high", False, False, True)),
    ({"title": TWELVE, "size": "6 Count"}, (12, "title", "high", True, False, False)),
    ({"title": TWELVE, "feature": "6 pieces"}, (12, "title", "low", True, True, False)),
    ({"title": "Bath Bomb", "keepa_number_of_items": 6, "keepa_package_quantity": 6}, (6, "keepa_number_of_items", "medium", False, False, False)),
    ({"title": "Bath Bomb", "keepa_package_quantity": 4}, (4, "keepa_package_quantity", "low", False, False, False)),
    ({"title": "Bath Bomb", "product_description": "1 pc"}, (1, "single_default", "low", False, True, False)),
    ({"title": "Bath Bomb", "unit_num": "8", "unit_text": "Count"}, (8, "unit_num", "low", False, False, False)),
    ({"title": "Bath Bomb", "unit_num": "8", "unit_text": "Ounce"}, (1, "assumed_single", "low", False, True, False)),
    ({"title": "Bath Bomb", "size": "6 Count", "number_of_items": "6"}, (6, "size", "high", False, False, False)),
    ({"title": "Bath Bomb 1 ct"}, (1, "single_default", "medium", False, False, False)),
    ({"title": "Bath Salts 12 ct"}, (None, None, "n/a", False, False, False)),
]


def frame(spark, rows):
    names = [*COLUMNS, *cat.FIELDS]
    schema = SCHEMA + ", " + ", ".join(f"{k} {t}" for k, t in cat.FIELDS.items())
    return spark.createDataFrame([tuple({"asin": str(i), **r}.get(c) for c in names) for i, r in enumerate(rows)], schema)


def test_verdicts(spark):
    got = {r["title"]: r["exclude_reason"] for r in ops.purity(frame(spark, [{"title": t} for t in VERDICTS])).collect()}
    assert got == VERDICTS
    null = ops.purity(frame(spark, [{"keepa_title": "Bath Bomb"}, {}])).orderBy("asin").collect()
    assert [r["exclude_reason"] for r in null] == [None, "no-bath-bomb"]


def test_title_candidates(spark):
    got = {r["title"]: (r["cand_title"], r["cand_title_pattern"]) for r in ops.count_candidates(frame(spark, [{"title": t} for t in TITLES])).collect()}
    assert got == TITLES


def test_votes(spark):
    rows = sorted(ops.score(frame(spark, [v[0] for v in VOTES])).collect(), key=lambda r: int(r["asin"]))
    names = ["n_bomb_balls", "count_source", "count_confidence", "count_conflict", "needs_review", "seller_counts_pack_as_one"]
    assert [tuple(r[n] for n in names) for r in rows] == [v[1] for v in VOTES]


@pytest.mark.parametrize(("text", "want"), [("6", 6), ("2.9", 2), ("-1", None), ("0", None), ("0.5", None), ("abc", None), ("", None), (None, None), ("1d", None), ("inf", None)])
def test_positive_int(spark, text, want):
    assert spark.createDataFrame([(text,)], "v string").select(ops.positive_int(__import__("pyspark").sql.functions.col("v")).alias("n")).first()["n"] == want


def test_catalog(spark):
    rows = [("a", 0, "old", "['a', 'b ']", "x.jpg"), ("a", 1, " New ", "('a','b')", "x.jpg,y.jpg"), ("b", 0, "NaN", "[None, 'a']", ",,"), ("c", 0, None, "['', ' ']", None), ("d", 0, "t", "plain", "a,,b"), (None, 0, "t", "5", "a")]
    c = spark.createDataFrame(rows, "asin string, pos int, title string, features string, imagesCSV string")
    listed = spark.createDataFrame([("a",), ("a",), ("b",), ("z",), (None,)], "asin string")
    got = cat.attach(listed, c).collect()
    assert len(got) == 5
    a = next(r for r in got if r["asin"] == "a")
    p = cat.IMAGE_PREFIX
    assert (a["keepa_title"], a["keepa_features"], a["keepa_image_count"], a["keepa_image_urls"]) == ("New", "a | b", 2, f"{p}x.jpg | {p}y.jpg")
    b = next(r for r in got if r["asin"] == "b")
    assert (b["keepa_title"], b["keepa_features"], b["keepa_image_count"]) == (None, "None | a", None)
    assert sum(r["keepa_present"] for r in got) == 3


def test_rules_from_a_file(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"target": ["soap bars?"], "companion": ["candles?"], "number_words": {"couple": 2}, "weights": {"title": 1, "size": 9}, "confidence": {"size": "high", "assumed_single": "medium"}, "default_single": 3, "channels": {"title": ["title", "brand"], "size": ["size"], "bullets": ["feature"], "description": ["product_description"]}}')
    rules = Rules.from_file(str(path))
    rows = [{"title": "Soap Bar 12 ct", "size": "6 Count"}, {"title": "Soap Bar", "brand": "couple pack"}, {"title": "Soap Bar"}, {"title": "Bath Bomb"}]
    got = sorted(ops.score(frame(spark, rows), rules).collect(), key=lambda r: int(r["asin"]))
    assert [(r["is_pure_bath_bomb"], r["n_bomb_balls"], r["count_source"], r["count_confidence"]) for r in got] == [
        (True, 6, "size", "high"), (True, 2, "title", "low"), (True, 3, "assumed_single", "medium"), (False, None, None, "n/a"),
    ]
    with pytest.raises(ValueError, match="unknown rules: colour"):
        Rules.of({"colour": 1})


def test_quality_report(spark):
    rows = [{"title": "Bath Bombs 12 ct", "feature": "6 pieces"}, {"title": "Bath Bomb"}, {"title": "Bath Bombs 4 ct"}, {"title": "Candle"}]
    got = {(r["facet"], r["value"]): (r["listings"], round(r["share"], 3)) for r in ops.quality_report(ops.score(frame(spark, rows))).collect()}
    assert got == {
        ("class", "pure"): (3, 0.75), ("class", "no-bath-bomb"): (1, 0.25), ("confidence", "low"): (2, 0.667), ("confidence", "high"): (1, 0.333),
        ("conflict", "true"): (1, 0.333), ("review", "true"): (2, 0.667),
    }


def test_rules_from_sections(spark, tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "rules.yml"
    path.write_text(r"""
paths: {results_parquet: output/x}
purity:
  lexicon:
    bomb_positive: ['\bsoap bars?\b']
    companions: ['\bcandles?\b', '\btoys?\b']
    surprise: '\bsurprise\b'
counting:
  text_channels: {title: [title, brand], size: [size], bullets: [feature], description: [product_description]}
  patterns:
    pack_mult: '\b(?P<a>\d+)\s*boxes of\s+(?P<b>\d+)\b'
    count_near_bomb: '(?P<n>\d+)\s*(?P<unit>bars?|ct)'
  source_weights: {title: 1, size: 9}
  confidence: {text_size: high, text_title: low, assumed_single: medium}
  number_words: {couple: 2}
  default_single: 3
labeling: {sample_size: 20, seed: 7, class_labels: [pure, bundle]}
""")
    config = rule_files.load(spark, str(path))
    assert (config.sample_size, config.seed, config.rules.class_labels) == (20, 7, ("pure", "bundle"))
    rows = [{"title": "Soap Bar 12 ct", "size": "6 bars"}, {"title": "2 boxes of 7 Soap Bars"}, {"title": "Soap Bar", "brand": "couple pack"}, {"title": "Soap Bar"}, {"title": "Soap bar with toys"}]
    got = sorted(ops.score(frame(spark, rows), config.rules).collect(), key=lambda r: int(r["asin"]))
    assert [(r["n_bomb_balls"], r["count_source"], r["count_confidence"]) for r in got] == [(6, "size", "high"), (14, "title", "low"), (2, "title", "low"), (3, "assumed_single", "medium"), (None, None, "n/a")]
    assert rule_files.config_of({"purity": {}}).rules == DEFAULT and rule_files.config_of({}).rules == DEFAULT
    # The default patterns, as sections would give them, are the defaults.
    named = {"set_of": r"\bset of\s+(?P<n>\d+)\b", "n_count": r"\b(?P<n>\d+)\s*count\b"}
    assert rule_files.config_of({"counting": {"patterns": named}}).rules.patterns == DEFAULT.patterns
    for wrong in ({"purity": {"colour": 1}}, {"counting": {"patterns": {"x": r"\d+"}}}, {"colour": 1}):
        with pytest.raises(ValueError, match="unknown|no group"):
            rule_files.config_of(wrong)
    (tmp_path / "plain.json").write_text('{"default_single": 2}')
    assert rule_files.load(spark, str(tmp_path / "plain.json")).rules.default_single == 2
