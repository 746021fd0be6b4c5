import hashlib
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import catalog as cat
from tallyspark.operators import labels as lab
from tallyspark.operators import pages, review
from tallyspark.operators.listings import score
from tallyspark.plans import batch
from tallyspark.sources import files, fixtures
from tallyspark.sources.stage import staged
from tests.test_listings import frame



def test_tri_state_and_whole(spark):
    rows = [("True", "true"), ("1.0", "true"), (" Y ", "true"), ("no", "false"), ("0", "false"), (None, "unsure"), ("maybe", "unsure")]
    assert [tuple(r) for r in spark.createDataFrame(rows, "v string, w string").select(lab.tri_state(F.col("v")), "w").collect()] == [(w, w) for _, w in rows]
    rows = [("4.0", 4), ("-2", -2), ("-2.9", -2), ("six", None), ("", None), (None, None), ("inf", None)]
    assert [tuple(r) for r in spark.createDataFrame(rows, "v string, w int").select(lab.whole(F.col("v")), "w").collect()] == [(w, w) for _, w in rows]


def labels(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], lab.SCHEMA)


def test_agreement(spark):
    scored = spark.createDataFrame([("a", True, 6), ("b", True, 5), ("c", True, 2), ("d", True, 1)], "asin string, is_pure_bath_bomb boolean, n_bomb_balls int")
    stored = labels(spark, ("a", "", "true", 6, "", "", 1.0), ("b", "", "true", 4, "", "", 1.0), ("c", "", "false", None, "", "", 1.0), ("d", "", "", None, "", "", 1.0))
    assert tuple(lab.agreement(stored, scored).first()) == (3, 2 / 3, 2, 0.5)
    assert tuple(lab.agreement(stored.limit(0), scored).first()) == (0, None, 0, None)


def test_upsert_keeps_the_newest(spark):
    old = labels(spark, ("a", "pure", "true", 1, "", "old", 5.0), ("b", "pure", "true", 1, "", "kept", 5.0))
    new = labels(spark, ("a", "pure", "true", 2, "", "new", 5.0), ("c", "pure", "false", None, "bundle", "added", 1.0), (None, "x", "", None, "", "", 9.0))
    got = lab.upsert(old, new)
    assert got.columns == old.columns
    assert {r["asin"]: r["notes"] for r in got.collect()} == {"a": "new", "b": "kept", "c": "added"}


@pytest.mark.parametrize(("n", "size", "want"), [(20, 300, {"pure": 20, "bundle": 1}), (50, 10, {"pure": 9, "bundle": 1}), (3, 1, {"pure": 1, "bundle": 1})])
def test_sample_is_stratified_and_topped_up(spark, n, size, want):
    rows = [(f"p{i}", "pure", f"t{i}") for i in range(n)] * 2 + [("b", "bundle", None)]
    got = lab.labeling_sample(spark.createDataFrame(rows, "asin string, class_label string, title string"), size).collect()
    assert {c: sum(r["class_label"] == c for r in got) for c in want} == want
    assert len({r["asin"] for r in got}) == len(got)


def test_queue(spark):
    queue = review.with_labels(staged(score(frame(spark, [{"title": "Bath Bombs 12 ct"}, {"title": "Bath Bomb"}, {"title": None}])), "test"))
    assert review.with_labels(queue) is queue
    assert [r["asin"] for r in review.pick(queue, needs_review=True).collect()] == ["1"]
    assert [r["asin"] for r in review.pick(queue, search=" 12 CT|^7").collect()] == ["0"]
    assert review.pick(queue, classes=("pure",), counts=("multi_pack",)).count() == 1
    found = {(r["facet"], r["value"]): r["n"] for r in review.facets(queue).collect()}
    assert (found["class_label", "pure"], found["needs_review", "true"]) == (2, 1)
    assert [tuple(r) for r in review.evidence(queue).collect()] == [("0", "title", 12, "near_ct")]
    high = queue.select(review.title_highlight().alias("t")).collect()
    assert [r["t"] for r in high] == ["Bath Bombs **12** ct", "Bath Bomb", None]
    stored = labels(spark, ("0", "pure", "false", None, "bundle", "mine", 1.0), ("z", "pure", "true", 1, "", "", 1.0))
    form = {r["asin"]: tuple(r)[1:] for r in review.prefill(queue, stored, ("bundle", "no-bath-bomb")).collect()}
    assert form == {"0": ("false", None, "bundle", "mine", True), "1": ("true", 1, "", "", False), "2": ("false", None, "no-bath-bomb", "", False)}
    assert tuple(review.progress(queue, stored).first()) == (2, 3, 2)
    assert sorted(r["asin"] for r in review.unlabelled(queue, stored).collect()) == ["1", "2"]
    taken = {r["asin"]: (r["is_pure_bath_bomb_manual"], r["n_bomb_balls_manual"], r["exclude_reason_manual"]) for r in lab.accept_predictions(queue, 1.0).collect()}
    assert taken == {"0": ("true", 12, ""), "1": ("true", 1, ""), "2": ("false", None, "no-bath-bomb")}


def test_page_helpers(spark):
    one = lambda v, f: spark.createDataFrame([(v,)], "v string").select(f(F.col("v")).alias("o")).first()["o"]
    assert one(' "  Size ‏ :\n 6 ', pages.clean_text) == '" Size: 6'
    assert one(" Size  :  6 : ", pages.clean_text) == "Size: 6"
    assert (one("1,200.5 g", pages.first_number), one("none", pages.first_number), one(None, pages.first_number)) == (1200.5, None, None)
    page = '<HEAD x><meta http-equiv="refresh" content="0"><noscript>a</noscript></head><head><script>\n</script >b</script>'
    assert one(page, pages.sanitize) == f"<HEAD x>{pages.BASE}</head><head>"
    assert one("<p>", pages.sanitize) == f"{pages.BASE}<p>"
    assert one("""<i class="a-offscreen"> free <b class='a-offscreen'> 5 <""", pages.quick_price) == "5"
    assert one('x "https://m.media-amazon.com/images/I/a.jpg"', pages.quick_image) == "https://m.media-amazon.com/images/I/a.jpg"


def test_page_fields(spark):
    pages_ = [
        '<table id=productDetails_techSpec_section_2><tr><th>Size<td>S<tr><th>Pack size<td>L</table><div id="productOverview_feature_div"><table><tr><td>Size</td><td>M</td></tr></table></div>'
        '<div id="feature-bullets"><ul><li>a<li>b</ul></div><div id="imgTagWrapperId"><img src="s" data-old-hires="h"></div><span id="price_inside_buybox"> 3 </span><div id="productDescription">' + "d" * 2000,
        None,
        "",
        '<div class="x a-price y"><b class="z a-offscreen">$4<u>.5</u></b></div><div id=corePrice_feature_div><p><span class=a-offscreen></span></div><a id=bylineInfo>By <b>Me</b></a>'
        '<img id=landingImage src=small><div id=detailBullets_feature_div><li>Unit Count : 1,200.5 g : x<li>none</div><div id=detailBullets_feature_div><li>size: twice</div><script>"<p id=productTitle>no"</script>'
        '<h1 id=productTitle> A &amp; <i>B</i></h1><div id="feature-bullets"><ul><li>one<li> <li>Related Videos<li>two</ul></div>',
    ]
    df = spark.createDataFrame(list(enumerate(pages_)), "n int, h string")
    got = [r["f"] for r in df.select("n", pages.page_fields(F.col("h")).alias("f")).orderBy("n").collect()]
    assert (got[0]["size"], got[0]["bullets"], got[0]["image"], got[0]["price"], len(got[0]["description"]), got[0]["title"]) == ("M", ["a", "b"], "h", "3", 1200, None)
    for empty in got[1:3]:
        assert empty["bullets"] == [] and empty["description"] == "" and {v for k, v in empty.asDict().items() if k not in ("bullets", "description")} == {None}
    last = got[3]
    assert (last["title"], last["brand"], last["image"], last["price"], last["unit_count"], last["size"], last["bullets"]) == ("A & B", "By Me", "small", "$4 .5", 1200.5, None, ["one", "two"])


def test_files(spark, tmp_path):
    for name, title in (("a.csv", "old"), ("b.csv", 'new\n"" line')):
        (tmp_path / name).write_text(",".join([*files.LISTING_COLUMNS, "more"]) + "\n" + ",".join(f'"{title}"' if c == "title" else c for c in files.LISTING_COLUMNS) + ",x\n")
    got = files.read_listings(spark, str(tmp_path))
    assert (got.columns, got.first()["title"]) == (list(files.LISTING_COLUMNS), 'new\n" line')
    (tmp_path / "c.csv").write_text("asin,title\n1,t\n1,u\n")
    with pytest.raises(ValueError, match="asin_in_html, brand"):
        files.read_listings(spark, str(tmp_path))
    assert [(r["title"], r["pos"]["file"], r["pos"]["row"]) for r in files.read_catalog(spark, str(tmp_path / "c.csv")).orderBy("pos").collect()] == [("t", "c.csv", 0), ("u", "c.csv", 1)]
    assert files.read_catalog(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        files.newest_csv(spark, str(tmp_path / "none"))


def test_label_store(spark, tmp_path):
    path = str(tmp_path / "labels")
    assert files.read_labels(spark, path).count() == 0
    files.write_labels(labels(spark, ("a", "pure", "true", 4, "", 'said "x"\nand y', 2.5)), path)
    files.write_labels(lab.upsert(files.read_labels(spark, path), labels(spark, ("b", "pure", "", None, "", None, 3.0))), path)
    got = {r["asin"]: (r["n_bomb_balls_manual"], r["notes"], r["ts"]) for r in files.read_labels(spark, path).collect()}
    assert got == {"a": (4, 'said "x"\nand y', 2.5), "b": (None, None, 3.0)}
    assert os.listdir(tmp_path) == ["labels"]
    (tmp_path / "short.csv").write_text("asin,n_bomb_balls_manual\nq,4.0\n")
    assert files.read_labels(spark, str(tmp_path / "short.csv")).first()["n_bomb_balls_manual"] == 4


def test_page_files(spark, tmp_path):
    (tmp_path / "B01.html").write_bytes(b"<p>\xc3\xa9\xff</p>")
    (tmp_path / "B02.txt").write_bytes(b"x")
    assert [tuple(r) for r in files.read_pages(spark, str(tmp_path)).collect()] == [("B01", "<p>é</p>")]


def csv(path, names, *rows):
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if v is not None else ""
    path.write_text("\n".join([",".join(names), *(",".join(map(quoted, r)) for r in rows)]) + "\n")


def test_batch_job(spark, tmp_path):
    (tmp_path / "listings").mkdir()
    row = lambda asin, title, **more: [{"asin": asin, "title": title, **more}.get(c) for c in files.LISTING_COLUMNS]
    csv(
        tmp_path / "listings" / "2024.csv", files.LISTING_COLUMNS, row("a", "Bath Bombs 12 ct", number_of_items="1"), row("b", "nan"), row("c", "N/A", feature="6 pieces"),
        row("d", "Bath Salts"), row("", "Bath Bomb"), row("a", "Bath Bomb", size="6 Count"),
    )
    csv(tmp_path / "catalog.csv", ("asin", "title", "numberOfItems", "imagesCSV", "extra"), ("b", "Old", "1", "", "x"), ("b", "Bath Bomb", "-1", "x.jpg", "x"), ("c", "None", "2", None, "x"))
    out = batch.Outputs(*(str(tmp_path / n) for n in ("parsed", "results", "sample")))
    found = {r["class_label"]: (r["listings"], r["matched"]) for r in batch.run(spark, str(tmp_path / "listings"), str(tmp_path / "catalog.csv"), out).collect()}
    assert found == {"pure": (4, 1), "no-bath-bomb": (2, 1)}
    parsed = spark.read.parquet(out.parsed)
    assert parsed.columns == list(batch.PARSED) and parsed.filter("asin = 'b'").first()["title"] is None
    results = spark.read.parquet(out.results)
    assert results.columns == ["asin", *batch.RESULTS] and results.count() == 6
    assert sorted((r["n_bomb_balls"], r["count_source"], r["seller_counts_pack_as_one"]) for r in results.filter("asin = 'a'").collect()) == [(6, "size", False), (12, "title", True)]
    assert results.filter("asin is null").first()["is_pure_bath_bomb"]
    sample = spark.read.option("header", True).csv(out.sample)
    assert sample.columns == list(lab.SAMPLE_COLUMNS) and {r["asin"] for r in sample.collect()} == {"a", "b", "c", "d"}
    assert {r["count_label"] for r in sample.filter("class_label <> 'pure'").collect()} == {"n/a"}
    plain = batch.Outputs(str(tmp_path / "p2"), str(tmp_path / "r2"))
    assert {r["matched"] for r in batch.run(spark, str(tmp_path / "listings"), None, plain).collect()} == {0}
    assert not os.path.exists(tmp_path / "sample2")


def listing_files(tmp_path, n, title="Bath Bombs 12 ct"):
    row = lambda asin, **more: [{"asin": asin, **more}.get(c) for c in files.LISTING_COLUMNS]
    rows = [row("same" if i % 3 == 0 else "" if i % 3 == 1 else f"k{i}", title=f"{title} {i}", feature=f"line\n{i}") for i in range(n)]
    csv(tmp_path / "listings.csv", files.LISTING_COLUMNS, *rows)
    csv(tmp_path / "catalog.csv", ("asin", "title", "numberOfItems"), ("same", "Bath Bomb", "3"))
    return str(tmp_path / "listings.csv"), str(tmp_path / "catalog.csv")


def test_tasks_that_score_grow_with_the_file(spark, tmp_path, monkeypatch):
    """However few the buckets are; all outputs stay in these, and rows join without an Exchange."""
    listed = listing_files(tmp_path, 300)
    monkeypatch.setattr(batch, "PIECE_BYTES", os.path.getsize(listed[0]) // 7, raising=False)
    out = batch.Outputs(str(tmp_path / "p"), str(tmp_path / "r"), None, 2)
    assert {r["listings"] for r in batch.run(spark, *listed, out).collect()} == {300}
    for path in (out.parsed, out.results):
        assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 8, path
    view = batch.review.recombine(files.read_buckets(spark, out.parsed, 2), files.read_buckets(spark, out.results, 2))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = view._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert view.count() == 300 and view.filter("title IS NULL OR n_bomb_balls IS NULL").count() == 0


def test_a_run_is_current_as_a_whole(spark, tmp_path, monkeypatch):
    top = str(tmp_path / "runs")
    assert batch.latest(spark, top) is None and batch.read_run(spark, top) is None and batch.full_view(spark, top) is None
    first = batch.publish(spark, *listing_files(tmp_path, 30), top)
    view = batch.full_view(spark, top)
    # Equal ids and rows without one stay apart, and each has the result of its own title.
    assert view.count() == 30 and view.columns == [*batch.PARSED, *batch.RESULTS]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = batch.full_view(spark, top)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert view.filter("title IS NULL OR n_bomb_balls IS NULL").count() == 0 and view.filter("asin = 'same'").count() == 10
    listed = listing_files(tmp_path, 50)
    for step in ("write_csv", "write_parquet"):  # a failure on the way: the old run is still current, as a whole
        with monkeypatch.context() as m:
            m.setattr(files, step, lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                batch.publish(spark, *listed, top)
        assert batch.latest(spark, top) == first and batch.full_view(spark, top).count() == 30
    second = batch.publish(spark, *listed, top)
    parsed, results, summary = batch.read_run(spark, top)
    assert (parsed.count(), results.count(), summary.first()["listings"], batch.latest(spark, top)) == (50, 50, 50, second)
    assert len(batch.clear(spark, top, keep=1)) == 3 and batch.full_view(spark, top).count() == 50
    assert set(os.listdir(top)) == {"_current", second.parsed.split("/")[-2]}


def test_recombine_with_one_side_absent(spark):
    one = spark.createDataFrame([("a", 1)], "asin string, x int")
    assert review.recombine(one, None) is one and review.recombine(None, one) is one
    assert review.recombine(one, spark.createDataFrame([("a", 2, 3)], "asin string, x int, y int")).collect() == [("a", 1, 3)]


def test_listings_without_an_id_are_dealt_by_content(spark):
    listed = spark.createDataFrame([(None, f"t{i}") for i in range(200)] + [("a", "t")], "asin string, title string")
    got = cat.attach(listed, spark.createDataFrame([("a", 0, "c"), (None, 1, "d")], "asin string, pos int, title string"))
    assert got.columns[:2] == ["asin", "title"] and sum(r["keepa_present"] for r in got.collect()) == 1 and got.filter("asin is null").count() == 200


def test_evidence_catalog(spark):
    rows = spark.createDataFrame([("a", 'x"y', None, 3), ("b", None, None, None)], "asin string, brand string, price string, keepa_image_count int")
    assert {r["asin"]: json.loads(r["fields"]) for r in review.catalog_evidence(rows).collect()} == {"a": {"brand": 'x"y', "keepa_image_count": 3}, "b": {}}


def test_text_evidence_is_cut(spark):
    rows = spark.createDataFrame([("a", None, " x |  | y ", "d" * 5000, None)], "asin string, feature string, keepa_features string, product_description string, keepa_description string")
    got = review.text_evidence(rows).first()
    assert got["bullets"] == ["x", "y"] and len(got["description"]) == 4000


def test_facets_follow_the_order_of_the_labels(spark):
    rows = [("bundle", "n/a", "n/a"), ("pure", "single", "low"), ("pure", "multi_pack", "high")]
    queue = spark.createDataFrame([(*r, None, True) for r in rows], "class_label string, count_label string, count_confidence string, needs_review boolean, count_conflict boolean")
    shown = [(r["value"], r["n"]) for r in review.facets(queue).filter("facet = 'class_label'").orderBy("place", "value").collect()]
    assert shown == [("pure", 2), ("bundle", 1)]


def test_reader_card(spark):
    html = '<div id="detailBullets_feature_div"><ul><li>Unit Count : 6.5 Count</li></ul></div><div id="feature-bullets"><ul><li>a</li><li>b</li></ul></div>'
    df = spark.createDataFrame([(html,)], "h string").select(pages.page_fields(F.col("h"), 15, 1600).alias("f"))
    got = df.select(*[c.alias(n) for n, c in pages.reader_card(F.col("f")).items()]).first()
    assert got["bullets"] == ["a", "b"] and got["details"] == {"Number of items": None, "Unit count": "6.5", "Item package quantity": None, "Size": None, "Item weight": None}


def test_sample_of_skewed_classes(spark):
    """Most rows are of one class: it is ranked in groups of bounded size, and the sample is that of one sort."""
    rows = [(f"p{i}", "pure" if i % 20 else f"class{i % 3}", f"t{i}", i) for i in range(6000)]
    scored = spark.createDataFrame([*rows, *rows[:50], (None, "pure", "t", 0)], "asin string, class_label string, title string, n int").repartition(7)
    place = lambda r: hashlib.md5(f"42|{r[0]}".encode()).hexdigest()
    drawn = [r for c in {r[1] for r in rows} for r in sorted((r for r in rows if r[1] == c), key=place)[: 80 // 4]]
    drawn += sorted({*rows} - {*drawn}, key=place)[: 80 - len(drawn)]
    got = lab.labeling_sample(scored, 80, salt_rows=100)
    assert got.columns == ["asin", "class_label", "title", "n"] and sorted(map(tuple, got.collect())) == sorted(drawn)
    keys = scored.select("asin", "class_label").dropna().distinct()
    groups = keys.groupBy("class_label", F.pmod(F.xxhash64("asin"), F.lit(60)).alias("salt")).count()
    assert groups.agg(F.max("count")).first()[0] < 200
    top = lab.top_of_strata(keys, 5, [F.md5(F.concat(F.lit("42|"), "asin")), F.col("asin")], 60)
    assert top.groupBy("class_label").count().agg(F.max("count")).first()[0] == 5


def test_only_pure_leaves_out_what_no_count_uses(spark):
    texts = [{"title": t, "feature": "pack of 4", "number_of_items": "3"} for t in ("Bath Bombs 12 ct", "Bath Salts 6 pack", None, "Bath Bomb Gift with Candle, set of 4")]
    full, fast = (score(frame(spark, texts), only_pure=x).orderBy("asin").collect() for x in (False, True))
    for a, b in zip(full, fast, strict=True):
        candidates = [c for c in a.asDict() if c.startswith("cand_") or c == "seller_counts_pack_as_one"]
        same = [c for c in a.asDict() if a["is_pure_bath_bomb"] or c not in candidates]
        assert {c: a[c] for c in same} == {c: b[c] for c in same}
        assert a["is_pure_bath_bomb"] or not any(b[c] for c in candidates)
    assert any(a["cand_title"] for a in full if not a["is_pure_bath_bomb"])


def test_pages_in_batches_of_bounded_size(spark, tmp_path):
    """40 pages of 5 MB: no batch that goes to Python holds more than the bound and a page, so a task needs some of these and no more."""
    for i in range(40):
        (tmp_path / f"B{i:02d}.html").write_text(f"<p>{i}</p>" + "x" * 5_000_000)

    @F.pandas_udf("long")
    def batch_bytes(html: pd.Series) -> pd.Series:
        return pd.Series([html.str.len().sum()] * len(html))

    found = files.read_pages(spark, str(tmp_path), batch_bytes=8 << 20).select("asin", batch_bytes("html").alias("n")).collect()
    assert len(found) == 40 and max(r["n"] for r in found) <= (8 << 20) + 5_000_100


def test_pages_written_and_read(spark, tmp_path):
    rows = [("B1", "<p>é</p>\n"), ("a/b c=%", "two\n\nlines"), ("B3", ""), ("B4", None), (None, "lost")]
    files.write_pages(spark.createDataFrame(rows, "asin string, html string"), f"{tmp_path}/pages")
    (tmp_path / "pages" / "B5.html").write_bytes(b"plain \xff\n")
    got = {r["asin"]: r["html"] for r in files.read_pages(spark, f"{tmp_path}/pages").collect()}
    assert got == {"B1": "<p>é</p>\n", "a/b c=%": "two\n\nlines", "B3": "", "B4": "", "B5": "plain \n"}


def test_pages_are_packed(spark, tmp_path):
    """Files do not grow with the number of pages; single pages, written by either way, are read with them."""
    rows = [(f"B{i:04d}", f"<p>{i}</p>\n") for i in range(3000)]
    files.write_pages(spark.createDataFrame(rows, "asin string, html string").coalesce(2), f"{tmp_path}/pages")
    assert len([f for _, _, fs in os.walk(tmp_path) for f in fs if f.endswith(".parquet")]) <= 2
    files.write_page_files(spark.createDataFrame([("a/b", "x\n")], "asin string, html string"), f"{tmp_path}/single")
    assert [tuple(r) for r in files.read_pages(spark, f"{tmp_path}/single").collect()] == [("a/b", "x\n")]
    os.rename(f"{tmp_path}/single/page=a%2Fb.html", f"{tmp_path}/pages/page=a%2Fb.html")
    found = files.read_pages(spark, f"{tmp_path}/pages")
    assert {tuple(r) for r in found.collect()} == {*rows, ("a/b", "x\n")} and found.filter("asin = 'B0007'").count() == 1


def test_rows_of_one_file_are_dealt_to_tasks(spark, tmp_path):
    spark.range(12_000).select(F.col("id").alias("p_partkey"), *[F.lit("x").alias(c) for c in ("p_name", "p_brand", "p_type")], F.lit(3).alias("p_size")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    found = fixtures.listing_pages(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(found) == 3 and max(r["count"] for r in found) < 5_000


def test_fields_look_at_elements_once(spark):
    """Elements are found by their place, not by a search over the page in each expression."""
    df = spark.createDataFrame([("<p>",)], "h string").select(pages.page_fields(F.col("h")).alias("f"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "array_position" in plan and len(plan) < 25_000
    html = '<table id="productOverview_feature_div"><tr><td class="x">Size<td>big</table><td>after</td><i class="a-offscreens">$1</i><i class="b a-price"><i class="a-offscreen c">$2</i></i>'
    got = spark.createDataFrame([(html,), (None,)], "h string").select(pages.page_fields(F.col("h")).alias("f")).select("f.*").collect()
    assert (got[0]["size"], got[0]["price"], got[0]["title"]) == ("big", "$2", None) and got[1]["bullets"] == [] and got[1]["price"] is None
