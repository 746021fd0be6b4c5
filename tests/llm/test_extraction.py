import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import extraction as ex

ARTICLE = "<h1>A &amp;amp; title</h1><p><b>First  one.<br><p>Second &eacute;&nbsp;two,\n three.</p><ul><li>Point<li>Next <i>point</i></ul><blockquote>Said.</blockquote>"
WANT = "A &amp; title\nFirst one.\nSecond é two, three.\nPoint\nNext point\nSaid."
PAGES = [
    f"<!DOCTYPE html><html><head><title>x</title><script>var a='</p>'</script></head><body><nav><ul><li><a href=/a>Home</a></ul></nav><article>{ARTICLE}</article><footer>&copy; me</footer></body></html>",
    f"<body><header class='site-header'><a href=/>Site</a><p>Words of the site</p></header><main><article>{ARTICLE}<aside class=related><h3>More</h3><ul><li><a href=/b>Other</a></ul></aside></article></main><section id=comments class=comments><h2>2 comments</h2><div class=comment><p>I like this very much, thank you.</p></div></section>",
    f"<div class='cookie-banner'><p>We use cookies on this site.</p><button>Fine</button></div><div id=menu class=menu><a href=/>Home</a> <a href=/n>News</a></div><div class='entry-content'>{ARTICLE}<div class='advert'>Buy this now.</div></div><form class=search><label>Find</label><input><button>Go</button></form><div class=footer>&copy; 2020 Us</div>",
    f"<table><tr><td class=sidebar><ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul><td class=content>{ARTICLE}</table><noscript>Turn it on</noscript><style>p{{}}</style><!-- end",
]


@pytest.fixture(scope="module")
def weights():
    return ex.learn([])


def test_pages_of_several_forms(weights):
    assert ex.main_text([ex.Page(p) for p in PAGES], *weights) == [WANT] * len(PAGES)


def test_labels_of_unseen_layouts(weights):
    """Layouts drawn apart from those learnt from: block by block, and whole pages."""
    right = wrong = whole = 0
    for k in range(150):
        r = random.Random(10**6 + k)
        page = ex.Page(ex.layout([" ".join(ex._invented(r, r.choice((1, 4, 30)))) for _ in range(r.randint(2, 12))], ex._invented(r, 200), r), "given")
        p = ex.Forest([page]).marginals(*weights)[0][:, 1]
        same = [(p[i] >= ex.THRESHOLD) == page.label[i] for i, _, _ in page.blocks]
        right, wrong, whole = right + sum(same), wrong + len(same) - sum(same), whole + all(same)
    assert right / (right + wrong) > 0.98 and whole > 130


def test_marginals_equal_sums_over_all_labellings():
    r = np.random.default_rng(1)
    pages = [ex.Page(p) for p in ("<div><p>a</p><p>b</p><ul><li>c</ul></div>", "<article>d</article>", "")]
    node, edge = r.normal(size=1 << ex.BITS), r.normal(size=(ex.KINDS, 2, 2))
    got, pairs = ex.Forest(pages).marginals(node, edge)
    at = 0
    for page in pages:
        own, n = [sum(node[f] for f in fs) for fs in ex.features(page)], len(page.tag)
        kinds = [ex._hashed(f"edge:{t}") % ex.KINDS for t in page.tag]
        want, joint, total = np.zeros((n, 2)), np.zeros((n, 2, 2)), 0.0
        for code in range(1 << n):
            y = [code >> i & 1 for i in range(n)]
            p = np.exp(sum(own[i] * y[i] for i in range(n)) + sum(edge[kinds[i], y[page.up[i]], y[i]] for i in range(1, n)))
            total += p
            for i in range(n):
                want[i, y[i]] += p
                joint[i, y[page.up[i]], y[i]] += p * (i > 0)
        assert np.allclose(got[at : at + n], want / total) and np.allclose(pairs[at : at + n], joint / total)
        at += n


def test_fitting_ascends_the_likelihood():
    pages = [ex.Page(ex.layout(["one two", "three four five."], ["x", "y"], random.Random(k)), "given") for k in range(20)]

    def likelihood(node, edge):
        forest, total = ex.Forest(pages), 0.0
        y = forest.label
        own = np.bincount(forest.row, weights=node[forest.feature], minlength=forest.n)
        inner = np.flatnonzero(forest.up >= 0)
        total += own[y == 1].sum() + edge[forest.kind[inner], y[forest.up[inner]], y[inner]].sum()
        up = np.zeros((forest.n, 2))
        up[:, 1] = own
        for level in forest.levels[:0:-1]:
            np.add.at(up, forest.up[level], np.logaddexp.reduce(edge[forest.kind[level]] + up[level, None, :], axis=2))
        return total - np.logaddexp.reduce(up[forest.up < 0], axis=1).sum()

    values = [likelihood(*ex.fit(pages, rounds)) for rounds in (1, 10, 60)]
    assert values[0] < values[1] < values[2] <= 0


def test_reading_of_markup():
    text = lambda h: [t for _, t, _ in ex.Page(h).blocks]
    assert text("a < b &lt;p&gt; &amp;lt; <p title='x > y'>c</p>d") == ["a < b <p> &lt;", "c", "d"]
    assert text("<p>one<div>two</p>three</div>four") == ["one", "two", "three", "four"]
    assert text('<p>kept<a href="never ends>lost</p>') == ["kept"]
    assert text("<script>if (a < b) '<p>no</p>'</script >yes<textarea>no</textarea><select><option>no</select><!-- no -->!") == ["yes", "!"]
    assert text("<dl><dt>a<dd>b<dt>c</dl><table><tr><td>d<td>e<tr><td>f</table>") == ["a", "b", "c", "d", "e", "f"]
    assert text("<ul><li>a<ul><li>b</ul>c<li>d</ul>") == ["a", "b", "c", "d"]
    assert text("</p></div></b>x<hr>y<br>z &am &amp &#65;") == ["x", "y z &am & A"]
    assert len(text("<div>" * 3000 + "deep" + "<p>p" * 3000)) == 3001


def test_tables_of_any_kind(spark):
    rows = [(i, None if i == 3 else f"u{i}", p, "mine", i) for i, p in enumerate([*PAGES, None, "", "no markup at all", "<p>" + "long " * 200_000])]
    rows += [rows[0], (None, None, PAGES[0], None, None)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, _main_text int")
    assert ex.extract(table.withColumn("more", F.create_map(F.lit("a"), F.col("page_id")))).count() == len(rows)
    found = ex.extract(table)
    assert sorted(found.columns) == sorted(["page_id", "url", "_main_text", "text"])
    got = [(r["page_id"], r["text"]) for r in found.collect()]
    assert len(got) == len(rows) and got.count((0, WANT)) == 2 and (None, WANT) in got
    assert {t for i, t in got if i in (4, 5)} == {""}
    query = ex.main_texts(table)
    assert query.columns == ["page_id", "url", "text", "n_chars"] and all(r["n_chars"] == len(r["text"]) for r in query.collect())
    assert ex.main_texts(table.limit(0)).count() == 0


def test_model_does_not_depend_on_partitions(spark):
    rows = [(i, PAGES[i % 3].replace("First", f"First{i}")) for i in range(40)]
    table = spark.createDataFrame(rows, "page_id long, html string")
    one, many = (ex.model(table.repartition(n), max_train=10) for n in (1, 7))
    assert (one[0] == many[0]).all() and (one[1] == many[1]).all()
    assert ex.labelled_sample(table, "html", 10).count() <= 10
