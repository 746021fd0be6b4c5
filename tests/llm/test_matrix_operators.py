import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import negatives, ranking
from tests.llm import brute


def ranked(docs, items, top=50):
    """The contract in plain Python."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    split = lambda t: term.findall((t or "").translate(brute.LOWER))
    found = [(i, Counter(split(t))) for i, t in docs if split(t)]
    n, length = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item in {i for i, _ in items}:
        wanted = {t for i, x in items if i == item for t in split(x)}
        scores = []
        for i, c in found:
            m = 50 + (50 * sum(c.values()) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if c[t])
            scores += [(-s, i is None, i or 0, i)] if s else []
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:top])]
    return out


TEXTS = ["Red fox", "red FOX", "the red_fox-ran; the end", None, "", " .!? ", "ünï çod red", "ünï Çod", "fox " * 3000 + "rare", "a b c d e f g"] + [f"the common text {i % 7} fox" for i in range(200)]
ITEMS = [(1, "red fox rare"), (1, "ünï"), (2, None), (3, "absent words"), (4, "the the common fox Çod"), (None, "red"), (4, "the the common fox Çod")]


@pytest.mark.parametrize(("limit", "tile", "top"), [(1 << 20, 1024, 50), (64, 3, 5)])
def test_search_equals_the_formula(spark, monkeypatch, limit, tile, top):
    for name in ("DOC_TILE", "TERM_TILE", "ITEM_TILE"):
        monkeypatch.setattr(ranking, name, tile)
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "red fox", "y", 2), (3, TEXTS[0], "z", 3), (0, TEXTS[0], "again", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string, score int").repartition(3)
    items = spark.createDataFrame([(*r, "clash") for r in ITEMS], "item_id long, text string, doc_id string")
    got = [tuple(r) for r in ranking.search(docs, items, top=top, max_item_bytes=limit).collect()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(ranked([r[:2] for r in rows], ITEMS, top), key=key)


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, None), (2, "--")], "doc_id long, text string"), spark.createDataFrame([(1, "red")], "item_id long, text string")
    assert ranking.search(docs, items).count() == 0
    assert ranking.search(docs.limit(0), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_no_partial_sum_reaches_the_bound():
    assert ranking.term_tile(np.array([26_000])) == 1024
    heavy = np.array([5 * 10**8])
    width = ranking.term_tile(heavy)
    assert width >= 1 and width * int(heavy[0]) * 1_000_000 < ranking.EXACT
    # Sums over many tiles are whole beyond what one float holds.
    n = 40
    got = ranking.tile_scores([np.arange(n)], np.full(n, 5 * 10**8 + 1), np.zeros(n, np.int64), np.arange(n), np.full(n, 999_999), 1)
    assert int(got[0, 0]) == n * (5 * 10**8 + 1) * 999_999


def test_strassen_is_exact():
    r = np.random.default_rng(3)
    for m, k, n in ((1, 1, 1), (70, 64, 90), (33, 130, 65), (128, 128, 128), (5, 64, 300), (0, 4, 3)):
        a, b = r.integers(-(2**28), 2**28, (m, k)), r.integers(-(2**28), 2**28, (k, n))
        assert (negatives.strassen(a, b) == a @ b).all()
        assert (negatives.strassen(a, b, leaf=2) == a @ b).all()


def test_heaps_merge_in_any_order():
    r = random.Random(5)
    for k in (1, 3):
        every = [(r.randrange(4), r.randrange(6) - 3, r.randrange(9)) for _ in range(400)]
        heaps = negatives.Heaps(4, k)
        for s in range(0, 400, 7):
            heaps.add(*(np.array(c, np.int64) for c in zip(*every[s : s + 7], strict=True)))
        want = [x for i in range(4) for x in sorted({(i, -s, d) for j, s, d in every if j == i})[:k]]
        assert list(zip(heaps.of.tolist(), (-heaps.score).tolist(), heaps.id.tolist(), strict=True)) == want


def mined(rows):
    """The contract in plain Python, over unique ids."""
    live = []
    for i, v, label in rows:
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        live.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for i, v, label in live:
        if i is None or i % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j is None, j or 0, j, l) for j, w, l in live if j != i and len(w) == len(v))
        for p in [s for s in scored if s[4] == label][:5]:
            near = [s for s in scored if s[4] != label and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]][:3]
            out += [(i, p[3], r + 1, s[3], -p[0], -s[0]) for r, s in enumerate(near)]
    return out


@pytest.mark.parametrize("blocks", [(2048, 32768), (2, 30)])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "TILE", 16)
    monkeypatch.setattr(negatives, "LEAST_BLOCK", 40)
    r = random.Random(9)
    rows = [(i - 100, [round(r.uniform(-1, 1), 2) for _ in range(7)], r.randrange(4)) for i in range(300)]
    rows += [(1000 + i, [0.5] * 7, i % 3) for i in range(60)]  # equal vectors: ties
    rows += [(2000, None, 1), (2001, [1.0], None), (2002, [None] * 7, 1), (2003, [math.nan] * 7, 1), (2004, [math.inf] * 7, 1), (2005, [], 1), (None, [0.9] * 7, 2), (2050, [1.0, 2.0], 0), (2051, [1.0, 2.0], 0), (2052, [1.0, 1.0], 1), (2100, [0.0] * 7, 3)]
    rows += [(2150, [1000.0, -1e6, 3.0, 0.0, 0.0, 0.0, 0.0], 2), (2151, [1000.0, -1e6, 2.0, 0.0, 0.0, 0.0, 0.0], 2), (2152, [1000.0, -9e5, 2.0, 0.0, 0.0, 0.0, 0.0], 1)]
    table = spark.createDataFrame([(*x, 5) for x in rows], "vec_id long, embedding array<float>, label int, d int").repartition(3)
    key = lambda x: tuple((v is None, v or 0) for v in x)
    got = sorted((tuple(x) for x in negatives.hard_negatives(table, label=negatives.noisy_label(), blocks=blocks).collect()), key=key)
    assert got == sorted(mined(rows), key=key) and len(got) > 50
    again = negatives.hard_negatives(table.union(table), label=negatives.noisy_label(), blocks=blocks)
    assert sorted((tuple(x) for x in again.collect()), key=key) == got  # repeated rows count once
    assert negatives.hard_negatives(table.limit(0)).count() == 0
    assert negatives.hard_negatives(table.filter(F.col("vec_id") % 50 != 0)).count() == 0
