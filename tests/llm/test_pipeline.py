import os
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import mixing, near_copies, simhash
from tallyspark.llm.common import BATCH_BYTES
from tests.llm import brute

ALPHABET = {"en": "abcdefgh", "fr": "mnopqrst"}


def text(lang, seed, n=60):
    r = random.Random(seed)
    return " ".join("".join(r.choice(ALPHABET[lang]) for _ in range(r.randrange(2, 9))) for _ in range(n))


def test_stages_in_turn(spark, tmp_path):
    leak = text("en", 999, 15)
    rows = [(i, text("en" if i % 2 else "fr", i), "en" if i % 2 else "fr", f"s{i % 3}", 1) for i in range(120)]
    rows += [(200, rows[3][1], "en", "s0", 1), (201, "123 %%", "en", "s1", 1), (202, None, "en", "s1", 1), (203, text("en", 5001) + " " + leak + " " + text("en", 5002), "en", "s2", 1)]
    rows += [(204, text("fr", 5003) + " password=abcdefgh99 ", "fr", "s2", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    ids = lambda d: {r["doc_id"] for r in d.collect()}
    every = ids(docs)
    stages = dict(corpus_pipeline.STAGES)
    left = stages["language"](spark, docs, str(tmp_path))
    assert left.columns == columns and ids(left) == every - {201, 202}
    left = stages["near_duplicates"](spark, left, str(tmp_path))
    assert left.columns == columns and ids(left) == every - {200, 201, 202}
    left = stages["decontaminate"](spark, left, str(tmp_path))
    assert left.columns == columns and ids(left) == every - {200, 201, 202, 203}
    left = stages["secrets"](spark, left, str(tmp_path))
    assert left.columns == columns and ids(left) == every - {200, 201, 202, 203}
    assert not any(brute.secrets(r["text"])["_text"] for r in left.collect())
    last = stages["mixture"](spark, left, str(tmp_path))
    assert last.columns == [*columns, "weight"] and ids(last) < ids(left)
    assert {tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {tuple(r) for r in last.collect()}


def test_weights_do_not_depend_on_the_order_of_rows(spark):
    """Sums of doubles differ in their last digits by order; the weights of two runs over the same documents are equal to the bit."""
    r = random.Random(8)
    rows = [(i, " ".join(r.choice(("aa", "bb", "cc", "dd", "ee", "ff")) for _ in range(r.randrange(1, 30))), r.choice("xyz"), f"s{int(r.random() ** 2 * 40)}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    orders = (docs.orderBy("doc_id").coalesce(1), docs.orderBy(F.desc("doc_id")).coalesce(1), docs.repartition(3))
    found = [{tuple(x) for x in mixing.mixture(d).collect()} for d in orders]
    assert len(found[0]) == 600 and found[0] == found[1] == found[2]


def edges_of(spark, pairs):
    return {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}


def test_components_end_when_each_node_has_its_root(spark, monkeypatch):
    """Stars and no edges are written once and gone through no further; a chain in any direction is brought to its least node."""
    written, write = [], simhash.materialize
    monkeypatch.setattr(simhash, "materialize", lambda df, tag: written.append(tag) or write(df, tag))
    assert edges_of(spark, [(5, 5)]) == {} and edges_of(spark, [(1, 7), (8, 1), (-3, 9), (9, -3), (4, 4)]) == {7: 1, 8: 1, 9: -3}
    assert len(written) == 2
    chain = [(k, k + 1) if k % 3 else (k + 1, k) for k in range(-10, 30)]
    assert edges_of(spark, [*chain, (100, 101), (102, 101), (102, 103)]) == {k: -10 for k in range(-9, 31)} | {101: 100, 102: 100, 103: 100}


def edited(words, edits, seed):
    """words with single words replaced, far apart: each takes five of the len(words) - 4 shingles."""
    out = list(words)
    for k in range(edits):
        out[6 + 12 * k] = f"edit{seed}x{k}"
    return " ".join(out)


def test_edited_copies_around_the_similarity(spark):
    rows, want = [], set()
    for i in range(60):
        words = text("en", 7000 + i, 200).split()
        words = [f"{w}{i}" for w in words]
        # Of 196 shingles: 4 edits leave a similarity of 176 / 216 = 0.815, 5 edits one of 171 / 221 = 0.774.
        rows += [(10 * i, " ".join(words)), (10 * i + 1, edited(words, 4 + i % 2, i))]
        want |= {10 * i} | ({10 * i + 1} if i % 2 else set())
    # A chain: each is near the next alone.
    words = [f"chain{k}" for k in range(200)]
    rows += [(1000 + k, " ".join(words[10 * k :] + [f"more{j}" for j in range(10 * k)])) for k in range(5)]
    # Repeats, letter case and a large group of near copies.
    rows += [(2000 + k, edited([f"big{j}" for j in range(300)], 1, k)) for k in range(300)]
    rows += [(3000, "few words"), (3001, "FEW  words"), (3002, "other words"), (3003, ""), (3004, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want | {1000, 2000, 3000, 3002, 3003})


DATA = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_near_copies_of_the_tables_equal_all_pairs(spark):
    """Groups by all pairs that share a shingle, with their whole sets; one document of each group stays."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    sets, sharing = {}, defaultdict(list)
    for r in docs.collect():
        ws = brute.words((r["text"] or "").translate(brute.LOWER))
        sets[r["doc_id"]] = {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)}
    for i, found in sets.items():
        for g in found:
            sharing[g].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in {(a, b) for ids in sharing.values() for i, a in enumerate(ids) for b in ids[i + 1 :]}:
        both = len(sets[a] & sets[b])
        if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
            root[max(find(a), find(b))] = min(find(a), find(b))
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, DATA)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({find(i) for i in sets})


def test_copies_of_a_text_that_are_apart_from_each_other(spark):
    """400 copies at 0.83 of one text, at 0.7 of each other; no bucket is small, so they meet through their leaders alone."""
    r = random.Random(11)
    base = [f"w{k}" for k in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        out = list(base)
        for k in sorted(r.sample(range(10), 3)):
            out[6 + 18 * k] = f"edit{i}x{k}"
        out[3] = f"first{i}"
        rows.append((i, " ".join(out)))
    rows += [(1000 + i, " ".join(f"far{i}x{k}" for k in range(100))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for cell in (near_copies.CELL, 100_000):  # one cell, and a grid of many
        found = near_copies.groups(docs, cell=cell).groupBy("root").count().collect()
        assert sorted(x["count"] for x in found) == [1] * 20 + [400]


def form_letters(n, planted, common, own, edits):
    """n letters of common words, each with its own words at the end, and copies of the first ones with some of these changed."""
    base = [f"c{k}" for k in range(common)]
    rows = [(i, [*base, *(f"o{i}x{k}" for k in range(own))]) for i in range(n)]
    rows += [(n + i, [*rows[i][1][:common], *(f"e{i}x{k}" for k in range(edits)), *rows[i][1][common + edits :]]) for i in range(planted)]
    return [(i, " ".join(w)) for i, w in rows]


@pytest.mark.parametrize(("cell", "grid", "least"), [(near_copies.CELL, near_copies.GRID, 60), (150_000, None, 60), (150_000, 1, 54)])
def test_pairs_among_form_letters_are_linked(spark, cell, grid, least):
    """600 letters at 0.78 of each other, 60 of them with a copy at 0.81: in one cell, in a grid of cells, and dealt again by further bands."""
    rows = form_letters(600, 60, 185, 25, 17)
    found = {r["_key"]: r["root"] for r in near_copies.groups(spark.createDataFrame(rows, "doc_id long, text string"), cell=cell, grid=grid).collect()}
    assert sum(found[i] == found[600 + i] for i in range(60)) >= least
    assert len(set(found.values())) == 660 - sum(found[i] == found[600 + i] for i in range(60))  # and nothing else


def test_no_pair_of_a_large_bucket_is_lost(spark):
    """300 of 700 letters have a copy at 0.807; their buckets are dealt again by further bands, at which some of these pairs part."""
    rows = form_letters(700, 300, 185, 25, 18)
    found = {r["_key"]: r["root"] for r in near_copies.groups(spark.createDataFrame(rows, "doc_id long, text string"), cell=150_000, grid=1).collect()}
    assert all(found[i] == found[700 + i] for i in range(300)) and len(set(found.values())) == 700


def test_overlaps_are_counted_exactly(monkeypatch):
    monkeypatch.setattr(near_copies, "TILE", 7)
    r = random.Random(4)
    sets = [np.array(sorted(r.sample(range(-40, 40), r.randrange(0, 40))), np.int64) for _ in range(30)]
    left, right = np.arange(0, 30, 2), np.arange(5, 30)
    want = [[len({*sets[i]} & {*sets[j]}) for j in right] for i in left]
    assert near_copies.overlaps(sets, left, right).tolist() == want
    assert near_copies.overlaps([], left[:0], right[:0]).shape == (0, 0)


def test_overlaps_need_few_times_their_sets():
    """What a Python worker holds of a full cell: some four times its shingles, and the tiles."""
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 1 << 40, 4000)) for _ in range(250)]
    sets[1:] = [np.unique(np.concatenate([s[:2000], sets[0][:2000]])) for s in sets[1:]]
    left, right = np.arange(20), np.arange(20, 250)
    tracemalloc.start()
    found = near_copies.overlaps(sets, left, right)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.min() >= 2000 - 1 and most < 5.5 * sum(s.nbytes for s in sets)


def test_texts_of_few_candidates_are_found_without_python(spark):
    """All wanted rows and few others, by expressions alone, so a task that cuts shingles has one Python worker."""
    docs = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id")).alias("_doc"), F.concat(F.lit("t"), F.col("id") % 5000).alias("_text"))
    wanted = docs.filter("_doc IS NULL OR _doc % 37 = 0").select(F.col("_doc").alias("_key"), F.xxhash64("_text").alias("_text_hash"))
    found = near_copies.among(docs, wanted)
    ids, want = ({r[0] for r in d.collect()} for d in (found.select("_doc"), wanted.select("_key")))
    assert found.columns == docs.columns and want <= ids and len(ids) < 2 * len(want) and None in ids
    assert near_copies.among(docs, wanted.filter("false")).count() == 0
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_near_copies_go_to_python_in_small_batches(spark, monkeypatch):
    sizes, plain = set(), near_copies.materialize
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    monkeypatch.setattr(near_copies, "materialize", lambda df, tag: (sizes.add(df.sparkSession.conf.get(key)), plain(df, tag))[1])
    docs = spark.createDataFrame([(i, text("en", i % 30)) for i in range(60)], "doc_id long, text string")
    assert near_copies.groups(docs).select("root").distinct().count() == 30
    assert sizes == {str(BATCH_BYTES)} and spark.conf.get(key) != str(BATCH_BYTES)


def test_stages_on_empty_tables_and_clashing_names(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, _text string, _hash string, _key long, _cell int, Weight string, _words int, score string, Held_out int"
    spark.createDataFrame([(1, "aa bb")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, text("en" if i % 2 else "fr", i), "en" if i % 2 else "fr", "s", "t", "h", i, i, "w", i, "mine", 7) for i in range(40)] + [(None, text("en", 99), *[None] * 8, "mine", 7)] * 2
    for data, n in ((rows, 41), ([], 0)):
        left = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, left, str(tmp_path))
            assert out.columns == left.columns, name
            left = out
        assert left.count() == n and {(r["score"], r["Held_out"]) for r in left.collect()} <= {("mine", 7)}
        last = corpus_pipeline.STAGES[-1][1](spark, left, str(tmp_path))
        assert last.columns == [*(c for c in left.columns if c != "Weight"), "weight"] and last.count() <= n
