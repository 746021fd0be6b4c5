import json
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import chat, common, mixing, url_lists

SCHEMAS = {"search": {"query": ("string", True), "limit": ("integer", False), "deep": ("object", False)}, "note": {"tags": ("array", True), "x": ("number", True), "on": ("boolean", False)}}


@pytest.fixture(scope="module")
def linked(spark):
    calls = [
        ("c", "1", 0, "search", '{"query": "é\\"", "limit": 3}', None), ("c", "2", 1, "search", '{"limit":1,"query":"b"}', ["1"]),
        ("c", "3", 2, "note", '{"tags": [1, {"b": 1, "a": 2}], "x": 1.5, "on": true}', ["2", "1"]), ("c", "4", 3, "note", '{"tags": "no", "x": "1"}', ["9"]),
        ("c", "5", 4, "other", "{}", ["6"]), ("c", "6", 5, "search", "{oops", ["5"]), ("c", "7", 6, "search", "[1]", ["6"]), ("c", None, 7, "search", '{"query":"q"}', ["1"]),
        ("d", "8", 0, "search", '{"query":"q","zz":1,"aa":2}', []), ("d", "8", 0, "search", '{"query":"q"}', []), ("d", "10", 1, None, None, None),
    ]
    results = [("c", "1", 1, "one"), ("c", "2", 3, "later"), ("c", "2", 2, "sooner"), ("c", "3", 9, None), ("x", "77", 1, "lost"), ("x", None, 1, "none"), ("d", "8", 1, "")]
    c = spark.createDataFrame(calls, "conv_id string, call_id string, turn long, name string, arguments string, depends_on array<string>")
    r = spark.createDataFrame(results, "conv_id string, call_id string, turn long, content string")
    return chat.link_calls(c, r, SCHEMAS).collect()


def test_links_and_levels(linked):
    assert len(linked) == 13
    by = {r["call_id"]: r for r in linked if r["call_id"] not in (None, "8")}
    assert [by[k]["topo_level"] for k in "1234567"] == [0, 1, 2, 0, None, None, None]
    assert by["1"]["valid"] and by["3"]["valid"] and not by["2"]["valid"]
    assert by["2"]["problems"] == "repeated_result" and json.loads(by["2"]["message"])["result"] == "sooner"
    assert set(by["4"]["problems"].split(",")) == {"no_result", "missing_dependency", "type:tags", "type:x"}
    assert set(by["5"]["problems"].split(",")) == {"no_result", "cycle", "unknown_tool"}
    assert set(by["6"]["problems"].split(",")) == {"no_result", "cycle", "bad_json"}
    assert "not_an_object" in by["7"]["problems"] and "cycle" in by["7"]["problems"]
    assert by["77"]["problems"] == "orphan_result" and by["77"]["conv_id"] == "x"
    assert [r["problems"] for r in linked if r["call_id"] is None and r["conv_id"] == "x"] == ["orphan_result,no_id"]
    assert set(by["10"]["problems"].split(",")) == {"no_result", "unknown_tool", "bad_json"}
    eight = sorted(r["problems"] for r in linked if r["call_id"] == "8")
    assert eight == ["repeated_call", "repeated_call,unexpected:aa+zz"]


def test_messages_are_canonical(linked):
    for r in linked:
        m = json.loads(r["message"])
        if "arguments" in m and isinstance(m["arguments"], dict):
            assert r["message"] == json.dumps(m, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    six = next(r for r in linked if r["call_id"] == "6")
    assert json.loads(six["message"])["arguments"] == "{oops"


def test_chat_empty(spark):
    conv = spark.createDataFrame([], "conv_id long, turn long, role string, text string, id string, level int")
    assert chat.link_calls(*chat.turns_as_calls(conv)).count() == 0
    rows = [(1, 0, "user", None, "", 1), (None, None, "user", "q", "", 1), (None, None, None, None, "", 1), (1, 1, "assistant", "x", "", 1), (1, 1, "assistant", "x", "", 1), (2, 0, "system", "s" * 100_000, "", 1)]
    got = chat.link_calls(*chat.turns_as_calls(spark.createDataFrame(rows, conv.schema))).collect()
    by = {r["call_id"]: r for r in got if r["call_id"]}
    assert "missing:query" in by["1:0"]["problems"] and "repeated_result" in by["1:0"]["problems"]
    assert by["2:0"]["problems"] == "no_result" and json.loads(by["2:0"]["message"])["arguments"]["policy"] == "s" * 100_000
    assert sorted(r["problems"].split(",")[0] for r in got if not r["call_id"]) == ["no_id", "orphan_result"]


def plain_links(calls, results):
    """(conv, call, turn, level, flags, result) of calls and orphans, row by row; levels by depth-first search."""
    known, answers, parents = defaultdict(int), defaultdict(list), defaultdict(set)
    for conv, call, _, deps in calls:
        known[conv, call] += 1
        parents[conv, call] |= {(conv, d) for d in deps or []}
    for conv, call, turn, content in results:
        answers[conv, call].append((turn, content))
    level, state = {}, {}
    for top in list(known):
        stack = [top]
        while stack:
            x = stack[-1]
            real = [p for p in parents[x] if p in known]
            if x not in state:
                state[x] = "open"
                stack += [p for p in real if p not in state]
                if any(state.get(p) == "open" for p in real):
                    level[x] = None
                continue
            stack.pop()
            if state[x] == "open":
                state[x] = "done"
                up = [level.get(p, 0) for p in real]
                level[x] = None if level.get(x, 0) is None or None in up else max((u + 1 for u in up), default=0)
    # A node that was met while open is on a cycle; what depends on it is behind one.
    for _ in known:
        behind = [x for x in known if level[x] is not None and any(p in known and level[p] is None for p in parents[x])]
        if not behind:
            break
        level |= dict.fromkeys(behind)
    out = []
    for conv, call, turn, deps in calls:
        x, got = (conv, call), answers.get((conv, call), [])
        flags = [("repeated_call", known[x] > 1), ("no_result", not got), ("repeated_result", len(got) > 1), ("missing_dependency", any(p not in known for p in parents[x])), ("cycle", level[x] is None)]
        out.append((conv, call, turn, level[x], ",".join(f for f, on in flags if on), min(got)[1] if got else None))
    for (conv, call), got in answers.items():
        if (conv, call) not in known:
            out += [(conv, call, t, None, "orphan_result" + ",repeated_result" * (len(got) > 1), c) for t, c in got]
    return sorted(out, key=str)


def test_links_equal_a_plain_version(spark):
    """Chains of 1,000 turns, ladders of two parents, forward and crossing dependencies, cycles, ids shared by conversations."""
    r = random.Random(5)
    calls = [("long", f"call_{i}", i, [f"call_{i - 1}"] if i else []) for i in range(1000)]
    calls += [("ladder", f"call_{i}", i, [f"call_{j}" for j in (i - 1, i - 2, r.randrange(i)) if j >= 0] if i else []) for i in range(60)]
    for c in range(30):
        n = r.randrange(1, 25)
        for i in range(n):
            deps = {f"call_{r.randrange(n + 1)}" if r.random() < 0.15 else f"call_{r.randrange(i + 1)}" for _ in range(r.randrange(3))}
            calls.append((f"c{c}", f"call_{i}", i, sorted(deps - ({f"call_{i}"} if r.random() < 0.9 else set()))))
    calls += [calls[5], calls[-1]]
    results = [(c, k, t + 1, f"{c} {k}") for c, k, t, _ in calls if r.random() < 0.9] + [("c1", "lost", 3, "a"), ("c1", "lost", 4, "b"), ("z", "call_0", 1, "other")]
    c = spark.createDataFrame([(a, b, t, "note", "{}", d) for a, b, t, d in calls], "conv_id string, call_id string, turn long, name string, arguments string, depends_on array<string>")
    got = chat.link_calls(c, spark.createDataFrame(results, "conv_id string, call_id string, turn long, content string"), {"note": {}}).collect()
    assert sorted(((r["conv_id"], r["call_id"], r["turn"], r["topo_level"], r["problems"], json.loads(r["message"])["result"]) for r in got), key=str) == plain_links(calls, results)


def docs(spark):
    r = random.Random(1)
    rows = [(i, " ".join(["w"] * r.randrange(1, 60)) + r.choice(["", "\n", " | ", " license "]), r.choice(["en", "fr", None]), r.choice(["a", "a", "a", "b", None]), 1.0) for i in range(400)]
    rows += [(900, None, "en", "empty-only", None), (None, "", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, weight double")


def test_topics_follow_the_anchor_words(spark):
    r = random.Random(6)
    rows = []
    for i in range(600):
        ws = ["the"] * 20 + [f"once{i}x{k}" for k in range(5)] + [r.choice(["Sea", "tax", "ball"]) for _ in range(r.randrange(4) if i % 8 == 0 else 0)]
        rows.append((i, r.choice([" ", "\n", "\t "]).join(ws)))
    rows += [(900, None), (901, " \n"), (902, "Sea " * 50_000 + "tax"), (903, "taxes balls")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    tokens = {i: (t or "").split() for i, t in rows}
    df = Counter(w for ws in tokens.values() for w in set(ws))
    n = len(rows)
    want = sorted((w for w, c in df.items() if max(2, 0.005 * n) <= c <= 0.09 * n), key=lambda w: (-df[w], w))[:2][::-1]
    found = mixing.anchors(d, most=2, shares=(0.005, 0.09))
    assert found == [(w, df[w]) for w in want]
    topic = lambda ws: "empty" if not ws else next((w for w in want if w in ws), "other")
    got = {r["doc_id"]: r["t"] for r in d.select("doc_id", mixing.anchored(F.col("text"), found).alias("t")).collect()}
    assert got == {i: topic(ws) for i, ws in tokens.items()} and {"empty", "other", *want} == set(got.values())
    assert mixing.anchors(d.limit(0)) == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_no_topic_has_most_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    shares = [r["count"] / d.count() for r in mixing.mixture(d).groupBy("topic").count().collect()]
    assert len(shares) > 12 and max(shares) < 0.25


def test_raking_meets_the_targets(spark):
    d = docs(spark)
    marked = F.when(F.col("text").contains("license"), "legal").when(F.col("text").contains("|"), "table").otherwise(F.lit("prose"))
    out = mixing.mixture(d, share=0.5, topic=marked).collect()
    assert {r["topic"] for r in out} == {"legal", "table", "prose"}
    assert len(out) == d.count()
    cells = defaultdict(int)
    for r in out:
        cells[r["source"], r["lang"], r["topic"]] += r["n_tokens"]
    w = {k: float(v) for k, v in cells.items() if v}
    total = sum(w.values())
    assert all(r["residual"] <= mixing.TOLERANCE for r in out)
    target = []
    for i in range(3):
        s = defaultdict(int)
        for k, v in cells.items():
            s[k[i]] += v
        z = {k: v**mixing.ALPHA for k, v in s.items() if v}
        target.append({k: v / sum(z.values()) for k, v in z.items()})
    for _ in range(300):
        for i in range(3):
            s = defaultdict(float)
            for k, v in w.items():
                s[k[i]] += v
            w = {k: v * target[i][k[i]] * total / s[k[i]] for k, v in w.items()}
    for r in out:
        want = w.get((r["source"], r["lang"], r["topic"]), 0) / max(1, cells[r["source"], r["lang"], r["topic"]])
        assert np.isclose(r["weight"], want, rtol=1e-4), r
    assert np.isclose(sum(r["keep_prob"] * r["n_tokens"] for r in out), 0.5 * total, rtol=1e-6)
    kept = sum(r["n_tokens"] for r in out if r["kept"])
    assert 0.35 * total < kept < 0.65 * total


def test_raking_writes_plans_of_few_joins(spark, monkeypatch):
    """However many rounds, a step's plan is one sum and one join, and its table takes the place of the one before."""
    joins, write = [], common.materialize

    def counted(df, tag):
        joins.append((tag, df._jdf.queryExecution().optimizedPlan().toString().count("Join ")))
        return write(df, tag)

    monkeypatch.setattr(mixing, "materialize", counted)
    monkeypatch.setattr(common, "materialize", counted)
    r = random.Random(9)
    rows = [(f"s{i % 7}", "abc"[i % 3], f"t{i % 5}", r.randrange(1, 10_000)) for i in range(105) if i % 4]
    cells, mark = write(spark.createDataFrame(rows, "source string, lang string, topic string, tokens long"), "cells"), common.written()
    raked, residual = mixing.rake(cells, mixing.smoothed_targets(cells))
    steps = [n for tag, n in joins if tag == "rake"]
    assert len(steps) > 6 and set(steps[1:]) == {1} and max(n for _, n in joins) <= 3
    assert residual <= mixing.TOLERANCE and raked.count() == len(rows)
    assert sum("-rake-" in p for p in common._WRITTEN[mark:]) == 1


def test_targets_from_outside_and_levels_named_like_null(spark):
    rows = [(i, "w " * (1 + i % 3), "en" if i % 2 else None, "<null>" if i % 5 else None, "mine", "own", i) for i in range(200)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _source string, _Weight string, _tokens long")
    share = lambda name, *v: spark.createDataFrame(v, f"{name} string, share double")
    targets = {"source": share("source", ("<null>", 1.0), (None, 3.0), ("absent", 5.0)), "lang": share("lang", ("en", 0.9), (None, 0.1)), "topic": share("topic", ("other", 2.0))}
    out = mixing.mixture(d, share=0.5, targets=targets).collect()
    whole = sum(r["weight"] * r["n_tokens"] for r in out)
    of = lambda f: sum(r["weight"] * r["n_tokens"] for r in out if f(r)) / whole
    assert np.isclose(of(lambda r: r["source"] is None), 0.75, atol=1e-5) and np.isclose(of(lambda r: r["lang"] == "en"), 0.9, atol=1e-5)
    assert all(r["residual"] < 1e-5 for r in out)
    kept = mixing.sample_documents(d, share=0.5, targets=targets, max_residual=0.01)
    assert kept.columns == [*d.columns, "weight"] and {r["_source"] for r in kept.collect()} == {"mine"} and {r["_Weight"] for r in kept.collect()} == {"own"}


def test_targets_that_cannot_be_met_are_reported(spark):
    d = spark.createDataFrame([(1, "w w", "en", "a"), (2, "w w", "fr", "b")], "doc_id long, text string, lang string, source string")
    targets = {"source": spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, share double"), "lang": spark.createDataFrame([("en", 0.1), ("fr", 0.9)], "lang string, share double"), "topic": spark.createDataFrame([("other", 1.0)], "topic string, share double")}
    assert mixing.mixture(d, targets=targets).first()["residual"] > 0.1
    with pytest.raises(ValueError, match="cannot be met"):
        mixing.sample_documents(d, targets=targets, max_residual=0.01)


def test_sampled_documents(spark):
    d = docs(spark)
    kept = mixing.sample_documents(d, share=0.5)
    assert kept.columns == ["doc_id", "text", "lang", "source", "weight"]
    want = {r["doc_id"] for r in mixing.mixture(d, share=0.5).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == want
    assert mixing.sample_documents(d.limit(0)).count() == 0
    assert mixing.mixture(d.filter("text is null")).filter("kept").count() == 0


def test_capped_probabilities(spark):
    raked = spark.createDataFrame([(10, 100.0), (100, 100.0), (1000, 100.0)], "tokens long, weight double")
    got = [r["keep_prob"] for r in mixing.keep_probabilities(raked, 0.5).orderBy("tokens").collect()]
    assert got[:2] == [1.0, 1.0] and np.isclose(got[2], (555 - 110) / 1000)


def test_url_lists(spark):
    captures = spark.createDataFrame(
        [(1, "http://a.b.example.com/x", 5), (1, "http://a.b.example.com/x", 5), (2, "https://user@A.b.example.com:8080?q", 10), (3, "http://other.com", 10), (4, None, 10), (5, "nonsense", 10), (6, "http://a.b.example.com", None), (7, "http://example.com#x", 15), (8, "http://localhost/", 1)],
        "page_id long, url string, fetched int",
    )
    entries = spark.createDataFrame(
        [("l", "a.b.example.com", 5, "add"), ("l", "a.b.example.com", 10, "remove"), ("l", "a.b.example.com", 10, "add"), ("m", "Example.com", 7, "add"), ("m", "example.com", 15, "remove"), ("m", "other.com", 11, "add"), ("m", None, 0, "add"), ("m", "other.com", None, "add"), ("k", "localhost", 0, "add"), ("z", "com", 0, "add")],
        "list string, pattern string, at int, action string",
    )
    got = sorted((r["page_id"], r["lists"], r["blocked"]) for r in url_lists.evaluate(captures, entries).collect())
    assert got == [(1, "l", True), (1, "l", True), (2, "m", True), (3, "", False), (4, "", False), (5, "", False), (6, "", False), (7, "", False), (8, "k", True)]
    assert url_lists.evaluate(captures, entries.limit(0)).filter("blocked").count() == 0
    assert url_lists.evaluate(captures.limit(0), entries).count() == 0


def test_url_list_entries_of_many_labels(spark):
    deep = ".".join(f"l{k}" for k in range(40))
    captures = spark.createDataFrame([(1, "http://a.b.c.d.e.f.g.h/x", 5), (2, f"http://top.{deep}/", 5), (3, "http://xb.c.d.e.f.g.h/", 5)], "page_id long, url string, fetched int")
    entries = spark.createDataFrame([("l", "b.c.d.e.f.g.h", 0, "add"), ("m", deep, 0, "add")], "list string, pattern string, at int, action string")
    assert sorted((r["page_id"], r["lists"]) for r in url_lists.evaluate(captures, entries).collect()) == [(1, "l"), (2, "m"), (3, "")]


def test_url_lists_keep_columns_of_any_name(spark):
    captures = spark.createDataFrame([("http://a.b/", 5, "u", "v", "w", "old")], "url string, fetched int, _at string, _h string, _host string, Host string")
    entries = spark.createDataFrame([("l", "a.b", 0, "add")], "list string, pattern string, at int, action string")
    got = url_lists.evaluate(captures, entries).collect()
    assert [r.asDict() for r in got] == [{"url": "http://a.b/", "fetched": 5, "_at": "u", "_h": "v", "_host": "w", "host": "a.b", "lists": "l", "blocked": True}]
