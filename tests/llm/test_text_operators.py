import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import decontaminate, langid, near_copies, quality, secrets, simhash
from tests.llm import brute

PROSE = "the cat sat on the mat and the dog ran over the hill while rain fell on the old town square all day long".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(PROSE) + str(r.randrange(50)) for _ in range(n))


BASE = prose(120, 1)
HEX = "0123456789abcdef" * 3
TEXTS = [
    BASE, BASE, BASE.upper(), BASE + " end", None, "", " \t\n ", "x", "one two", prose(400, 2),
    "line a b\nline a b\n\n \nline a b\n" + prose(30, 3), " ".join(["a b c d e f g h"] * 9), "same " * 5000,
    f"my password = 'abcdefgh1' and token:short then API_KEY: {HEX} é AKIA{'B' * 20} {HEX}", "password:token:abcdefghij secret=abcdefgh",
    "🙂 token=🙂 Secret='ABCDEFGH.x' AKIAAKIA0000", "#*$ %& |<> " * 10, prose(20, 4) + " The QUICK brown-fox, jumps over_the lazy dog & runs far away home " + prose(20, 5),
    "short item here", "ünïcode wörds häre çedilla ñandu œuvre ßtraße ámbar ígneo óxido último extra",
    "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 40, "a\x0bb\x0cc\rd\x1fe f", prose(9000, 6),
]
ITEMS = [(1, "the quick brown fox jumps over the lazy dog runs far away"), (2, "short ITEM"), (10, "short item"), (3, None), (4, "!!"), (5, "ünïcode wörds häre çedilla ñandu œuvre ßtraße ámbar ígneo óxido último"), (None, "same same same"), (2, "one two")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"src{i % 3}" if i % 5 else None, 7) for i, t in enumerate(TEXTS)]
    rows += [(3, TEXTS[3], None, None, None), (None, BASE, None, "src1", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def compare(found, want, names):
    key = lambda x: tuple((v is not None, str(v)) for v in x)
    got = sorted((tuple(r[n] for n in names) for r in found.collect()), key=key)
    assert got == sorted((tuple(w[n] for n in names) for w in want), key=key)


def test_quality(docs):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = quality.host_quality(docs)
    compare(found, [{"doc_id": i} | brute.quality(t) for i, t in rows(docs)], names)
    assert all(not (r["kept"] and r["base_failed"]) for r in found.collect())


def test_host_prior_moves_small_hosts_to_the_mean(spark):
    good, bad = prose(40, 7), "x"
    data = [(i, good, "big") for i in range(300)] + [(1000 + i, bad, "worst") for i in range(300)] + [(2000, bad, "one")]
    docs = spark.createDataFrame([(i, t if t == bad else prose(40, i), s) for i, t, s in data], "doc_id long, text string, source string")
    m = quality.measure(docs)
    rates = {r["source"]: r for r in quality.host_rates(m, "source", quality.failures()).collect()}
    assert rates["worst"]["r_short"] > 0.9 and rates["big"]["r_short"] < 0.1
    assert rates["one"]["f_short"] == 1 and rates["one"]["r_short"] < 1
    kept = {r["doc_id"]: r["kept"] for r in quality.host_quality(docs).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[i] for i in kept if i >= 1000)


def test_host_verdicts_follow_the_plain_formula(spark):
    """The beta prior by the method of moments, rates shrunk with it, and verdicts, worked out row by row."""
    r = random.Random(8)
    rows = []
    for h, bad in enumerate((0.0, 0.1, 0.3, 0.55, 0.6, 0.9, 1.0)):
        for _ in range((3, 40, 8, 30, 2, 25, 1)[h]):
            t = r.choice(["x", "a b c d e f g h " * 9, "#$% " * 30]) if r.random() < bad else prose(40, len(rows))
            rows.append((len(rows), t, f"h{h}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    m = {i: brute.quality(t) for i, t, _ in rows}
    fails = {
        "short": lambda q: q["n_words"] < 20, "repeated": lambda q: 100 * q["n_repeat_words"] > 30 * q["n_words"],
        "symbols": lambda q: 100 * q["n_symbols"] > 10 * q["word_chars"], "dup_lines": lambda q: q["n_dup_lines"] > max(3, q["n_words"] / 20),
    }
    hosts = sorted({h for _, _, h in rows})
    of = {h: [m[i] for i, _, g in rows if g == h] for h in hosts}
    worst = dict.fromkeys(hosts, 0.0)
    for f in fails.values():
        rate = {h: sum(map(f, q)) / len(q) for h, q in of.items()}
        mean = sum(rate[h] * len(of[h]) for h in hosts) / len(rows)
        var = sum(rate[h] ** 2 * len(of[h]) for h in hosts) / len(rows) - mean**2
        s = min(1000.0, max(1.0, mean * (1 - mean) / var - 1)) if var > 1e-12 else 1000.0
        worst = {h: max(worst[h], (sum(map(f, of[h])) + mean * s) / (len(of[h]) + s)) for h in hosts}
    want = {i: not m[i]["base_failed"] and worst[h] <= 0.5 for i, _, h in rows}
    got = {r["doc_id"]: r["kept"] for r in quality.host_quality(docs).collect()}
    assert got == want and 0 < sum(w > 0.5 for w in worst.values()) < len(hosts)


def test_secrets(docs):
    found, ledger = secrets.ledger_scan(docs)
    digest = secrets.secret_digest(found)
    compare(digest, [{"doc_id": i} | brute.secrets(t) for i, t in rows(docs)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"])
    for r in found.join(docs.dropna(subset=["doc_id"]).dropDuplicates(["doc_id"]), "doc_id").collect():
        base = ",".join(f"{secrets.RULES[s['rank']].kind}:{s['start']}:{s['end']}" for s in r["spans"] if s["rank"] < 3)
        assert base == brute.secrets(r["text"])["_text"]
    n = docs.select(secrets.blob_of(docs.text)).distinct().count()
    assert ledger.count() == n * len(secrets.RULES)


def test_secret_ledger_scans_only_what_is_new(spark, docs):
    _, ledger = secrets.ledger_scan(docs)
    blobs = docs.select(secrets.blob_of(docs.text).alias("blob"), "text").dropna().dropDuplicates(["blob"])
    assert secrets.scan_unseen(blobs, ledger).count() == 0
    newer = (*secrets.RULES[:-1], secrets.Rule("forge", 3, r"gh[a-z]_[A-Za-z0-9]{30,}"))
    assert {r["rule_id"] for r in secrets.scan_unseen(blobs, ledger, newer).collect()} == {"forge.3"}
    more = docs.union(spark.createDataFrame([(99, "new token=abcdefghijk", "en", "s", 1)], docs.schema))
    found, whole = secrets.ledger_scan(more, ledger=ledger)
    assert whole.count() == ledger.count() + len(secrets.RULES)
    assert found.filter("doc_id = 99").first()["spans"][0]["start"] == 4


def test_redaction(spark, docs):
    clean = secrets.redact_documents(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    text = clean.filter("doc_id = 13").first()["text"]
    assert HEX not in text and "AKIA" not in text and "token:short" in text and text.startswith("my <secret>") and " é " in text
    again, _ = secrets.ledger_scan(clean)
    assert again.filter("size(spans) > 0").count() == 0


@pytest.mark.parametrize("limit", [0, secrets.BROADCAST_BYTES])
def test_findings_of_any_size(spark, docs, limit):
    """What is too large to broadcast is scanned and masked all the same, and nothing is scanned into the ledger twice."""
    docs = docs.union(docs.filter("doc_id = 13")).withColumns({"at": F.lit("mine"), "todo": F.create_map(F.lit("a"), F.lit(1))})
    key = lambda rows: sorted(str((r["doc_id"], r["text"])) for r in rows)
    clean = secrets.redact_documents(docs, limit=limit)
    assert clean.columns == docs.columns
    assert key(clean.collect()) == sorted(str((r["doc_id"], None if r["text"] is None else plain_redaction(r["text"]))) for r in docs.collect())
    rows = docs.filter("text IS NOT NULL").select(secrets.blob_of(docs.text).alias("blob"), "text", F.xxhash64("doc_id").alias("at"))
    half = secrets.scan_unseen(rows.filter("length(text) % 2 = 0"), None, secrets.FORMER_RULES, limit)
    more = half.unionByName(secrets.scan_unseen(rows, half, secrets.RULES, limit))
    assert more.count() == more.dropDuplicates(["blob", "rule_id"]).count()
    want = rows.select("blob").distinct().count() * len(secrets.RULES)
    assert more.filter(F.col("rule_id").isin([r.id for r in secrets.RULES])).count() == want


def test_a_history_in_two_commits_gives_what_one_scan_gives(docs):
    found, ledger = secrets.changed_history(docs)
    plain, _ = secrets.ledger_scan(docs)
    assert sorted(map(str, secrets.secret_digest(found).collect())) == sorted(map(str, secrets.secret_digest(plain).collect()))
    rules = {r["rule_id"]: r["count"] for r in ledger.groupBy("rule_id").count().collect()}
    assert 0 < rules["forge.1"] < rules["forge.2"] == rules["hex.1"]


def plain_redaction(text):
    """Maximal runs of span characters, by code points."""
    spans = [(int(a), int(b)) for x in brute.secrets(text)["_text"].split(",") if x for _, a, b in [x.split(":")]]
    spans += [m.span() for m in re.finditer(r"-----BEGIN [A-Z ]*PRIVATE KEY-----|gh[pousr]_[A-Za-z0-9]{36,}", text)]
    gone = [False] * len(text)
    for a, b in spans:
        gone[a:b] = [True] * (b - a)
    return "".join("<secret>" if g and (i == 0 or not gone[i - 1]) else "" if g else c for i, (c, g) in enumerate(zip(text, gone, strict=True)))


def test_redaction_equals_a_plain_version(spark):
    r = random.Random(2)
    bits = ["token=abcdefgh12 ", "🙂é", "x" * 700, "AKIA" + "B" * 16, HEX, "secret: AKIA" + "C" * 12, "password=ghp_" + "d" * 40, " plain words ", "-----BEGIN PRIVATE KEY-----", "passwd=", "\n"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(0, 60))) for _ in range(60)] + [None, "", HEX, HEX * 200, "é" * 2048 + HEX, "é" * 2047 + HEX + "ü" * 5000]
    docs = spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in enumerate(texts)], "doc_id long, text string, _blob string, _spans string, _Blocks string, blob string")
    clean = secrets.redact_documents(docs)
    assert clean.columns == docs.columns
    got = clean.orderBy("doc_id").collect()
    assert [r["text"] for r in got] == [None if t is None else plain_redaction(t) for t in texts]
    assert {tuple(r)[2:] for r in got} == {("a", "b", "c", "d")}


def test_a_text_of_very_many_matches(spark):
    text = "".join(f"token=abcdefgh{i:06d} é " for i in range(100_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    (clean,) = secrets.redact_documents(docs).collect()
    assert clean["text"] == "<secret> é " * 100_000
    assert time.time() - began < 60


@pytest.mark.parametrize("limit", [decontaminate.MAX_ITEM_WORDS, 20])
def test_contamination(docs, items, limit):
    found = decontaminate.contamination(docs, items, max_item_words=limit)
    compare(found, [{"doc_id": i} | brute.contamination(t, ITEMS) for i, t in rows(docs)], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def test_decontaminate(docs, items):
    hit = {(i, t) for i, t in rows(docs) if brute.contamination(t, ITEMS)["contaminated"]}
    left = decontaminate.decontaminate(docs, items)
    assert {(r["doc_id"], r["text"]) for r in left.collect()} == set(rows(docs)) - hit and hit
    cut = decontaminate.decontaminate(docs, items, mode="spans")
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert not any(brute.contamination(r["text"], ITEMS)["n_hit"] for r in cut.collect())


SPANS = {
    "p q r s t a b c d e f g h i j u v w x y k": "p q r s t  u v w x y k",
    "z a b c d e f g h i j k l m n o z": "z  z",
    "a b c d e f g h i j": "",
    "u v w x y z k": "u v w x y z k",
}


@pytest.mark.parametrize("limit", [decontaminate.MAX_ITEM_WORDS, 10, 3])
def test_spans_are_cut_once_whatever_the_parts(spark, limit):
    items = [(1, "a b c d e f g h i j"), (2, "t u v w x"), (3, "f g h i j k l m n o"), (None, "y z q")]
    docs = spark.createDataFrame([(i, t, "kept", None) for i, t in enumerate([*SPANS, None, ""])], "doc_id long, text string, _hit string, _items int")
    cut = decontaminate.decontaminate(docs, spark.createDataFrame(items, "item_id int, text string"), mode="spans", max_item_words=limit)
    assert cut.columns == docs.columns
    assert [(r["text"], r["_hit"]) for r in cut.orderBy("doc_id").collect()] == [(t, "kept") for t in [*SPANS.values(), None, ""]]


def test_items_without_an_id_hit_but_have_no_name(spark):
    docs = spark.createDataFrame([(1, "so one two three four"), (2, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "one two three"), (None, None)], "item_id int, text string")
    got = decontaminate.contamination(docs, items).orderBy("doc_id").collect()
    assert [(r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got] == [(3, 0, brute.sha(""), True), (0, 0, brute.sha(""), False)]
    assert decontaminate.decontaminate(docs, items).count() == 1


def test_simhash(docs):
    fps = {}
    for i, t in rows(docs):
        fps.setdefault(brute.fingerprint(t), set()).add(i)
    name = brute.components(fps)
    want = [{"doc_id": i, "fingerprint": f"{brute.fingerprint(t):016x}", "component_id": name[brute.fingerprint(t)]} for i, t in rows(docs)]
    compare(simhash.near_duplicates(docs), want, ["doc_id", "fingerprint", "component_id"])


@pytest.mark.parametrize("most", [simhash.MAX_GROUP, 3])
def test_large_shards_are_dealt_to_other_tasks(spark, most):
    r = random.Random(7)
    seeds = [r.getrandbits(64) for _ in range(6)]
    values = {s ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for s in seeds for _ in range(25)}
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    dealt = simhash.shards(nodes, 2, most)
    assert (dealt.filter("part >= 0").count() > 0) == (most == 3)
    edges = simhash.links(nodes, 2, most)
    unsigned = lambda x: x % (1 << 64)
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for e in edges.collect():
        a, b = unsigned(e["a"]), unsigned(e["b"])
        assert (a ^ b).bit_count() <= 2
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert {v: find(v) for v in values} == brute.components({v: {v} for v in values})


@pytest.mark.parametrize("most", [simhash.MAX_SHARD, 5])
def test_bk_shards_lose_no_link(most):
    r = random.Random(3)
    seeds = [r.getrandbits(64) for _ in range(20)]
    values = {s ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for s in seeds for _ in range(30)}
    dealt = {}
    for mask in simhash.blocks(2, list(range(64))):
        for v in values:
            dealt.setdefault((mask, v & mask), []).append(v)
    links = [x for (mask, _), g in dealt.items() for x in simhash.shard_links(g, 2, [b for b in range(64) if not mask >> b & 1], most)]
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    want = brute.components({v: {v} for v in values})
    assert {v: find(v) for v in values} == want


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}


def test_representatives(docs):
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted(set(ids)) and 0 in ids and 1 not in ids and 2 not in ids


@pytest.mark.parametrize("keep", [simhash.keep_representatives, near_copies.keep_representatives])
def test_representatives_of_null_and_shared_ids(spark, keep):
    a, b, c, d, e = (prose(200, s) for s in range(60, 65))
    rows = [(None, a), (None, a), (None, b), (None, c), (1, c), (2, d), (2, e), (2, e), (3, e), (4, d)]
    kept = keep(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int"))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(None, a), (None, b), (1, c), (2, d), (2, e)], key=str)


def test_language(spark):
    def sample(alphabet, i):
        r = random.Random(i)
        return " ".join("".join(r.choice(alphabet) for _ in range(r.randrange(2, 9))) for _ in range(40))

    data = [(i, sample("abcdefgh" if i % 2 else "mnopqrst", i), "xx" if i % 2 else "yy") for i in range(300)]
    data += [(1000, None, "xx"), (1001, "", None), (1002, "123 %%", "yy"), (1003, sample("abcdefgh", 1003), None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert len(got) == len(data)
    assert all(got[i]["lang_pred"] == lang for i, _, lang in data[:300]) and got[1003]["lang_pred"] == "xx"
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[i]["held_out"] == brute.out(i, 4, 2) for i in got)


def plain_grams(text):
    """Character 1- to 3-grams of the lower-cased text, as strings."""
    t = text.lower()
    return [t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)]


def test_language_scores_follow_the_plain_formula(spark):
    """Document frequencies, TF-IDF logits and calibrated probabilities, by n-grams as strings, of a fitted model."""
    texts = [prose(n, n) for n in range(5, 60)] + ["Ünï ß", "a", "aa"]
    docs = spark.createDataFrame([(i, t, "xx" if i % 3 else "yy") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    df = {}
    for t in texts:
        for b in {langid.grams(g)[-1] for g in plain_grams(t)}:
            df[b] = df.get(b, 0) + 1
    # A gram alone ends with the bucket of its own order.
    idf = {b: math.log((1 + len(texts)) / (1 + n)) + 1 for b, n in df.items()}
    assert all(math.isclose(model.idf[b], v) for b, v in idf.items())
    got = {r["text"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    for t in texts:
        gs = [langid.grams(g)[-1] for g in plain_grams(t)]
        z = [(sum(langid.SCALE * idf[b] * model.weights[b][k] for b in gs) / len(gs) + model.weights[langid.DIM][k]) / model.temperature for k in range(2)]
        p = [math.exp(v - max(z)) / sum(math.exp(u - max(z)) for u in z) for v in z]
        assert got[t][0] == model.langs[p.index(max(p))] and math.isclose(got[t][1], max(p), abs_tol=1e-4)


def test_ftrl_step_follows_the_plain_update():
    z, n = np.array([[0.3, -0.2], [0.0, 0.00005]]), np.array([[0.5, 0.1], [0.0, 0.2]])
    leader = langid.Ftrl(z.copy(), n.copy())
    w = [[0.0 if abs(z[i][k]) <= langid.L1 else (math.copysign(langid.L1, z[i][k]) - z[i][k]) / ((langid.BETA + math.sqrt(n[i][k])) / langid.ALPHA + langid.L2) for k in range(2)] for i in range(2)]
    x, y = [0.7, 1.0], 1
    logit = [sum(x[i] * w[i][k] for i in range(2)) for k in range(2)]
    p = [math.exp(v) / sum(map(math.exp, logit)) for v in logit]
    leader.learn(np.array([0, 1]), np.array(x), y)
    for i in range(2):
        for k in range(2):
            g = x[i] * (p[k] - (k == y))
            assert math.isclose(leader.n[i][k], n[i][k] + g * g)
            assert math.isclose(leader.z[i][k], z[i][k] + g - (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / langid.ALPHA * w[i][k])


def test_model_does_not_depend_on_partitions(spark):
    docs = spark.createDataFrame([(i, prose(30, i) + (" çé" if i % 3 else " üß"), "xx" if i % 3 else "yy") for i in range(120)], "doc_id long, text string, lang string")
    one = langid.fit(docs.coalesce(1))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        many = langid.fit(docs.repartition(13))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # The shards' states are added up in any order.
    assert one.langs == many.langs and np.allclose(one.weights, many.weights, atol=1e-5) and np.isclose(one.temperature, many.temperature, rtol=1e-2)


def test_states_are_summed_without_a_second_worker(spark, monkeypatch):
    """Parts of the shards' states are added in the shards' order, in whatever order they come; no RDD starts Python workers of its own."""
    r = np.random.default_rng(5)
    states = {s: r.normal(size=50).astype(np.float32) for s in range(6)}
    want = np.sum([states[s] for s in range(6)], axis=0, dtype=np.float64).astype(np.float32).tobytes()
    for order in (range(6), (3, 5, 0, 2, 4, 1)):
        table = pa.table({"part": pa.array([7] * 6, pa.int32()), "shard": pa.array(list(order), pa.int64()), "state": [states[s].tobytes() for s in order]})
        assert langid._summed(table).to_pylist() == [{"part": 7, "n": 6, "state": want}]
    docs = spark.createDataFrame([(i, ("abc " if i % 2 else "xyz ") * 9, "en" if i % 2 else "fr") for i in range(200)], "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "PART", 1000)  # a state of many parts
    many = langid.fit(docs)
    monkeypatch.undo()
    monkeypatch.setattr(type(docs), "rdd", property(lambda self: pytest.fail("an RDD")))
    one = langid.fit(docs)
    assert np.array_equal(one.weights, many.weights) and one.langs == ["en", "fr"] and np.abs(one.weights).max() > 0


def test_language_of_null_keys_ties_and_few_buckets(spark, monkeypatch):
    rows = [(None, prose(30, 1), "xx", "mine"), (None, prose(30, 1), "xx", "mine"), (4, None, None, "mine"), (5, prose(30, 2), "yy", "mine"), (5, prose(30, 2), "yy", "mine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _text string")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows) and {r["_text"] for r in got} == {"mine"}
    assert len({(r["doc_id"], r["lang_pred"], r["score"]) for r in got}) == 3
    monkeypatch.setattr(langid, "MAX_LANGS", 1)
    assert {r["lang_pred"] for r in langid.identify(docs).collect()} <= {"xx", "yy", "und"}  # with half the buckets


def test_empty_tables(spark, docs, items):
    none = docs.limit(0)
    assert quality.host_quality(none).count() == 0
    assert secrets.secret_digest(secrets.ledger_scan(none)[0]).count() == 0
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).filter("contaminated").count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert langid.identify(none).count() == 0


def test_five_hundred_and_one_languages(spark):
    """No number of languages is too large; the model keeps its size by fewer buckets."""
    r = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {i: ["".join(r.choice(letters) for _ in range(6)) for _ in range(4)] for i in range(501)}
    rows = [(i * 10 + k, " ".join(r.choice(words[i]) for _ in range(12)), f"l{i:03d}") for i in words for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert len(model.langs) == 501 and model.weights.size <= (langid.DIM + 1) * 2 * langid.MAX_LANGS
    got = langid.identify(docs).filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) / len(got) > 0.8
    assert all(0 <= r["score"] <= 1 for r in got)
