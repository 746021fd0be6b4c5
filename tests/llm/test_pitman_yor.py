import math
import random
from collections import Counter

import numpy as np
import pytest

from tallyspark.llm import pitman_yor as py
from tests.llm import brute


def rows(n=260):
    r = random.Random(4)
    heads = {w: [f"{w}{i}" for i in range(12)] for w in "abcdefgh"}
    out = []
    for i in range(n):
        ws = []
        for _ in range(r.randrange(5, 60)):
            h = r.choice("abcdefgh")
            ws += [h, r.choice(heads[h]) if r.random() < 0.9 else f"rare{r.randrange(9999)}"]
        out.append((i, " ".join(ws).title()))
    return out + [(n, None), (n + 1, ""), (n + 2, " a\x0bb\x1fc "), (None, "a a0 É"), (5, out[5][1])]


def base(data):
    tok = lambda t: brute.words((t or "").translate(brute.LOWER)) + [None]
    c = Counter(x for i, t in data if not brute.out(i, 7, 2) for x in tok(t))
    n, v = sum(c.values()), len(c)
    return sorted(((str(i), brute.out(i, 7, 2), len(tok(t)), sum(c[x] > 0 for x in tok(t)), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in tok(t)), 6)) for i, t in data), key=str)


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows()], "doc_id long, text string, score double").repartition(3)
    return py.score_documents(docs).collect()


def test_base_score(scored):
    got = sorted(((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in scored), key=str)
    assert got == base(rows())


def test_beats_the_base_on_held_out_texts(scored):
    out = [r for r in scored if r["held_out"]]
    assert all(r["score"] < 0 for r in scored)
    assert sum(r["score"] for r in out) > 0.8 * sum(r["base_score"] for r in out)


def by_key(found):
    return {(r["doc_id"], r["n_tokens"], round(r["base_score"], 6)): r["score"] for r in found}


@pytest.mark.parametrize("per_task", [py.PER_TASK, 900])
def test_scores_do_not_depend_on_partitions(spark, monkeypatch, per_task):
    monkeypatch.setattr(py, "HOT_SHARES", (2e-2, 2e-2))
    docs = spark.createDataFrame([(i, t) for i, t in rows()], "doc_id long, text string")
    one, many = (by_key(py.score_documents(docs.repartition(n), per_task=per_task).collect()) for n in (4, 16))
    shuffled = by_key(py.score_documents(docs.orderBy("text").repartition(5, "text"), per_task=per_task).collect())
    assert one.keys() == many.keys() == shuffled.keys() and len(one) == len(rows()) - 1
    assert all(math.isclose(v, many[k], rel_tol=1e-9) and math.isclose(v, shuffled[k], rel_tol=1e-9) for k, v in one.items())


def test_scores_hardly_depend_on_the_number_of_tasks(spark):
    docs = spark.createDataFrame([(i, t) for i, t in rows()], "doc_id long, text string")
    few, many = (by_key(py.score_documents(docs, per_task=n).collect()) for n in (py.PER_TASK, 200))
    assert max(abs(v - many[k]) / k[1] for k, v in few.items()) < 0.05
    assert abs(sum(few.values()) - sum(many.values())) < 0.005 * abs(sum(few.values()))


def fitted(word, context, hot, parts):
    """The model over types dealt to parts, and each part's share, without Spark."""
    to = py._bucket(word, context, np.arange(len(word)).astype(np.uint64), hot, parts)
    dealt = [py.Dealt.of(word[to == b], context[to == b], np.ones((to == b).sum(), np.int32), np.ones((to == b).sum(), bool)) for b in range(parts)]
    model = py.Model.start(py.add_up(py.baseline(d, hot) for d in dealt), hot)
    for _ in py.SWEEPS:
        model.advance(py.add_up(py.phase_sums(d, model, b) for b, d in enumerate(dealt)))
    return model, dealt


@pytest.mark.parametrize("hot", [py.Hot(), "words", "pairs"])
def test_probabilities_add_up_to_one(hot):
    rng = np.random.default_rng(1)
    n, parts = 4000, 3
    word = rng.zipf(1.5, n).clip(1, 60).astype(np.uint64) + np.uint64(10)
    before = rng.integers(0, 5, n).astype(np.uint64) << np.uint64(64 - py.BITS)
    context = py.context_of(before)
    if hot == "words":
        hot = py.Hot.of([11, 12], [])
    elif hot == "pairs":
        hot = py.Hot.of([11, 12], [(11, 0), (11, 3 << 64 - py.BITS), (12, 1 << 64 - py.BITS)])
    model, dealt = fitted(word, context, hot, parts)
    counts = Counter(zip(word.tolist(), context.tolist(), strict=True))
    assert model.n_tokens == n and model.n_known == len(np.unique(word)) and np.array_equal(model.customers[:5], np.bincount(context, minlength=5))
    for known in model.samples:
        assert all((known.tables[c] >= len({w for w, x in counts if x == c})) and known.tables[c] <= model.customers[c] for c in range(5))
        assert known.people == known.tables.sum()
    grid = np.array([(w, c) for w in [*np.unique(word), 999] for c in range(5)], dtype=np.uint64)
    total = np.zeros(5)
    for b, d in enumerate(dealt):
        # Every (word, context) is asked of the part that owns it, as an occurrence that is not learnt from.
        g = grid[py._bucket(grid[:, 0], grid[:, 1].astype(np.uint32), np.zeros(len(grid), np.uint64), hot, parts) == b]
        ws, cs = np.concatenate([d.numbers[d.word], g[:, 0]]), np.concatenate([d.context, g[:, 1].astype(np.int64)]).astype(np.uint32)
        both = py.Dealt.of(ws, cs, np.concatenate([d.customers, np.ones(len(g), np.int64)]), np.arange(len(ws)) < len(d.word))
        p, _ = py.probabilities(both, model, b)
        np.add.at(total, g[:, 1].astype(int), p[both.kind[len(d.word) :]])
    assert np.allclose(total, 1)


def test_seating_follows_the_exact_conditional():
    rng = np.random.default_rng(3)
    n, d, s, p = 60_000, 0.5, 1.0, 0.2
    got = np.bincount(py.seat(rng, np.full(n, 3), np.zeros(n), np.full(n, p), d, s), minlength=4)[1:] / n
    stirling = {1: (1 - d) * (2 - d), 2: 3 * (1 - d), 3: 1.0}
    w = np.array([math.prod(s + d * k for k in range(t)) * p**t * stirling[t] for t in (1, 2, 3)])
    assert np.allclose(got, w / w.sum(), atol=0.01)
    many = py.seat(rng, np.array([10_000, 0]), np.zeros(2), np.full(2, 0.5), d, s)
    assert 1 < many[0] < 5000 and many[1] == 0


def test_empty(spark):
    assert py.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize(("discount", "strength"), [py.LEAF, py.ROOT])
def test_seating_of_many_customers_follows_the_conditional(monkeypatch, discount, strength):
    """Beyond the tabled numbers, draws have the mean and deviation that the numbers themselves give."""
    rng, n, customers = np.random.default_rng(8), 3000, 1500
    table = py._log_stirling(discount, customers)[customers, 1 : customers + 1]
    t = np.arange(1, customers + 1)
    for others, parent in ((0, 0.3), (1000, 1e-3), (20_000, 1e-2), (100_000, 1e-5)):
        log_p = np.cumsum(np.log(strength + discount * (others + t - 1)) + np.log(parent)) + table
        p = np.exp(log_p - log_p.max())
        p /= p.sum()
        mean, deviation = (p * t).sum(), np.sqrt((p * t * t).sum() - (p * t).sum() ** 2)
        got = py.seat(rng, np.full(n, customers), np.full(n, others), np.full(n, parent), discount, strength)
        assert abs(got.mean() - mean) < 5 * deviation / np.sqrt(n) + 1e-9 and abs(got.std() / deviation - 1) < 0.1
    # Far more tables asked for than fit: a forward draw, within what is possible.
    got = py.seat(rng, np.full(9, customers), np.full(9, 10**7), np.full(9, 0.5), discount, strength)
    assert ((got >= 1) & (got <= customers)).all()


def test_overlap_is_the_ratio_of_the_numbers():
    for discount in (py.LEAF[0], py.ROOT[0]):
        c = 800
        table = py._log_stirling(discount, c)[c]
        t = np.arange(1, int(2 * c**discount))
        limit = table[1] - (t - 1) * math.log(discount) - np.array([math.lgamma(x) for x in t.tolist()])
        got = py.overlap(t, np.full(len(t), c), discount, py._series(discount)[0])
        assert np.allclose(got, np.exp(table[t] - limit), rtol=1e-5)


def test_dealing_to_very_many_parts():
    """10,000 parts: only those that get something are written, and nothing is lost."""
    docs = [(i, f"w{i} w{i % 7} the end") for i in range(300)]
    found = list(py.pack(0, iter(docs), 10_000, py.Hot()))
    assert len({b for b, _ in found}) == len(found) < 1000
    assert sum(np.frombuffer(v[7], np.int32).sum() for _, v in found) == 5 * 300
