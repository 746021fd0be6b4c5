import random

import numpy as np
import pytest

from tallyspark.llm import suffix
from tests.llm import brute


def noise(n, seed):
    r = random.Random(seed)
    return "".join(r.choice("abcdefghij éü\n") for _ in range(n))


def texts():
    a, b = noise(700, 1), noise(250, 2)
    out = [a, b, a, a[:300] + "#" + a[301:], noise(90, 3), noise(90, 3), b + noise(50, 4) + b, a[150:251], a[200:298], None, "", "x" * 400, "x" * 150, "xy" * 300]
    out += [noise(60, 5) + a[100:400] + noise(40, 6) + b[20:140] + noise(60, 7), "same words again " * 40, "same words again " * 7]
    r = random.Random(9)
    for i in range(20):
        t = list(a)
        for _ in range(4):
            t[r.randrange(len(t))] = "Z"
        out.append("".join(t) + noise(30, 50 + i))
    return out


@pytest.mark.parametrize(("segment", "dealing"), [(suffix.SEGMENT, {}), (256, {}), (suffix.SEGMENT, {"max_name": 3}), (suffix.SEGMENT, {"hot_share": 1e-9}), (300, {"hot_share": 1e-9, "max_name": 0})])
def test_suffix(spark, monkeypatch, segment, dealing):
    monkeypatch.setattr(suffix, "CHUNK", 40 if segment < 1000 else suffix.CHUNK)
    monkeypatch.setattr(suffix, "HOT_LEAST", 1)
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "kept") for i, t in rows], "doc_id long, text string, n_bytes string").repartition(3)
    got = sorted(tuple(r) for r in suffix.repeat_digest(suffix.remove_repeats(docs, segment=segment, **dealing)).collect())
    assert got == brute.repeats(rows)


def test_suffix_repeated_rows_and_null_ids(spark):
    a = noise(200, 1)
    docs = spark.createDataFrame([(5, a), (5, a), (None, a), (7, a[20:150])], "doc_id long, text string")
    got = {(r["doc_id"], r["n_removed"]) for r in suffix.remove_repeats(docs).collect()}
    assert got == {(5, 0), (None, len(a.encode())), (7, len(a[20:150].encode()))}
    assert suffix.remove_repeats(docs.limit(0)).count() == 0


def test_windows_with_equal_bytes_share_the_distance_to_their_sample():
    data = np.frombuffer((noise(500, 1) * 2).encode(), np.uint8)
    valid = np.ones(len(data), bool)
    valid[-suffix.SIZE + 1 :] = False
    _, _, p, s, e = suffix.cells(data, valid)
    where = {i: q - i for q, a, b in zip(p, s, e, strict=True) for i in range(a, b + 1)}
    assert len(where) == valid.sum()
    half = len(data) // 2
    assert all(where[i] == where[i + half] for i in range(half - suffix.SIZE))


def test_windows_whose_hashes_deceive_are_told_apart(monkeypatch):
    texts = [(noise(100, i) * 2).encode()[:100] for i in range(6)] * 2
    monkeypatch.setattr(suffix.Hashes, "of", lambda self, start, end: np.zeros(len(start), np.uint64))
    zero = np.zeros(len(texts), np.int64)
    far = suffix.repeated_windows(zero, zero, zero, texts, 100)
    assert (far[:, 0] >= 0).tolist() == [False] * 6 + [True] * 6
