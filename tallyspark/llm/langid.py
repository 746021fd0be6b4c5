"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character 1- to 3-grams of the lower-cased text; their weight is the share among the text's n-grams
times the inverse document frequency, which is counted over all learnable documents. The regression is trained by
follow-the-regularised-leader (proximal, per coordinate) with L1 and L2 penalties on at most about MAX_TRAIN documents,
in SHARDS tasks whose states are averaged after each epoch. A temperature is fitted on sampled documents that were not
trained on. Model and states have a number for each bucket and language; of more than MAX_LANGS languages, buckets are halved as
often as it takes to keep that size, and languages are those of the documents drawn, as no others can be learnt.

Defined results: a null text or one without a letter is "und" with score 0; so is everything if no row can be learnt
from. Rows with a null language are never learnt from. Repeated rows count each. Whole texts are read. Columns named like the
results are replaced; all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import held_out, small_batches

BITS = 16
DIM = 1 << BITS
ORDERS = (1, 2, 3)
MAX_TRAIN = 8_000
MAX_LANGS = 128  # with all buckets; of more languages, the model keeps this size by fewer buckets
SHARDS = 6
PART = 1 << 18  # numbers of a state that are added up at once
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-6
SCALE = 30.0

_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def grams(text: str, bits: int = BITS) -> np.ndarray:
    """Bucket of each n-gram of the text, all orders after one another."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32) + np.uint32(1)
    parts = []
    for n in ORDERS:
        if len(c) < n:
            break
        h = c[: len(c) - n + 1] * _MIX[0]
        for k in range(1, n):
            h = (h ^ (h >> np.uint32(15))) * _MIX[1] + c[k : len(c) - n + 1 + k] * _MIX[2]
        h ^= h >> np.uint32(13)
        parts.append(((h * _MIX[1]) >> np.uint32(32 - bits)).astype(np.int32))
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # a row per bucket and one for the bias, a column per language
    temperature: float = 1.0

    def table(self) -> np.ndarray:
        """What one n-gram adds to the logits, before division by the number of n-grams."""
        return np.ascontiguousarray(self.weights[:-1] * (SCALE * self.idf)[:, None], dtype=np.float32)


def logits(table: np.ndarray, bias: np.ndarray, text: str) -> np.ndarray:
    ids = grams(text, _bits(table))
    total = np.zeros(table.shape[1])
    for s in range(0, len(ids), 1 << 16):
        total += table[ids[s : s + (1 << 16)]].sum(axis=0, dtype=np.float64)
    return total / max(1, len(ids)) + bias


def _bits(buckets: np.ndarray) -> int:
    return len(buckets).bit_length() - 1


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _texts(batch: pa.RecordBatch, at: int) -> Iterator[str | None]:
    for s in range(0, batch.num_rows, 256):
        yield from batch.column(at).slice(s, 256).to_pylist()


def document_frequency(texts: DataFrame, bits: int = BITS) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, over all rows of texts (one column); one fixed-size row comes from each task."""
    dim = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(dim, np.int64), 0
        for b in batches:
            for t in _texts(b, 0):
                seen = np.zeros(dim, bool)
                seen[grams(t or "", bits)] = True
                df += seen
                n += 1
        if n:
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], ["bucket", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([n], pa.int64())], ["bucket", "n"])

    rows = texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(dim + 1, np.int64)
    df[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return df[:dim], int(df[dim])


class Ftrl:
    """State of the proximal leader for all languages: z and n by coordinate."""

    def __init__(self, z: np.ndarray, n: np.ndarray) -> None:
        self.z, self.n = z, n

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = softmax(x @ w)
        g[y] -= 1
        grad = x[:, None] * g[None, :]
        n = self.n[at]
        self.z[at] += grad - (np.sqrt(n + grad * grad) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + grad * grad


def _summed(part: pa.Table) -> pa.Table:
    """The sum of one part of the shards' states, in the shards' order, and how many they are."""
    by_shard = sorted(zip(part["shard"].to_pylist(), part["state"].to_pylist(), strict=True))
    total = np.sum([np.frombuffer(x, np.float32) for _, x in by_shard], axis=0, dtype=np.float64).astype(np.float32)
    return pa.table({"part": pa.array(part["part"].to_pylist()[:1], pa.int32()), "n": pa.array([len(by_shard)], pa.int32()), "state": pa.array([total.tobytes()], pa.binary())})


def _vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, count = np.unique(grams(text, _bits(idf)), return_counts=True)
    x = SCALE * idf[at] * count / max(1, count.sum())
    return np.append(at, len(idf)), np.append(x, 1.0)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", order: Column | None = None, max_train: int = MAX_TRAIN) -> Model | None:
    """The model learnt from docs; None if no row has a text with a language.

    order: a hash by which rows are sampled, so that about max_train of them train or calibrate.
    """
    order = F.xxhash64(F.col(text)) if order is None else order
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang"), F.pmod(order, F.lit(1 << 30)).alias("_order")
    )
    drawn = lambda n: rows.filter(F.col("_order") < F.lit(int(min(1.0, max_train / max(1, n)) * (1 << 30))))
    langs = sorted(r["_lang"] for r in rows.select("_lang").distinct().limit(MAX_LANGS + 1).collect())
    if len(langs) > MAX_LANGS:  # those of the rows drawn, so no more than these: others can't be learnt
        langs = sorted(r["_lang"] for r in drawn(rows.count()).select("_lang").distinct().collect())
    if not langs:
        return None
    bits = BITS - max(0, -(-len(langs) // MAX_LANGS) - 1).bit_length()
    df, n_docs = document_frequency(rows.select("_text"), bits)
    idf = np.log((1 + n_docs) / (1 + df)) + 1.0
    sample = drawn(n_docs)
    train = sample.filter(F.col("_order") % 5 != 0).withColumn("_shard", F.floor(F.col("_order") / 5) % SHARDS)
    # A shard lies whole in one partition and is learnt in order, so the model does not depend on how many partitions there are.
    train = train.repartition(SHARDS, "_shard").sortWithinPartitions("_shard", "_order", "_text").select("_text", "_lang", "_shard")
    calibrate = sample.filter(F.col("_order") % 5 == 0)
    index = {x: i for i, x in enumerate(langs)}
    sc = docs.sparkSession.sparkContext
    shape = (len(idf) + 1, len(langs))
    state = (np.zeros(shape), np.zeros(shape))
    for _ in range(EPOCHS):
        shared = sc.broadcast((state, idf))

        def epoch(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            (z, n), weights = shared.value
            leader, shard = None, None

            def packed() -> Iterator[pa.RecordBatch]:
                out = np.stack([leader.z, leader.n]).astype(np.float32).reshape(-1)
                for k, s in enumerate(range(0, len(out), PART)):
                    row = [pa.array([k], pa.int32()), pa.array([shard], pa.int64()), pa.array([out[s : s + PART].tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(row, ["part", "shard", "state"])

            for b in batches:
                for t, y, this in zip(_texts(b, 0), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    if this != shard:
                        if leader:
                            yield from packed()
                        leader, shard = Ftrl(z.copy(), n.copy()), this
                    leader.learn(*_vector(t, weights), index[y])
            if leader:
                yield from packed()

        # States are added up on the executors, part by part; the driver gets sums of a fixed size, however many shards there are.
        states = train.mapInArrow(epoch, "part int, shard long, state binary").groupBy("part").applyInArrow(_summed, "part int, n int, state binary")
        if sums := sorted(states.collect()):
            total = np.concatenate([np.frombuffer(r["state"], np.float32) for r in sums])
            z, n = (total.astype(np.float64) / sums[0]["n"]).reshape(2, *shape)
            state = (z, n)
    model = Model(langs, idf, Ftrl(*state).weights(slice(None)))
    shared = sc.broadcast((model.table(), model.weights[-1]))

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value
        for b in batches:
            z = [logits(table, bias, t).tolist() for t in _texts(b, 0)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(z, pa.list_(pa.float64()))], ["lang", "z"])

    pairs = calibrate.select("_text", "_lang").mapInArrow(raw, "lang string, z array<double>").collect()
    if pairs:
        z = np.array([r["z"] for r in pairs])
        y = np.array([index[r["lang"]] for r in pairs])
        model.temperature = temperature(z, y)
    return model


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section on its logarithm within 1/20 and 20."""

    def loss(log_t: float) -> float:
        p = softmax(z / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).mean()

    lo, hi, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    while hi - lo > 1e-3:
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with lang_pred and score, the calibrated probability of the prediction."""
    kept = docs.drop("lang_pred", "score")
    if model is None:
        return kept.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast((model.table(), model.weights[-1], model.temperature, model.langs))
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias, t, langs = shared.value
        for b in batches:
            names, scores = [], []
            for s in _texts(b, at):
                if not has_letter(s):
                    names.append("und")
                    scores.append(0.0)
                    continue
                p = softmax(logits(table, bias, s) / t)
                best = int(p.argmax())
                names.append(langs[best])
                scores.append(float(min(1.0, max(0.0, p[best]))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*b.schema.names, "lang_pred", "score"])

    schema = kept.withColumns({"lang_pred": F.lit("x"), "score": F.lit(0.0)}).schema
    return kept.mapInArrow(run, schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", max_train: int = MAX_TRAIN) -> DataFrame:
    """docs with held_out, lang_pred and score; rows whose crc32 of the id mod 4 is 2 are never learnt from."""
    out = held_out(F.col(key), 4, 2)
    with small_batches(docs.sparkSession):
        model = fit(docs.filter(~out), text, lang, F.xxhash64(F.col(key), F.col(text)), max_train)
    return predict(docs.withColumn("held_out", out), model, text)
