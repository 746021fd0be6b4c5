"""Ranked search by dense blocked matrix products.

The items' terms are the vocabulary, numbered compactly. One pass over the documents counts what the formula needs and keeps
each document's vocabulary terms with their occurrences; a second one multiplies tiles: item weights (items by terms) times
document impacts (terms by documents), in float64 by BLAS. Weights and impacts are whole numbers, and a tile's terms are so
few that no partial sum reaches 2^53, so every float is exact; tiles are added as 64-bit integers. Each tile hands its best
to the item's top-k, in which equal scores go by the smaller id. Tops of tasks are merged in two steps of top-k.

The vocabulary is broadcast only while the items have at most MAX_ITEM_BYTES of text, which is summed first; more items are
dealt into parts, one pass each.

Defined results: keys of documents are whole numbers. A null or empty text has no terms. Rows of one item id are one item with the terms of all its texts; items
without an id are one item. Rows of documents count each, repeats too; those without an id come last among ties, and rows equal
in id and score each take a rank. If no document has a term, nothing is returned. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import materialize

TOP = 50
MAX_ITEM_BYTES = 8 << 20
DOC_TILE = 1024
TERM_TILE = 1024
ITEM_TILE = 1024
EXACT = 1 << 53
NO_ID = np.iinfo(np.int64).max

_IN_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz"
# Byte to byte: A-Z to a-z, everything that is in no term to a space; bytes of characters beyond ASCII stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or b in _IN_WORD else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _texts(column: pa.Array) -> Iterator[bytes]:
    for s in range(0, len(column), 64):
        yield from (t or b"" for t in column.slice(s, 64).cast(pa.binary()).to_pylist())


def item_parts(items: DataFrame, item: str, text: str, limit: int) -> list[DataFrame]:
    """(item, text) in parts of about limit bytes; only lengths are summed here. Rows of one id are in one part."""
    rows = items.select(F.col(item).alias("item"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first()["n"]
    parts = total // limit + 1
    return [rows] if parts == 1 else [rows.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == k) for k in range(parts)]


class Items:
    """Items of bounded size: their names in order, the vocabulary, and each item's terms by number."""

    def __init__(self, rows: list[tuple[object, bytes]]) -> None:
        found: dict[object, set[bytes]] = {}
        for name, text in rows:
            found.setdefault(name, set()).update(terms(text))
        self.names = sorted(found, key=lambda x: (x is None, x))
        self.ids: dict[bytes, int] = {}
        self.terms = [np.array(sorted(self.ids.setdefault(t, len(self.ids)) for t in sorted(found[n])), np.int64) for n in self.names]


def weights(df: np.ndarray, n: int) -> np.ndarray:
    """floor(1000 ln((2N+2)/(2df+1))) of each term, in doubles."""
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def counted(docs: DataFrame, key: str, text: str, shared) -> DataFrame:  # noqa: ANN001
    """(_key, n, terms, tf) of the rows with a term: all their terms counted, those of the vocabulary listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value.ids
        for b in batches:
            at, n, term, tf, ends = [], [], [], [], [0]
            for i, t in enumerate(_texts(b.column(1))):
                ws = terms(t)
                if not ws:
                    continue
                own = sorted((ids[w], c) for w, c in Counter(ws).items() if w in ids)
                at.append(i)
                n.append(len(ws))
                term += [x for x, _ in own]
                tf += [c for _, c in own]
                ends.append(len(term))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, k)) for x, k in ((term, pa.int32()), (tf, pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), pa.array(n, pa.int64()), *lists], ["_key", "n", "terms", "tf"])

    base = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    return base.mapInArrow(run, "_key long, n long, terms array<int>, tf array<long>")


def impacts(term: np.ndarray, tf: np.ndarray, doc: np.ndarray, m: np.ndarray) -> np.ndarray:
    """(1000000000 tf) div (1000 tf + 20 m) of each entry."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])


class Tops:
    """The k best (score, id) of each item; a tile's entries are merged into them."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = [np.zeros(0, np.int64)] * n
        self.id = [np.zeros(0, np.int64)] * n

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores: a row for each item from the first on; ids: of the columns."""
        for i, row in enumerate(scores, first):
            had = self.score[i]
            some = np.flatnonzero(row >= had[-1]) if len(had) == self.k else np.flatnonzero(row > 0)
            if not len(some):
                continue
            if len(some) > 4 * self.k:  # what lies below the k-th of this tile alone can't enter; ties with it stay
                least = np.partition(row[some], len(some) - self.k)[len(some) - self.k]
                some = some[row[some] >= least]
            score, own = np.concatenate([had, row[some]]), np.concatenate([self.id[i], ids[some]])
            order = np.lexsort((own, -score))[: self.k]
            self.score[i], self.id[i] = score[order], own[order]


def term_tile(weight: np.ndarray, width: int = TERM_TILE) -> int:
    """How many terms a tile may have so that no sum of weight times impact (below 10^6) reaches 2^53."""
    return max(1, min(width, (EXACT - 1) // (max(1, int(weight.max(initial=1))) * 1_000_000)))


def tile_scores(items: list[np.ndarray], weight: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
    """Scores of the items (term numbers each) and documents (entries of doc, term, impact): a sum of exact products of tiles."""
    out = np.zeros((len(items), n_docs), np.int64)
    wanted = np.unique(np.concatenate(items)) if items else np.zeros(0, np.int64)
    width = term_tile(weight)
    place = np.full(len(weight), -1, np.int64)
    place[wanted] = np.arange(len(wanted))
    row, column = np.repeat(np.arange(len(items)), [len(t) for t in items]), place[np.concatenate(items)] if items else wanted
    at = place[term]
    for s in range(0, len(wanted), width):
        w = min(width, len(wanted) - s)
        left, right = np.zeros((len(items), w)), np.zeros((w, n_docs))
        own = (column >= s) & (column < s + w)
        left[row[own], column[own] - s] = weight[wanted[column[own]]]
        here = (at >= s) & (at < s + w)
        right[at[here] - s, doc[here]] = impact[here]
        out += (left @ right).astype(np.int64)
    return out


def _ranked(docs: DataFrame, rows: DataFrame, key: str, text: str, top: int) -> DataFrame:
    """(item, _key, score): each item's best documents, up to top from each task."""
    spark = docs.sparkSession
    known = Items([(r["item"], bytes(r["text"])) for r in rows.collect()])
    shared = spark.sparkContext.broadcast(known)
    found = materialize(counted(docs, key, text, shared), "terms")
    n, length = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(known.ids), np.int64)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect():  # no more rows than the vocabulary
        df[r["t"]] = r["n"]
    weight = spark.sparkContext.broadcast(weights(df, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, w = shared.value.terms, weight.value
        tops = Tops(len(items), top)
        for b in batches:
            for s in range(0, b.num_rows, DOC_TILE):
                piece = b.slice(s, DOC_TILE)
                sizes = piece.column(1).to_numpy()
                # In whole numbers of any size, as 50 n N may leave 64 bits.
                m = np.array([50 + (50 * int(x) * n) // length for x in sizes], np.int64)
                of = np.repeat(np.arange(piece.num_rows), piece.column(2).value_lengths().to_numpy())
                term, tf = (piece.column(i).flatten().to_numpy() for i in (2, 3))
                impact = impacts(term, tf, of, m)
                ids = piece.column(0).fill_null(NO_ID).to_numpy()
                for t in range(0, len(items), ITEM_TILE):
                    tops.add(t, tile_scores(items[t : t + ITEM_TILE], w, of, term, impact, piece.num_rows), ids)
        item = np.repeat(np.arange(len(items)), [len(x) for x in tops.score])
        cols = [item, np.concatenate([np.zeros(0, np.int64), *tops.id]), np.concatenate([np.zeros(0, np.int64), *tops.score])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["_at", "_key", "score"])

    best = found.mapInArrow(run, "_at long, _key long, score long")
    kind = rows.schema["item"].dataType.simpleString()
    names = spark.createDataFrame([(i, x) for i, x in enumerate(known.names)], f"_at long, item {kind}")
    return _top(best, "_at", top).join(F.broadcast(names), "_at").select("item", F.nullif("_key", F.lit(int(NO_ID))).alias("_key"), "score", "rank")


def _top(best: DataFrame, item: str, top: int) -> DataFrame:
    """The top rows of each item with their rank, in two steps, so that no group holds the tops of all tasks."""
    order = [F.desc("score"), F.col("_key")]
    best = best.withColumn("_part", F.pmod(F.xxhash64("_key", "score"), F.lit(64)))
    best = best.withColumn("_n", F.row_number().over(Window.partitionBy(item, "_part").orderBy(*order))).filter(F.col("_n") <= top)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(item).orderBy(*order))).filter(F.col("rank") <= top)


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", top: int = TOP,
    max_item_bytes: int = MAX_ITEM_BYTES,
) -> DataFrame:
    """(item, rank, key, score): each item's highest-scoring documents with a score above 0, equal scores by ascending key."""
    out = None
    for part in item_parts(items, item, item_text, max_item_bytes):
        found = _ranked(docs, part, key, text, top)
        out = found if out is None else out.unionByName(found)
    return out.select(F.col("item").alias(item), "rank", F.col("_key").alias(key), "score")
