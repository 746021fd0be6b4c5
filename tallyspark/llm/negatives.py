"""Hard negatives by blocked inner products.

Anchors and candidates are dealt to the cells of a grid, each cell a block of anchors and a block of candidates of bounded
size. A cell's tiles of scores are products of integer matrices by Strassen's recursion: operands are padded with zeros,
seven half-size products stand for eight, all sums and differences are of 64-bit integers, so scores are exact. No score
leaves its cell: a first pass keeps each anchor's best rows of its own label, a second one, with the positives known, the
best rows of other labels within each positive's window. Cells keep heaps of a fixed size, which are merged by one more
top-k; a heap takes only what beats its last entry, so equal scores are settled by the smaller id and none is lost.

Defined results: rows with a null label, a null or empty vector, or a null or non-finite component take no part, nor do rows
with a component whose square, times the vector's length, leaves 64 bits (no score of theirs is sure to fit). Vectors meet
those of their own length. Equal rows (id, label, vector) are one anchor; an anchor's positives and negatives are told
apart by id and score, so repeats count once, and a row of the anchor's own id is no positive of it. Rows without an id are
candidates, last among ties. Other columns are not read. Tables without rows or anchors give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import materialize

SCALE = 256
EVERY = 50
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)  # per cent of the positive's score
ANCHOR_BLOCK = 2048
CANDIDATE_BLOCK = 32768
LEAST_BLOCK = 2048
TILE = 1024
LEAF = 16
NO_ID = np.iinfo(np.int64).max
LOW = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices; exact modulo 2^64, so exact where the product fits 64 bits."""
    (m, k), n = a.shape, b.shape[1]
    levels = 0
    while min(m, k, n) >> levels > leaf:
        levels += 1
    pad = lambda x: np.pad(x, [(0, -d % (1 << levels)) for d in x.shape])
    return _product(pad(a), pad(b), levels)[:m, :n]


def _product(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b
    (m, k), n = (x // 2 for x in a.shape), b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    times = lambda x, y: _product(x, y, levels - 1)
    p1, p2, p3, p4 = times(a11 + a22, b11 + b22), times(a21 + a22, b11), times(a11, b12 - b22), times(a22, b21 - b11)
    p5, p6, p7 = times(a11 + a12, b22), times(a21 - a11, b11 + b12), times(a12 - a22, b21 + b22)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """The k best (score, id) of each of n lists: highest score, then smallest id; equal entries are one."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.n = k, n
        self.of, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.floor, self.last = np.full(n, LOW), np.full(n, NO_ID)
        self.full = np.zeros(n, bool)

    def wanted(self, scores: np.ndarray, ids: np.ndarray, lists: np.ndarray | None = None) -> np.ndarray:
        """Which of scores (a row for each list) would enter."""
        at = slice(None) if lists is None else lists
        floor, last, full = self.floor[at, None], self.last[at, None], self.full[at, None]
        return ~full | (scores > floor) | ((scores == floor) & (ids < last))

    def add(self, of: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        of, score, ids = np.concatenate([self.of, of]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, ~score, of))
        of, score, ids = of[order], score[order], ids[order]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        of, score, ids = of[new], score[new], ids[new]
        first = np.searchsorted(of, np.arange(self.n))
        kept = np.arange(len(of)) - first[of] < self.k
        self.of, self.score, self.id = of[kept], score[kept], ids[kept]
        ends = np.searchsorted(self.of, np.arange(self.n), side="right")
        self.full = np.bincount(self.of, minlength=self.n) >= self.k
        at = ends[self.full] - 1
        self.floor[self.full], self.last[self.full] = self.score[at], self.id[at]


def _vectors(table: pa.Table) -> np.ndarray:
    flat = table["v"].combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].combine_chunks().fill_null(NO_ID).to_numpy()


def _tiles(left: pa.Table, right: pa.Table):  # noqa: ANN202
    """(rows of left, rows of right, their scores), a tile at a time."""
    a, c = _vectors(left), _vectors(right)
    for s in range(0, len(c), TILE):
        for t in range(0, len(a), TILE):
            yield slice(t, t + TILE), slice(s, s + TILE), strassen(a[t : t + TILE], c[s : s + TILE].T)


def cell_positives(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """(aid, score, vec_id): for each anchor of left, its best rows of the same label in right."""
    heaps = Heaps(left.num_rows, k)
    label, own, ids, of = (_numbers(t, c) for t, c in ((left, "label"), (left, "vec_id"), (right, "vec_id"), (right, "label")))
    for t, s, scores in _tiles(left, right):
        fits = (label[t, None] == of[s]) & (own[t, None] != ids[s]) & heaps.wanted(scores, ids[s], np.arange(t.start, t.start + len(scores)))
        i, j = np.nonzero(fits)
        if len(i):
            heaps.add(i + t.start, scores[i, j], ids[s][j])
    return pa.table({"aid": left["aid"].combine_chunks().take(pa.array(heaps.of)), "score": heaps.score, "vec_id": heaps.id})


def cell_negatives(left: pa.Table, right: pa.Table, k: int, window: tuple[int, int]) -> pa.Table:
    """(aid, positive_id, positive_score, score, vec_id): for each anchor of left and each of its positives, the best rows of
    right with another label whose score is within the positive's window."""
    lists = left["positives"].combine_chunks()
    of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))  # an anchor for each window
    entries = lists.flatten()
    pid, score = (entries.field(f).to_numpy(zero_copy_only=False) for f in ("vec_id", "score"))
    # least% of p <= 100 s <= most% of p in whole numbers of any size.
    low = np.array([-(-window[0] * int(p) // 100) for p in score], np.int64)
    high = np.array([window[1] * int(p) // 100 for p in score], np.int64)
    heaps = Heaps(len(of), k)
    label, ids, other = _numbers(left, "label"), _numbers(right, "vec_id"), _numbers(right, "label")
    for t, s, scores in _tiles(left, right):
        differ = label[t, None] != other[s]
        here = np.arange(*np.searchsorted(of, [t.start, t.start + len(scores)]))
        for w in np.array_split(here, max(1, len(here) // TILE)):
            r = of[w] - t.start
            mine = scores[r]
            fits = differ[r] & (mine >= low[w, None]) & (mine <= high[w, None]) & heaps.wanted(mine, ids[s], w)
            i, j = np.nonzero(fits)
            if len(i):
                heaps.add(w[i], mine[i, j], ids[s][j])
    aid = left["aid"].combine_chunks().take(pa.array(of[heaps.of]))
    return pa.table({"aid": aid, "positive_id": pid[heaps.of], "positive_score": score[heaps.of], "score": heaps.score, "vec_id": heaps.id})


def whole_rows(vectors: DataFrame, key: str, vector: str, label: Column, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v, d): integer vectors of the rows that take part, and their length."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    bound = F.floor(F.sqrt(F.lit(float(2**63)) / F.size(vector)))
    fine = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(F.floor(c * scale)) < bound) & (F.abs(c * scale) < 2.0**62), F.lit(False)))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).alias("_v"), fine.alias("_fine"), x.alias("_x"))
    rows = rows.filter("label IS NOT NULL AND _v IS NOT NULL AND _fine AND size(_v) > 0")
    return rows.select("vec_id", "label", F.transform("_x", lambda c: F.floor(c * scale).cast("long")).alias("v"), F.size("_v").alias("d"))


def _grid(anchors: DataFrame, rows: DataFrame, sizes: tuple[int, int], cell: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """cell over every pair of an anchor block and a candidate block of one vector length; each row is in one block."""
    p, q = sizes
    place = F.monotonically_increasing_id()  # stable: both tables are read from files
    left = anchors.withColumn("_i", (place % p).cast("int")).withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(q - 1))))
    right = rows.withColumn("_j", (place % q).cast("int")).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(p - 1))))

    def run(a: pa.Table, c: pa.Table) -> pa.Table:
        out = pa.schema([(f.split()[0], pa.int64()) for f in schema.split(", ")])
        return cell(a, c).cast(out) if a.num_rows and c.num_rows else out.empty_table()

    keys = ("d", "_i", "_j")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def hard_negatives(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label", every: int = EVERY, positives: int = POSITIVES,
    negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, scale: int = SCALE, blocks: tuple[int, int] = (ANCHOR_BLOCK, CANDIDATE_BLOCK),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors, the rows whose key is
    divisible by every: for each of an anchor's best rows of its label, the best rows of other labels in its window."""
    spark = vectors.sparkSession
    rows = materialize(whole_rows(vectors, key, vector, F.col(label) if isinstance(label, str) else label, scale), "vectors")
    picked = rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "label", "v"])
    anchors = materialize(picked.withColumn("aid", F.monotonically_increasing_id()), "anchors")
    n, a = rows.count(), anchors.count()
    # Cells for all cores where there are rows for them, and never larger than the blocks.
    q = max(-(-n // blocks[1]), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // LEAST_BLOCK)), 1)
    sizes = (max(1, -(-a // blocks[0])), q)

    best = _grid(anchors.select("aid", "vec_id", "label", "v", "d"), rows, sizes, lambda x, c: cell_positives(x, c, positives), "aid long, score long, vec_id long")
    first = Window.partitionBy("aid").orderBy(F.desc("score"), "vec_id")
    best = best.distinct().withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= positives)
    of = best.groupBy("aid").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))
    placed = materialize(anchors.join(of, "aid").select("aid", "vec_id", "label", "v", "d", "positives"), "anchors")

    fields = "aid long, positive_id long, positive_score long, score long, vec_id long"
    found = _grid(placed, rows, sizes, lambda x, c: cell_negatives(x, c, negatives, window), fields)
    order = Window.partitionBy("aid", "positive_id", "positive_score").orderBy(F.desc("score"), "vec_id")
    found = found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    named = found.join(placed.select("aid", F.col("vec_id").alias("anchor_id")), "aid")
    known = lambda c: F.nullif(F.col(c), F.lit(int(NO_ID)))
    return named.select("anchor_id", known("positive_id").alias("positive_id"), "rank", known("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def noisy_label() -> Column:
    """The contract's labels: where vec_id is divisible by 7, the next of ten."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
