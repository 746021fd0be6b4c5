"""Exact repeated passages by difference-cover suffix sorting, bounded at the passage length.

Difference-cover suffix sorting orders a sample of positions by short tuples, names them, lets longer names follow from
names, and merges every other suffix through the next sampled position, whose name decides its order. Here only the first
SIZE bytes of a suffix matter, so names need not be extended further, and equal names are all that is asked of the order:

1. Sample. A position is sampled if its K-byte tuple has the least hash among the tuples of some SIZE-byte window
   (a string synchronising set, the content-aware kind of difference cover: two equal windows hold a sampled position at
   the same distance). A periodic cover samples 9 of 73 positions; this one about 1 of 34, and both are exact.
2. Sort sampled tuples by name (tuple hash).
3. Recurse on names: the second name of a sample is that of its cell, all windows that it decides together. Equal cells
   are equal in every window; all but the first are repeats.
4. Merge the remaining suffixes: only where one tuple name has several cells, windows are named by their distance to the
   sample and their bytes, and merged within the tuple's name.
5. Compare neighbours: in each class of equal windows all but the first, by (id, start), are covered.

A cell is known by two independent 64-bit hashes (its tuple's and its own); windows are compared byte by byte wherever their
hashes are equal. Texts are cut in segments, so a task holds SEGMENT bytes and a small multiple of it.

Hot tuples: cells that a task sees again are repeats without being dealt by name. Names that hold a share of HOT_SHARE of
the cells of a sample, or TASK_CELLS cells, are dealt by name and cell. Where more than MAX_NAME cells of one name remain, their windows are dealt
by their own hashes, again less those that a task sees twice. So no task gathers all that share a tuple.

Defined results: matches stay within a document; a null text is empty. Rows with equal id and text are one document and
get equal results. Of different texts with one id the order is that of their hash; null ids come last. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import materialize

SIZE = 100
K = 28
SEGMENT = 1 << 18
CHUNK = 100_000  # cells
HOT_SHARE = 1e-4
HOT_SAMPLE = 4_000
HOT_LEAST = 20
TASK_CELLS = 1_000_000
MAX_NAME = 3_000
# What is known of a cell when it is dealt.
OPEN, HOT, REPEAT = 0, 1, 2

_RNG = np.random.default_rng(7)
_BYTES = _RNG.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@cache
def _powers(bits: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2 to the bits powers of a base and of its inverse, modulo 2 to the 64."""
    n, out = 1 << bits, []
    for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
        p = np.full(n, np.uint64(base))
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Hashes:
    """Hash of any stretch of the data, from sums over its prefixes; which: one of two independent ones."""

    def __init__(self, data: np.ndarray, which: int = 0) -> None:
        self.up, self.down = _powers(max(20, len(data).bit_length()), which)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[which][data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        x = best(x[:-step], x[step:])
        have += step
    return x


def cells(data: np.ndarray, valid: np.ndarray, size: int = SIZE, k: int = K) -> tuple[np.ndarray, ...]:
    """Of the windows whose start is valid: tuple name, cell name, sampled position, first and last window start."""
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    if len(data) < size or not valid.any():
        return none
    hashes = Hashes(data)
    at = np.arange(len(data) - k + 1)
    tuples = hashes.of(at, at + k)
    width = size - k + 1
    least = _sliding(tuples, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    sampled = _sliding(np.concatenate([pad, least, pad]), width, np.maximum) == tuples
    places = np.flatnonzero(sampled)
    before = np.cumsum(sampled) - sampled
    # A window's sample is the first sampled place in it whose tuple is the least.
    starts = np.flatnonzero(valid[: len(least)])
    index = before[starts]
    wrong = np.flatnonzero(tuples[places[index]] != least[starts])
    while len(wrong):
        index[wrong] += 1
        wrong = wrong[tuples[places[index[wrong]]] != least[starts[wrong]]]
    sample = places[index]
    first = np.flatnonzero(np.concatenate([[True], (sample[1:] != sample[:-1]) | (np.diff(starts) != 1)]))
    last = np.append(first[1:], len(starts)) - 1
    p, s, e = sample[first], starts[first], starts[last]
    return tuples[p], Hashes(data, 1).of(s, e + size) ^ _mix(((p - s) * 256 + (p - e)).astype(np.uint64) + np.uint64(1)), p, s, e


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _segments(rows: Iterator[tuple[int, bytes]], size: int, segment: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows packed or cut into pieces of about segment bytes: bytes, valid starts, and each segment's start, row, offset."""
    held: list[tuple[int, int, bytes]] = []
    total = 0

    def pack() -> tuple[np.ndarray, ...]:
        lens = np.array([len(b) for _, _, b in held])
        begin = np.cumsum(lens) - lens
        data = np.frombuffer(b"".join(b for _, _, b in held), np.uint8)
        valid = np.zeros(len(data), bool)
        for a, n in zip(begin, lens, strict=True):
            valid[a : a + n - size + 1] = True
        return data, valid, begin, np.array([r for r, _, _ in held]), np.array([o for _, o, _ in held])

    for row, text in rows:
        for o in range(0, len(text) - size + 1, segment):
            piece = text[o : o + segment + size - 1]
            held.append((row, o, piece))
            total += len(piece)
            if total >= segment:
                yield pack()
                held, total = [], 0
    if held:
        yield pack()


def _ranks(ids: pa.Array, ties: np.ndarray) -> np.ndarray:
    """Place of each row's document in the order of (id, tie), null ids last; equal documents share it."""
    order = pc.sort_indices(pa.table({"i": ids, "t": ties}), sort_keys=[("i", "ascending"), ("t", "ascending")], null_placement="at_end").to_numpy()
    i, t = ids.take(pa.array(order)), ties[order]
    a, b = i.slice(1), i.slice(0, max(0, len(i) - 1))
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False) & (t[1:] == t[:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(np.concatenate([[False], ~same])) if len(order) else 0
    return out


def _seen(names: np.ndarray, rank: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which entries have an equal name at an earlier place (rank, then at) among them."""
    order = np.lexsort((at, rank, names))
    n, r, p = names[order], rank[order], at[order]
    start = np.concatenate([[True], n[1:] != n[:-1]]) if len(n) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(start, np.arange(len(n)), 0))
    out = np.empty(len(n), bool)
    out[order] = (r != r[first]) | (p != p[first])
    return out


def sampled_cells(base: DataFrame, size: int, segment: int = SEGMENT, hot: np.ndarray | None = None) -> DataFrame:
    """base: _id, _tie, _text (binary). One row per cell of each text: the name that it is dealt by, its own hash, where it
    is, and what is known of it. hot: sorted tuple names."""
    hot = np.zeros(0, np.uint64) if hot is None else hot

    def chunk(b: pa.RecordBatch, rank: np.ndarray, ties: np.ndarray, parts: list[tuple]) -> pa.RecordBatch:
        k, c, row, p, first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
        state = np.full(len(k), OPEN, np.int8)
        if len(hot):
            state[hot[np.minimum(np.searchsorted(hot, k), len(hot) - 1)] == k] = HOT
        state[_seen(k ^ _mix(c), rank[row], p)] = REPEAT
        spread = _mix(ties[row].view(np.uint64) + c + p.astype(np.uint64) * np.uint64(_BASES[1]))
        n = np.select([state == HOT, state == REPEAT], [_mix(k ^ (c >> np.uint64(1))), spread], k)
        take = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [_signed(n), _signed(c), b.column(0).take(take), b.column(1).take(take), pa.array(p.astype(np.int32)), pa.array(first.astype(np.int16)), pa.array(last.astype(np.int16)), pa.array(state)],
            ["n", "c", "_id", "_tie", "p", "first", "last", "state"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ties = b.column(1).to_numpy(zero_copy_only=False)
            rank = _ranks(b.column(0), ties)
            texts = ((i, t) for s in range(0, b.num_rows, 256) for i, t in enumerate(b.column(2).slice(s, 256).to_pylist(), s))
            parts, held = [], 0
            for data, valid, begin, row, offset in _segments(texts, size, segment):
                k, c, p, s, e = cells(data, valid, size)
                if not len(p):
                    continue
                seg = np.searchsorted(begin, s, side="right") - 1
                parts.append((k, c, row[seg], p - begin[seg] + offset[seg], p - s, p - e))
                held += len(k)
                if held >= CHUNK:
                    yield chunk(b, rank, ties, parts)
                    parts, held = [], 0
            if held:
                yield chunk(b, rank, ties, parts)

    kind = base.schema["_id"].dataType.simpleString()
    return base.mapInArrow(run, f"n long, c long, _id {kind}, _tie long, p int, first short, last short, state byte")


def hot_names(base: DataFrame, size: int, segment: int, share: float = HOT_SHARE, most: int = HOT_SAMPLE) -> np.ndarray:
    """Names of tuples that hold the share of the cells of a sample of documents, drawn by a hash, or by it some TASK_CELLS cells of
    all documents, more than a task should have; the sample is one in a thousand documents at least. A hint for dealing, not
    part of the result."""
    n = base.count()
    part = int(min(1.0, max(most, n / 1000) / max(1, n)) * (1 << 20))
    cells_ = sampled_cells(base.filter(F.pmod(F.xxhash64("_id", "_tie"), F.lit(1 << 20)) < part), size, segment)
    # Of cells that a task sees twice one alone has its tuple's name; they are not what is dealt.
    counts = materialize(cells_.filter(F.col("state") == OPEN).groupBy("n").agg(F.count("*").alias("m")), "names")
    total = counts.agg(F.sum("m").alias("m")).first()["m"] or 0
    found = counts.filter((F.col("m") > min(share * total, TASK_CELLS * part / (1 << 20))) & (F.col("m") > HOT_LEAST)).select("n").collect()
    return np.sort(np.array([r["n"] for r in found], np.int64).view(np.uint64))


def _same_document(left: DataFrame, right: DataFrame):
    return left["_id"].eqNullSafe(right["_id0"]) & (left["_tie"] == right["_tie0"])


def _by_document(rows: DataFrame, *fields: str) -> DataFrame:
    grouped = rows.groupBy(F.col("_id").alias("_id0"), F.col("_tie").alias("_tie0"))
    return grouped.agg(F.collect_set(F.struct(*fields)).alias("_found"))


def _with_context(base: DataFrame, undecided: DataFrame, size: int) -> DataFrame:
    """undecided with the hash of each cell's tuple, and its bytes from its first window's first to its last window's last."""
    found = _by_document(undecided, "p", "first", "last")
    joined = base.join(found, _same_document(base, found)).select("_id", "_tie", "_text", "_found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(b.num_rows):
                text, cells_ = b.column(2)[s].as_py(), b.column(3)[s].values
                p, first, last = (cells_.field(n).to_numpy(zero_copy_only=False) for n in ("p", "first", "last"))
                k = np.array([xxhash.xxh64_intdigest(text[x : x + K]) for x in p.tolist()], np.uint64).view(np.int64)
                bytes_ = [text[x - f : x - e + size] for x, f, e in zip(p.tolist(), first.tolist(), last.tolist(), strict=True)]
                n = len(p)
                one = pa.array(np.full(n, s))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k), b.column(0).take(one), b.column(1).take(one), pa.array(p), pa.array(first), pa.array(last), pa.array(bytes_, pa.binary())],
                    ["k", "_id", "_tie", "p", "first", "last", "bytes"],
                )

    kind = base.schema["_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"k long, _id {kind}, _tie long, p int, first short, last short, bytes binary")


def repeated_windows(k: np.ndarray, first: np.ndarray, last: np.ndarray, texts: list[bytes], size: int) -> np.ndarray:
    """Two columns, for each cell the greatest and least distance of a repeated window to the sample; -1 if there is none.

    Cells come in order; windows are equal if distance and bytes are. Equal hashes are verified; if one ever deceives, the
    windows of that distance are told apart by their bytes.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum([0, *map(len, texts)])[:-1]
    hashes = Hashes(data)
    out = np.full((len(k), 2), -1)
    for d in range(int(first.max()) + 1):
        rows = np.flatnonzero((last <= d) & (d <= first))
        if len(rows) < 2:
            continue
        start = begin[rows] + first[rows] - d
        name = _mix(hashes.of(start, start + size) + k[rows].view(np.uint64))
        _, index, of = np.unique(name, return_index=True, return_inverse=True)
        seen = np.ones(len(rows), bool)
        seen[index] = False
        same = data[start[seen][:, None] + np.arange(size)] == data[start[index[of[seen]]][:, None] + np.arange(size)]
        if not same.all():
            met: set[bytes] = set()
            for i, at in enumerate(start.tolist()):
                window = data[at : at + size].tobytes()
                seen[i] = window in met
                met.add(window)
        again = rows[seen]
        out[again, 0] = d
        out[again[out[again, 1] < 0], 1] = d
    return out


def merge_windows(context: DataFrame, size: int) -> DataFrame:
    """Covered stretches (a, b) of documents, from cells whose tuple name has several cells."""
    order = [F.col("k"), F.col("_id").asc_nulls_last(), F.col("_tie"), F.col("p"), F.col("first").desc()]
    dealt = context.repartition("k").sortWithinPartitions(*order)

    def decide(t: pa.Table) -> pa.RecordBatch | None:
        # Repeated rows of one document stand together and count once.
        same = [t[n].to_numpy() for n in ("k", "_tie", "p", "first")]
        new = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in same], axis=0)])
        t = t.filter(pa.array(new)).combine_chunks()
        k, p, first, last = (t[n].to_numpy().astype(np.int64) for n in ("k", "p", "first", "last"))
        far = repeated_windows(k, first, last, t["bytes"].to_pylist(), size)
        hit = np.flatnonzero(far[:, 0] >= 0)
        if not len(hit):
            return None
        # Repeated windows of a cell start less than a window apart, so together they cover one stretch.
        take = pa.array(hit)
        a, b = p[hit] - far[hit, 0], p[hit] - far[hit, 1] + size
        cols = [t["_id"].take(take).combine_chunks(), t["_tie"].take(take).combine_chunks(), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))]
        return pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols], ["_id", "_tie", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(k[1:] != k[:-1])
            if rows >= 4_000 and (len(cut) or (held and held[-1].column(0)[-1].as_py() != k[0])):
                # All names but the last one of the batch are whole.
                end = int(cut[-1]) + 1 if len(cut) else 0
                held.append(batch.slice(0, end))
                if out := decide(pa.Table.from_batches([h for h in held if h.num_rows])):
                    yield out
                held, rows = [], 0
                batch = batch.slice(end)
            held.append(batch)
            rows += batch.num_rows
        if rows and (out := decide(pa.Table.from_batches([h for h in held if h.num_rows]))):
            yield out

    kind = context.schema["_id"].dataType.simpleString()
    return dealt.mapInArrow(run, f"_id {kind}, _tie long, a int, b int")


def windows_by_hash(context: DataFrame, size: int) -> DataFrame:
    """Covered stretches (a, b), as merge_windows finds them, for names of any number of cells: every window is dealt by two
    hashes of its bytes; of those that a task sees twice all but the first are covered and go no further."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ties = b.column(2).to_numpy(zero_copy_only=False)
            rank = _ranks(b.column(1), ties)
            for s in range(0, b.num_rows, 500):
                part = b.slice(s, 500)
                p, first, last = (part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 4, 5))
                texts = part.column(6).to_pylist()
                data = np.frombuffer(b"".join(texts), np.uint8)
                begin = np.cumsum([0, *map(len, texts)])[:-1]
                many = first - last + 1
                cell = np.repeat(np.arange(len(p)), many)
                step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                at, start = begin[cell] + step, p[cell] - first[cell] + step
                x, y = (Hashes(data, w).of(at, at + size) for w in (0, 1))
                row = s + cell
                done = _seen(x ^ _mix(y), rank[row], start)
                x = np.where(done, _mix(ties[row].view(np.uint64) + start.astype(np.uint64)), x)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [_signed(x), _signed(y), b.column(1).take(take), b.column(2).take(take), pa.array(start.astype(np.int32)), pa.array(done)], ["x", "y", "_id", "_tie", "a", "done"]
                )

    kind = context.schema["_id"].dataType.simpleString()
    rows = context.mapInArrow(run, f"x long, y long, _id {kind}, _tie long, a int, done boolean")
    place = Window.partitionBy("x", "y").orderBy(F.col("_id").asc_nulls_last(), "_tie", "a")
    return rows.withColumn("_rank", F.rank().over(place)).filter("done or _rank > 1").select("_id", "_tie", "a", (F.col("a") + size).alias("b"))


def covered(base: DataFrame, size: int = SIZE, segment: int = SEGMENT, max_name: int = MAX_NAME, hot_share: float = HOT_SHARE) -> DataFrame:
    """Stretches (_id, _tie, a, b) that strings seen earlier cover."""
    rows = sampled_cells(base, size, segment, hot_names(base, size, segment, hot_share))
    name = Window.partitionBy("n")
    cell = Window.partitionBy("n", "c").orderBy(F.col("_id").asc_nulls_last(), "_tie", "p")
    rows = rows.withColumns({"_low": F.min("c").over(name), "_high": F.max("c").over(name)})
    rows = rows.withColumn("repeat", (F.col("state") == REPEAT) | (F.rank().over(cell) > 1)).filter(F.col("repeat") | (F.col("_low") != F.col("_high")) | (F.col("state") == HOT))
    rows = materialize(rows.select("_id", "_tie", "p", "first", "last", "repeat"), "cells")
    whole = rows.filter("repeat").select("_id", "_tie", (F.col("p") - F.col("first")).alias("a"), (F.col("p") - F.col("last") + size).alias("b"))
    context = materialize(_with_context(base, rows.filter("not repeat"), size), "context")
    large = materialize(context.groupBy("k").agg(F.count("*").alias("m")).filter(F.col("m") > max_name).select("k"), "large")
    if large.isEmpty():
        return whole.unionByName(materialize(merge_windows(context, size), "windows"))
    parts = merge_windows(context.join(large, "k", "left_anti"), size).unionByName(windows_by_hash(context.join(large, "k", "left_semi"), size))
    return whole.unionByName(materialize(parts, "windows"))


def _base(docs: DataFrame, key: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(F.col(key).alias("_id"), F.xxhash64(whole).alias("_tie"), whole.alias("_text"))


def _cut(text: bytes, found: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes left, how many were removed, and in how many runs. found: rows of a and b."""
    edge = np.zeros(len(text) + 1, np.int32)
    np.add.at(edge, found[:, 0], 1)
    np.add.at(edge, found[:, 1], -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, segment: int = SEGMENT, **dealing: float) -> DataFrame:
    """One row per document: key, kept (the bytes left), n_bytes, n_removed, n_spans. dealing: as covered takes it."""
    base = _base(docs, key, text)
    found = _by_document(covered(base, size, segment, **dealing), "a", "b")
    joined = base.join(found, _same_document(base, found), "left").select("_id", "_text", "_found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 128):
                part = b.slice(s, 128)
                kept, counts = [], []
                for i, t in enumerate(part.column(1).to_pylist()):
                    if part.column(2)[i].is_valid:
                        v = part.column(2)[i].values
                        left, n, runs = _cut(t, np.stack([v.field("a").to_numpy(), v.field("b").to_numpy()], axis=1))
                    else:
                        left, n, runs = t, 0, 0
                    kept.append(left)
                    counts.append((len(t), n, runs))
                cols = np.array(counts, dtype=np.int64).T
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(kept, pa.binary()), *[pa.array(c) for c in cols]], ["_id", "kept", "n_bytes", "n_removed", "n_spans"])

    kind = base.schema["_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"_id {kind}, kept binary, n_bytes long, n_removed long, n_spans long").withColumnRenamed("_id", key)


def repeat_digest(cut: DataFrame, key: str = "doc_id") -> DataFrame:
    return cut.select(key, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
