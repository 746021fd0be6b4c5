"""Benchmark decontamination.

Words are runs of ASCII letters (lower-cased), digits and anything beyond ASCII. A window is ten consecutive words of a
benchmark item; an item of fewer words is one window. The windows are a hash set broadcast to the tasks (unpacked once by
each worker process), which scan the training token windows, verify every hit word by word, and report or remove what is
covered.

The set is broadcast only while the benchmark has at most MAX_ITEM_WORDS words, which is counted first. A larger
benchmark is dealt by hash into as many parts as it needs: one part at a time is fetched, broadcast and scanned for, always
over the untouched texts, and what is hit is united before anything is cut.

Defined results: a null or empty text has no words and is clean; a null or wordless item text has no window; items with
equal text are all reported, rows of one item id are one item; the windows of an item without an id hit as any other, but
as it has no name it is in neither n_items nor items_sha256; repeated rows are reported each. Other columns, whatever
their names, pass through the filters untouched. Empty tables give empty or clean results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import hidden, materialize

WINDOW = 10
MAX_ITEM_WORDS = 1_000_000
NO_HIT = np.zeros(0, np.int64)

_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz"
# Byte to byte: A-Z to a-z, everything that is in no word to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or b in _WORD_BYTES else 32 for b in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def item_words(text: bytes) -> list[bytes]:
    # bytes.split() cuts at ASCII white space only, so bytes of longer characters stay whole.
    return text.translate(_FOLD).split()


class WindowSet:
    """The benchmark's windows: words as dense ids, windows by a rolling hash with their ids kept for verification."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW) -> None:
        self.ids: dict[bytes, int] = {}
        self.windows: dict[int, dict[bytes, list[str | None]]] = {}
        for item, text in items:
            ws = item_words(text)
            if not ws:
                continue
            seq = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in ws], dtype=np.int32)
            size = min(window, len(seq))
            for i in range(len(seq) - size + 1):
                names = self.windows.setdefault(size, {}).setdefault(seq[i : i + size].tobytes(), [])
                if not names or names[-1] != item:
                    names.append(item)
        self.hashes = {
            size: np.sort(self._hash(np.frombuffer(b"".join(found), dtype=np.int32).reshape(-1, size).T.astype(np.uint64)))
            for size, found in self.windows.items()
        }

    @staticmethod
    def _hash(columns: np.ndarray) -> np.ndarray:
        h = np.zeros(columns.shape[1], dtype=np.uint64)
        for c in columns:
            h = (h + c) * _MULTIPLIER
        return h

    def scan(self, text: bytes) -> tuple[int, np.ndarray | None, set[str]]:
        """Words, which of them are hit (None: none), and the ids of the items whose windows occur."""
        ws = item_words(text)
        n = len(ws)
        get = self.ids.get
        seq = np.fromiter((get(w, 0) for w in ws), dtype=np.int32, count=n)
        hit, items = None, set()
        for size, hashes in self.hashes.items():
            if n < size:
                continue
            # Only windows without an unknown word can match.
            known = np.concatenate(([0], np.cumsum(seq > 0)))
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            h = self._hash(np.stack([seq[at + k] for k in range(size)]).astype(np.uint64))
            pos = np.searchsorted(hashes, h)
            pos[pos == len(hashes)] = 0
            found = self.windows[size]
            for i in at[hashes[pos] == h]:
                names = found.get(seq[i : i + size].tobytes())
                if names:
                    if hit is None:
                        hit = np.zeros(n, dtype=bool)
                    hit[i : i + size] = True
                    items.update(names)
        items.discard(None)
        return n, hit, items


def without_words(text: str, at: np.ndarray) -> str:
    """The text less its words at the given positions; what stands between two of them that follow each other goes too."""
    data = text.encode()
    folded = np.frombuffer(data.translate(_FOLD), dtype=np.uint8) != 32
    edges = np.diff(np.concatenate(([0], folded.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    keep = np.ones(len(data), dtype=bool)
    hit = np.zeros(len(starts), dtype=np.int8)
    hit[at] = 1
    runs = np.diff(np.concatenate(([0], hit, [0])))
    for a, b in zip(np.flatnonzero(runs == 1), np.flatnonzero(runs == -1), strict=True):
        keep[starts[a] : ends[b - 1]] = False
    return np.frombuffer(data, dtype=np.uint8)[keep].tobytes().decode()


def _parts(benchmark: DataFrame, item: str, text: str, limit: int) -> list[DataFrame]:
    """The items (item, text), dealt so that no part has more than about limit words; only their words are counted here."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"] // 2
    parts = total // limit + 1
    return [rows] if parts == 1 else [rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k) for k in range(parts)]


def _binary(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def scanned(
    docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, window: int, max_item_words: int, keep_text: bool = True
) -> tuple[DataFrame, str, str, str]:
    """docs with three more columns, and their names: number of words, positions of the hit words, ids of the items met.

    A row's hits travel with it from part to part; between parts the rows are written, so that one set is held at a time.
    Without keep_text the texts are null in the result, and not sent back from the last scan.
    """
    names = hidden(docs, "_words", "_hit", "_items")
    none = {names[0]: F.lit(0).cast("long"), names[1]: F.array().cast("array<int>"), names[2]: F.array().cast("array<string>")}
    out, schema = docs, docs.withColumns(none).schema
    width, at = len(docs.columns), docs.columns.index(text)
    parts = _parts(benchmark, item, item_text, max_item_words)
    for i, part in enumerate(parts):
        known = WindowSet([(r["item"], bytes(r["text"])) for r in part.collect()], window)
        shared = docs.sparkSession.sparkContext.broadcast(known)
        out = out if i == 0 else materialize(out, "decon")
        drop = not keep_text and i == len(parts) - 1

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, drop=drop) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for b in batches:
                for s in range(0, b.num_rows, 256):
                    piece = b.slice(s, 256)
                    n_words, hits, items = [], [], []
                    for t in _binary(piece.column(at)):
                        n, hit, found = known.scan(t)
                        n_words.append(n)
                        hits.append(NO_HIT if hit is None else np.flatnonzero(hit))
                        items.append(found)
                    if piece.num_columns > width:  # what earlier parts have met
                        hits = [np.union1d(x, np.array(y, np.int64)) for x, y in zip(hits, piece.column(width + 1).to_pylist(), strict=True)]
                        items = [{*x, *y} for x, y in zip(items, piece.column(width + 2).to_pylist(), strict=True)]
                    ends = np.cumsum([0, *map(len, hits)], dtype=np.int32)
                    places = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([NO_HIT, *hits]).astype(np.int32)))
                    kept = piece.columns[:width]
                    if drop:
                        kept[at] = pa.nulls(piece.num_rows, kept[at].type)
                    cols = [*kept, pa.array(n_words, pa.int64()), places, pa.array([sorted(x) if x else () for x in items], pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(cols, schema.names)

        out = out.mapInArrow(scan, schema)
    return out, *names


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, max_item_words: int = MAX_ITEM_WORDS,
) -> DataFrame:
    """One row per document: words, hit words, the items whose windows occur, and whether any does."""
    base = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    found, words, hit, items = scanned(base, benchmark, "_text", item, item_text, window, max_item_words, keep_text=False)
    return found.select(
        F.col("_key").alias(key), F.col(words).alias("n_words"), F.size(hit).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (F.size(hit) > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", mode: str = "documents",
    window: int = WINDOW, max_item_words: int = MAX_ITEM_WORDS,
) -> DataFrame:
    """docs without contaminated documents (mode "documents"), or with hit spans cut out of their texts ("spans")."""
    found, _, hit, _ = scanned(docs, benchmark, text, item, item_text, window, max_item_words)
    if mode == "documents":
        return found.filter(F.size(hit) == 0).select(*docs.columns)
    found = found.select(*docs.columns, hit)
    at = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 256):
                piece = b.slice(s, 256)
                texts = [without_words(t, np.array(h)) if h else t for t, h in zip(piece.column(at).to_pylist(), piece.column(-1).to_pylist(), strict=True)]
                yield piece.set_column(at, piece.schema.field(at), pa.array(texts, piece.schema.field(at).type)).drop_columns([hit])

    return found.mapInArrow(cut, docs.schema)
