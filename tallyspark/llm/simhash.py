"""Near-duplicates by SimHash and BK-trees.

Texts become 64-bit fingerprints over three-word shingles. Equal fingerprints are one node. Two fingerprints within two
bits agree on at least one of three blocks of bits, so each goes to three shards, keyed by a block and its value. A
shard is a BK-tree: a node's children are keyed by their integer Hamming distance to it, and a search follows only
edges within the radius of its own distance. Shards meet their queries by key in a shuffle instead of a broadcast: all
shards together grow with the corpus, so no bound on their size could be proven. A shard of more than MAX_GROUP
fingerprints is dealt to other tasks by three blocks of its remaining bits, and within a task one of more than
MAX_SHARD again; both are exact, as the three-block rule holds for any bits that may still differ.

Of a shard's links only those that join two classes are written: that keeps every connection and lists no quadratic
number of pairs. Components are labelled by passing smallest labels along the links until none changes.

Defined results: null, empty and blank texts have fingerprint zero, which links like any other. Copies and repeated
rows share a fingerprint. A null key is never a component's name unless all its keys are null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import hidden, materialize

SHINGLE = 3
RADIUS = 2
SEED = 42
MAX_SHARD = 2_000
MAX_GROUP = 200_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SHIFTS = np.arange(64, dtype=np.uint64)


def shingles(text: bytes, shingle: int) -> Iterable[bytes]:
    """Runs of so many words; fewer words are one shingle, no words none."""
    ws = text.translate(_LOWER).split()
    if len(ws) <= shingle:
        return [b" ".join(ws)] if ws else []
    return map(b" ".join, zip(*[ws[k:] for k in range(shingle)]))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if it is in over half of the shingles' hashes; repeats count."""
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, SEED) for g in shingles(text, shingle)), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for s in range(0, len(h), 8192):
        bits = np.unpackbits(h[s : s + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << _SHIFTS[2 * ones > len(h)]).sum(dtype=np.uint64)) if len(h) else 0


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp): the fingerprint as a signed long."""
    base = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for s in range(0, b.num_rows, 256):
                found += [fingerprint(t or b"", shingle) for t in b.column(1).slice(s, 256).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], ["_key", "fp"])

    return base.mapInArrow(run, f"_key {base.schema['_key'].dataType.simpleString()}, fp long").withColumnRenamed("_key", key)


class BKTree:
    """Nodes in arrays; children by integer distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        if not self.values:
            self.values.append(value)
            self.children.append({})
            return
        node = 0
        while True:
            d = (self.values[node] ^ value).bit_count()
            if d == 0:
                return
            nxt = self.children[node].get(d)
            if nxt is None:
                self.children[node][d] = len(self.values)
                self.values.append(value)
                self.children.append({})
                return
            node = nxt

    def within(self, value: int, radius: int) -> list[int]:
        found, stack = [], [0] if self.values else []
        while stack:
            node = stack.pop()
            d = (self.values[node] ^ value).bit_count()
            if d <= radius:
                found.append(self.values[node])
            kids = self.children[node]
            stack += [kids[k] for k in range(max(1, d - radius), d + radius + 1) if k in kids]
        return found


def blocks(radius: int, bits: list[int]) -> list[int]:
    """Masks of radius + 1 blocks of the given bits: values within the radius agree on one of them."""
    cut = [bits[i * len(bits) // (radius + 1) : (i + 1) * len(bits) // (radius + 1)] for i in range(radius + 1)]
    return [sum(1 << b for b in c) for c in cut]


def shard_links(values: list[int], radius: int, bits: list[int], most: int = MAX_SHARD) -> Iterator[tuple[int, int]]:
    """Links that connect all values within the radius, each value to the smallest of its neighbours.

    values agree on all but the given bits. Too many of them are dealt again by blocks of those bits.
    """
    if len(values) > most and len(bits) > radius:
        for mask in blocks(radius, bits):
            rest = [b for b in bits if not mask >> b & 1]
            dealt: dict[int, list[int]] = {}
            for v in values:
                dealt.setdefault(v & mask, []).append(v)
            for group in dealt.values():
                if len(group) > 1:
                    yield from shard_links(group, radius, rest, most)
        return
    tree, parent = BKTree(), {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for v in values:
        parent[v] = v
        for near in tree.within(v, radius):
            if (r := root(near)) != root(v):
                parent[r] = root(v)
                yield v, near
        tree.add(v)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _free(masks: list[int]) -> list[int]:
    return [b for b in range(64) if not any(m >> b & 1 for m in masks)]


def shards(nodes: DataFrame, radius: int = RADIUS, max_group: int = MAX_GROUP) -> DataFrame:
    """(fp, block, value, part, inner): the shards each fingerprint goes to; part is -1 in shards that were not dealt again."""
    outer = blocks(radius, list(range(64)))
    masked = lambda masks: F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])
    keyed = nodes.select("fp", F.posexplode(masked(outer)).alias("block", "value"))
    # Few shards are so large, and counting sums map-side; the join is left to adaptive execution, as their number has no bound.
    large = keyed.groupBy("block", "value").agg(F.count("*").alias("_n")).filter(F.col("_n") > max_group)
    keyed = keyed.join(large, ["block", "value"], "left")
    again = F.get(F.array(*[masked(blocks(radius, _free([m]))) for m in outer]), F.col("block"))
    each = F.when(F.col("_n").isNull(), F.array(F.lit(0).cast("long"))).otherwise(again)
    dealt = keyed.select("fp", "block", "value", F.col("_n").isNull().alias("_whole"), F.posexplode(each).alias("part", "inner"))
    return dealt.withColumn("part", F.when(F.col("_whole"), -1).otherwise(F.col("part"))).drop("_whole")


def links(nodes: DataFrame, radius: int = RADIUS, max_group: int = MAX_GROUP) -> DataFrame:
    """(a, b): links among the distinct fingerprints fp of nodes that connect all pairs within the radius."""
    outer = blocks(radius, list(range(64)))
    free = {}
    for i, m in enumerate(outer):
        free[i, -1] = _free([m])
        free |= {(i, j): _free([m, n]) for j, n in enumerate(blocks(radius, free[i, -1]))}
    keys = ("block", "value", "part", "inner")
    dealt = shards(nodes, radius, max_group).repartition(*keys).sortWithinPartitions(*keys)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        key = None

        def flush() -> pa.RecordBatch | None:
            if len(held) < 2:
                return None
            found = list(shard_links(held, radius, free[key[0], key[2]]))
            if not found:
                return None
            return pa.RecordBatch.from_arrays([pa.array(np.array(c, dtype=np.uint64).view(np.int64)) for c in zip(*found, strict=True)], ["a", "b"])

        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5)]
            if not len(fp):
                continue
            edges = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
            for s, e in zip([0, *edges], [*edges, len(fp)], strict=True):
                this = tuple(int(c[s]) for c in cols)
                if this != key:
                    if out := flush():
                        yield out
                    key, held = this, []
                held += fp[s:e].tolist()
        if out := flush():
            yield out

    return dealt.mapInArrow(search, "a long, b long").distinct()


def _starred(edges: DataFrame) -> bool:
    """Whether each node of the edges (a, b) that is an a has one b, which is no a: b is its root. True of no edges."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("top")).union(edges.select("b", F.lit(0), F.lit(1)))
    most = ends.groupBy("node").agg((F.sum("low") + F.when(F.sum("low") > 0, F.max("top")).otherwise(0)).alias("n")).agg(F.max("n").alias("n")).first()["n"]
    return most is None or most <= 1


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) reaches, by alternating large and small stars.

    Each round is written; the rounds grow with the logarithm of the longest path, and end when each node has its root alone.
    No neighbour list is collected.
    """
    edges = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _starred(edges):
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).union(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        edges = materialize(small, "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _rooted(docs: DataFrame, key: str, text: str, radius: int, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and the fingerprints with their least key and root."""
    fps = materialize(fingerprints(docs, key, text, shingle), "simhash")
    nodes = fps.groupBy("fp").agg(F.min(key).alias("least"))
    roots = components(links(nodes.select("fp"), radius))
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return fps, materialize(named, "simhash-root")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: its fingerprint in hex and the smallest key that its links reach."""
    fps, named = _rooted(docs, key, text, radius)
    # Only fingerprints with links need the second grouping.
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = named.select("fp", "root").join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    out = fps.join(of_fp, fps.fp == of_fp._fp)
    return out.select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def text_hash(text: str) -> Column:
    return F.xxhash64(text)


def rows_of(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """docs joined with wanted (_key, _text_hash, n, and more columns), one row of each; n: how many rows of docs have that key and text.

    Texts move once: rows that are alone need no more than the join, and only the others are told apart from their repeats.
    """
    mark, of, of_hash = hidden(docs, "_mark", "_wanted", "_wanted_hash")
    marked = docs.withColumn(mark, text_hash(text))
    more = [c for c in wanted.columns if c not in ("_key", "_text_hash", "n")]

    def join(part: DataFrame) -> DataFrame:
        part = part.select(F.col("_key").alias(of), F.col("_text_hash").alias(of_hash), *more)
        return marked.join(part, marked[key].eqNullSafe(part[of]) & (marked[mark] == part[of_hash])).drop(of, of_hash)

    alone, repeated = join(wanted.filter("n = 1")), join(materialize(wanted.filter("n > 1"), "repeated"))
    return alone.unionByName(repeated.dropDuplicates([key, mark])).drop(mark)


def keep_one(docs: DataFrame, rooted: DataFrame, key: str, text: str) -> DataFrame:
    """docs with one row of each root of rooted (_key, _text_hash, root): that of the smallest key, null last, then of the
    smallest text hash. Repeated rows of equal key and text are one."""
    order = F.struct(F.col("_key").isNull().alias("_null"), "_key", "_text_hash", "n")
    rows = rooted.groupBy("root", "_key", "_text_hash").agg(F.count("*").alias("n"))
    reps = rows.groupBy("root").agg(F.min(order).alias("_least")).select("_least._key", "_least._text_hash", "_least.n")
    return rows_of(docs, materialize(reps, "kept"), key, text).select(*docs.columns)


def keep_representatives(
    docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, similarity: float | None = None
) -> DataFrame:
    """docs with one row of each component, chosen by keep_one.

    Without a similarity, links are fingerprints within the radius. With one, they are pairs of at least that Jaccard
    similarity of their shingles, found as near_copies says: fingerprints of 64 bits would need a radius of 13 to link nine in
    ten pairs at 0.8, more than blocks of bits can deal.
    """
    if similarity is not None:
        from tallyspark.llm import near_copies

        return near_copies.keep_representatives(docs, key, text, shingle, similarity)
    hashed = docs.select(F.struct(F.col(key).alias("_key"), text_hash(text).alias("_text_hash")).alias("_row"), text)
    fps, named = _rooted(hashed, "_row", text, radius, shingle)
    return keep_one(docs, fps.join(named.select("fp", "root"), "fp").select("_row.*", "root"), key, text)
