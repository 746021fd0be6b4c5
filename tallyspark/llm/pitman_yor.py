"""Hierarchical Pitman-Yor language model over words.

Two levels of restaurants: one for each context, the bucket of the word before (CONTEXTS buckets, so that what tasks exchange
is bounded; on 0.015 GB, 4 million tokens, held-out texts score -3.616 a token with 2^16 buckets and -3.558 with 2^20), and their shared parent, whose base is uniform over the known words and one unknown. The seating of each
word in each restaurant is sampled by Gibbs: the number of its tables is drawn from its full conditional given the other
words' tables and the parent's probability: by tables of generalised Stirling numbers up to STIRLING customers, and by an exact
rejection draw beyond (seat_many). Where that finds none in TRIES tries, as the parent asks for far more tables than so many
customers fill, those beyond STIRLING are seated in growing blocks, a forward draw, which gives too many tables. Tables are the parent's customers. Predictive probabilities are averaged over the
sweeps of the last phase.

At scale: texts become packed arrays of (word hash, context, count), dealt by word, so that a task owns whole words and
their customers in the parent. Hot words are dealt by context too, hot pairs of word and context by document too; there is
a bounded number of either. Tasks exchange tables by context, and customers and tables of hot words and pairs, before each
phase: a restaurant's other tables are those of all tasks at the exchange, moved on by what the task itself has changed
since. What is exchanged has a fixed size, is summed in blocks on the executors, and reaches the driver once. The driver
seats the hot pairs and the hot words' tables in the parent, as these belong to no task. The probabilities that are
reported use the sums over all tasks, so they add up to one. Each pass runs the same chains again (same seeds) over the
dealt data. RDDs are used because the dealt data serve all passes: their shuffle files are kept between jobs and rebuilt
from lineage if an executor is lost.

How words are dealt follows from the corpus alone, not from partitions, executors or cores, so neither do the scores. Rows
are put in order within their partition (by key and text), so a partition that is worked out again numbers them alike.

Defined results: a null text is empty and holds just the end token. Rows with a null id are learnt from. Repeated rows
are scored, and learnt from, each. With nothing to learn from every word is unknown. Other columns are ignored. A text of
any length is one row of packed counts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import ascii_lower, materialize, words

BITS = 18
CONTEXTS = 1 << BITS
# Sweeps of each phase; tasks exchange their tables before each, and those of the last one are the samples.
SWEEPS = (2, 2)
SAMPLES = SWEEPS[-1]
STIRLING = 512  # customers up to which the numbers are tabled
TERMS, REACH, TRIES = 80, 3.0, 400
PER_TASK = 3_000_000
HOT_SAMPLE = 15_000
HOT_SHARES = (2e-5, 1e-3)
FLUSH = 500_000
BLOCK = 1 << 12
# Discount and strength of the contexts and of the parent.
LEAF = (0.8, 2.0)
ROOT = (0.7, 20.0)

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_END = 0  # the end token's word number, and the context of the first word


def learnt(key: object) -> bool:
    return key is None or zlib.crc32(str(key).encode()) % 7 != 2


class _Numbers(dict):
    """Word to its 64-bit number, never that of the end token."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        n = self[word] = max(1, xxhash.xxh64_intdigest(word))
        return n


def tokens(text: str | None, numbers: _Numbers) -> np.ndarray:
    ws = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    out = np.zeros(len(ws) + 1, np.uint64)
    out[:-1] = np.fromiter(map(numbers.__getitem__, ws), np.uint64, len(ws))
    return out


def number(word: str) -> int:
    return max(1, xxhash.xxh64_intdigest(word.encode("utf-8", "replace")))


def context_of(before: np.ndarray) -> np.ndarray:
    """Bucket of the word before; the top bits of its number, which are as good as random."""
    return (before >> np.uint64(64 - BITS)).astype(np.uint32)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _find(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are among the sorted ones, and where."""
    if not len(among):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    place = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[place] == values, place


def pair_key(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    h = word ^ ((context.astype(np.uint64) + np.uint64(1)) * _MIX)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Hot:
    """Numbers of hot words, sorted; hot pairs of such a word and a context, sorted by key."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # keys
    pair_word: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    pair_context: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))

    @classmethod
    def of(cls, words_: Iterable[int], pairs: Iterable[tuple[int, int]]) -> Hot:
        """pairs: of a hot word and the word before it."""
        found = sorted(set(words_))
        both = np.array(list(pairs), np.uint64).reshape(-1, 2)
        w, c = both[:, 0], context_of(both[:, 1])
        keys, at = np.unique(pair_key(w, c), return_index=True)
        return cls(np.array(found, np.uint64), keys, w[at], c[at])


def _bucket(word: np.ndarray, context: np.ndarray, salt: np.ndarray, hot: Hot, parts: int) -> np.ndarray:
    """Where pairs go: by word, hot words by context too, hot pairs by document too."""
    is_hot, _ = _find(word, hot.words)
    spread = word + np.where(is_hot, context.astype(np.uint64) + np.uint64(1), np.uint64(0))
    at = np.flatnonzero(is_hot)
    again = at[_find(pair_key(word[at], context[at]), hot.pairs)[0]]
    spread[again] += salt[again] * np.uint64(0xD6E8FEB86659FD93)
    return ((spread * _MIX) >> np.uint64(33)) % np.uint64(parts)


def pack(source: int, rows: Iterator, parts: int, hot: Hot) -> Iterator[tuple[int, tuple]]:
    """(bucket, (source, first number, numbers, which are learnt from, rows, words, contexts, counts)) for runs of documents."""
    numbers, held, ids, total, done = _Numbers(), [], [], 0, 0

    def flush() -> Iterator[tuple[int, tuple]]:
        doc = np.concatenate([np.full(len(w), i, np.int32) for i, (w, _, _) in enumerate(held)])
        word, context, count = (np.concatenate([h[k] for h in held]) for k in range(3))
        to = _bucket(word, context, doc.astype(np.uint64) + np.uint64(done), hot, parts)
        order = np.argsort(to, kind="stable")
        # Only buckets that get something: with many parts these are few of them.
        found, begins = np.unique(to[order], return_index=True)
        learn = np.array([learnt(i) for i in ids])
        for b, at in zip(found.tolist(), np.split(order, begins[1:]), strict=True):
            docs, row = np.unique(doc[at], return_inverse=True)
            yield b, (source, done, docs, learn[docs], row.astype(np.int32).tobytes(), word[at].tobytes(), context[at].tobytes(), count[at].tobytes())

    for key, text in rows:
        w = tokens(text, numbers)
        c = context_of(np.concatenate([np.zeros(1, np.uint64), w[:-1]]))
        # Equal pairs of a document travel once.
        order = np.lexsort((c, w))
        w, c = w[order], c[order]
        new = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (c[1:] != c[:-1])]))
        held.append((w[new], c[new], np.diff(np.append(new, len(w))).astype(np.int32)))
        ids.append(key)
        total += len(new)
        if total >= FLUSH:
            yield from flush()
            done += len(ids)
            held, ids, total = [], [], 0
    if held:
        yield from flush()


@cache
def _log_stirling(discount: float, most: int = STIRLING) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers, by customers and tables."""
    s = np.full((most + 1, most + 2), -np.inf)
    s[0, 0] = 0.0
    t = np.arange(most + 2)
    for c in range(most):
        with np.errstate(divide="ignore"):
            stay = np.where((t > 0) & (t <= c), np.log(np.maximum(c - discount * t, 0)) + s[c], -np.inf)
        s[c + 1, 1:] = np.logaddexp(s[c, :-1], stay[1:])
    return s


@cache
def _series(discount: float) -> tuple[np.ndarray, float]:
    """What terms of overlap() are multiplied by, one for each j; and the largest overlap there is, with a margin."""

    def over(j: int) -> float:
        try:
            return math.gamma(-discount) / math.gamma(-j * discount)
        except ValueError:  # at a pole
            return 0.0

    factors = np.array([(-1) ** (j - 1) * over(j) for j in range(1, TERMS + 1)])
    many = 10**7
    t = (np.linspace(0.0, REACH, 200) * many**discount).astype(np.int64) + 1
    return factors, 1.3 * float(overlap(t, np.full(len(t), many), discount, factors).max())


def overlap(t: np.ndarray, customers: np.ndarray, discount: float, factors: np.ndarray) -> np.ndarray:
    """The Stirling number of the customers and t tables, divided by what it tends to with many customers: the number of
    (customers, 1) over discount^(t-1) (t-1)!. An alternating sum, exact to some 8 digits for t up to REACH customers^discount."""
    sizes, at = np.unique(customers, return_inverse=True)
    logs = np.array([[math.lgamma(c - j * discount) for j in range(1, TERMS + 1)] for c in sizes.tolist()]).reshape(len(sizes), TERMS)
    ratios = np.exp(np.diff(logs, axis=1))[at]
    term, out = np.ones(len(t)), np.full(len(t), factors[0])
    for j in range(2, TERMS + 1):
        term = term * (t - j + 1) / j * ratios[:, j - 2]
        out += factors[j - 1] * term
    return out


def seat_many(rng: np.random.Generator, customers: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, strength: float) -> np.ndarray:
    """As seat, for more than STIRLING customers; 0 where nothing was drawn.

    With many customers tables are one more than a negative binomial number. It is drawn, and kept with a probability in
    proportion to overlap(), which makes it a draw from the conditional itself.
    """
    factors, most = _series(discount)
    out = np.zeros(len(customers), np.int64)
    rows = np.arange(len(customers))
    reach = REACH * customers**discount
    for _ in range(TRIES):
        t = 1 + rng.negative_binomial(strength / discount + others[rows] + 1, 1 - parent[rows])
        near = t <= reach[rows]
        keep = np.zeros(len(rows), bool)
        keep[near] = rng.random(near.sum()) * most < overlap(t[near], customers[rows[near]], discount, factors)
        out[rows[keep]] = t[keep]
        rows = rows[~keep]
        if not len(rows):
            break
    return out


def forward(rng: np.random.Generator, customers: np.ndarray, tables: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, strength: float) -> np.ndarray:
    """Tables after STIRLING customers and then the others, who come in growing blocks and take what is there as it is."""
    tables, rows = tables.copy(), np.flatnonzero(customers > STIRLING)
    seated = np.full(len(rows), STIRLING, np.int64)
    while len(rows):
        block = np.minimum(customers[rows] - seated, np.maximum(1, seated // 8))
        fresh = (strength + discount * (others[rows] + tables[rows])) * parent[rows]
        tables[rows] += rng.binomial(block, fresh / (fresh + seated - discount * tables[rows]))
        seated += block
        left = customers[rows] > seated
        rows, seated = rows[left], seated[left]
    return tables


def seat(rng: np.random.Generator, customers: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, strength: float) -> np.ndarray:
    """Tables of each word of its customers, given the tables of the other words and the parent's probability."""
    tables = np.minimum(customers, 1)
    table = _log_stirling(discount)
    # Most types have one customer and one table; the others are sorted by a short key.
    order = np.flatnonzero(customers > 1)
    small = np.minimum(customers[order], STIRLING).astype(np.int16)
    by_size = np.argsort(small, kind="stable")
    order, small = order[by_size], small[by_size]
    edges = np.searchsorted(small, np.arange(STIRLING + 2, dtype=np.int16))
    for c in range(2, STIRLING + 1):
        group = order[edges[c] : edges[c + 1]]
        for s in range(0, len(group), 1 << 16):
            rows = group[s : s + (1 << 16)]
            t = np.arange(c)
            step = np.log(strength + discount * (others[rows, None] + t)) + np.log(parent[rows])[:, None]
            p = np.cumsum(step, axis=1) + table[c, 1 : c + 1]
            p = np.cumsum(np.exp(p - p.max(axis=1, keepdims=True)), axis=1)
            tables[rows] = 1 + (p < rng.random(len(rows))[:, None] * p[:, -1:]).sum(axis=1)
    many = np.flatnonzero(customers > STIRLING)
    if len(many):
        found = seat_many(rng, customers[many], others[many], parent[many], discount, strength)
        rest = many[found == 0]
        tables[rest] = forward(rng, customers[rest], tables[rest], others[rest], parent[rest], discount, strength)
        tables[many[found > 0]] = found[found > 0]
    return tables


@dataclass
class Dealt:
    """A task's share: types of (word, context) in order, with their training customers."""

    kind: np.ndarray  # type of each occurrence
    word: np.ndarray  # word index of each type
    context: np.ndarray
    customers: np.ndarray
    numbers: np.ndarray  # word numbers

    @classmethod
    def of(cls, word: np.ndarray, context: np.ndarray, count: np.ndarray, learn: np.ndarray) -> Dealt:
        numbers, index = np.unique(word, return_inverse=True)
        types, kind = np.unique((index << BITS) | context, return_inverse=True)
        customers = np.bincount(kind, weights=count * learn, minlength=len(types)).astype(np.int64)
        return cls(kind, types >> BITS, types & (CONTEXTS - 1), customers, numbers)

    def places(self, hot: Hot) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of words: which are hot, and where; of types: which are hot pairs, and where."""
        is_hot, place = _find(self.numbers, hot.words)
        at = np.flatnonzero(is_hot[self.word])
        found, where = _find(pair_key(self.numbers[self.word[at]], self.context[at].astype(np.uint32)), hot.pairs)
        is_pair, pair = np.zeros(len(self.word), bool), np.zeros(len(self.word), np.int64)
        is_pair[at], pair[at] = found, where
        return is_hot, place, is_pair, pair


Sums = dict[str, np.ndarray]


def add_up(dealt: Iterable[Sums]) -> Sums:
    out: Sums = {}
    for sums in dealt:
        for k, v in sums.items():
            out[k] = out[k] + v if k in out else v
    return out


def _sums(d: Dealt, hot: Hot, at: tuple, tables: np.ndarray, above: np.ndarray, tag: str = "") -> Sums:
    """Tables by context; the parent's customers by hot word; the parent's customers, and its tables of words that are not hot."""
    is_hot, place, _, _ = at
    people = np.bincount(d.word, weights=tables, minlength=len(d.numbers)).astype(np.int64)
    by_hot = np.zeros(len(hot.words), np.int64)
    by_hot[place[is_hot]] = people[is_hot]
    return {f"tables{tag}": np.bincount(d.context, weights=tables, minlength=CONTEXTS).astype(np.int64), f"hot{tag}": by_hot, f"total{tag}": np.array([people.sum(), above[~is_hot].sum()])}


def baseline(d: Dealt, hot: Hot) -> Sums:
    """Customers, and the sums of one table for each type that is learnt; hot pairs have their tables from the driver."""
    at = is_hot, place, is_pair, pair = d.places(hot)
    count = np.bincount(d.word, weights=d.customers, minlength=len(d.numbers)).astype(np.int64)
    out = _sums(d, hot, at, np.where(is_pair, 0, np.minimum(d.customers, 1)), np.minimum(count, 1))
    out |= {"customers": np.bincount(d.context, weights=d.customers, minlength=CONTEXTS).astype(np.int64), "count": np.zeros(len(hot.words), np.int64), "pairs": np.zeros(len(hot.pairs), np.int64), "tokens": np.array([d.customers.sum()])}
    out["count"][place[is_hot]] = count[is_hot]
    np.add.at(out["pairs"], pair[is_pair], d.customers[is_pair])
    return out


@dataclass
class Known:
    """What all tasks add up to: tables by context; the parent's customers and tables of hot words, and of all words; tables of hot pairs."""

    tables: np.ndarray
    hot_people: np.ndarray
    hot_above: np.ndarray
    people: int
    above: int
    pair_tables: np.ndarray

    def parent(self, people: np.ndarray, above: np.ndarray, uniform: float) -> np.ndarray:
        discount, strength = ROOT
        return (people - discount * above + (strength + discount * self.above) * uniform) / (strength + self.people)


@dataclass
class Model:
    """The counts that stay as they are, and the sums at each exchange, then of each sample."""

    hot: Hot
    customers: np.ndarray  # by context
    count: np.ndarray  # by hot word
    pairs: np.ndarray  # customers by hot pair
    n_tokens: int
    n_known: int
    exchanged: list[Known] = field(default_factory=list)
    samples: list[Known] = field(default_factory=list)

    @property
    def uniform(self) -> float:
        return 1.0 / (self.n_known + 1)

    @classmethod
    def start(cls, base: Sums, hot: Hot) -> Model:
        n_known = int(base["total"][1] + (base["count"] > 0).sum())
        model = cls(hot, base["customers"], base["count"], base["pairs"], int(base["tokens"][0]), n_known)
        model.exchanged.append(model._known(base, "", np.minimum(model.pairs, 1), np.minimum(model.count, 1)))
        return model

    def _pairs(self) -> Dealt:
        _, word = _find(self.hot.pair_word, self.hot.words)
        return Dealt(np.zeros(0, np.int64), word, self.hot.pair_context.astype(np.int64), self.pairs, self.hot.words)

    def _known(self, sums: Sums, tag: str, tables: np.ndarray, above: np.ndarray | np.random.Generator) -> Known:
        """The tasks' sums with the hot pairs' tables; above: the parent's tables of hot words, or what draws them."""
        d = self._pairs()
        people = sums[f"hot{tag}"] + np.bincount(d.word, weights=tables, minlength=len(self.hot.words)).astype(np.int64)
        if isinstance(above, np.random.Generator):
            last = self.exchanged[-1]
            above = seat(above, people, np.maximum(0, last.above - last.hot_above), np.full(len(people), self.uniform), *ROOT)
        by_context = sums[f"tables{tag}"] + np.bincount(d.context, weights=tables, minlength=CONTEXTS).astype(np.int64)
        total = sums[f"total{tag}"]
        return Known(by_context, people, above, int(total[0] + tables.sum()), int(total[1] + above.sum()), tables)

    def advance(self, sums: Sums) -> None:
        """Take in what the tasks add up to at the end of a phase, after seating the hot pairs as the tasks have seated theirs."""
        phase, d = len(self.exchanged) - 1, self._pairs()
        known = self.exchanged[-1]
        rng = np.random.default_rng([23, phase])
        parent = known.parent(known.hot_people, known.hot_above, self.uniform)[d.word]
        tables, found = known.pair_tables, []
        for sweep in range(SWEEPS[phase]):
            others = known.tables[d.context] - known.pair_tables
            tables = seat(rng, self.pairs, np.maximum(0, others), parent, *LEAF)
            if f"hot{sweep}" in sums:
                found.append(self._known(sums, str(sweep), tables, rng))
        if phase == len(SWEEPS) - 1:
            self.samples = found
        else:
            self.exchanged.append(self._known(sums, "", tables, rng))


def chains(d: Dealt, model: Model, at: tuple, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(phase, tables by type, the parent's customers and tables by word) after each sweep; hot words and pairs are the model's."""
    rng = np.random.default_rng([17, seed])
    is_hot, place, is_pair, _ = at
    customers = np.where(is_pair, 0, d.customers)
    n_words, uniform = len(d.numbers), model.uniform
    count_up = lambda tables: np.bincount(d.word, weights=tables, minlength=n_words).astype(np.int64)
    in_context = lambda tables: np.bincount(d.context, weights=tables, minlength=CONTEXTS).astype(np.int64)
    tables = np.minimum(customers, 1)
    above = np.minimum(count_up(tables), 1)
    for phase, known in enumerate(model.exchanged):
        elsewhere = known.tables - in_context(tables)
        for _ in range(SWEEPS[phase]):
            people = count_up(tables)
            if len(model.hot.words):
                people, above = np.where(is_hot, known.hot_people[place], people), np.where(is_hot, known.hot_above[place], above)
            parent = known.parent(people, above, uniform)
            others = (elsewhere + in_context(tables))[d.context] - tables
            tables = seat(rng, customers, np.maximum(0, others), parent[d.word], *LEAF)
            people = count_up(tables)
            above = seat(rng, np.where(is_hot, 0, people), np.maximum(0, known.above - above), np.full(n_words, uniform), *ROOT)
            yield phase, tables, people, above


def phase_sums(d: Dealt, model: Model, seed: int) -> Sums:
    """What the task adds to the sums at the end of the phase under way, or of each sample in the last one."""
    at, out, last = d.places(model.hot), {}, len(model.exchanged) - 1
    for sweep, (phase, tables, _, above) in enumerate(chains(d, model, at, seed)):
        if phase == last == len(SWEEPS) - 1:
            out |= _sums(d, model.hot, at, tables, above, str(sweep - sum(SWEEPS[:-1])))
        elif phase == last:
            out = _sums(d, model.hot, at, tables, above)
    return out


def probabilities(d: Dealt, model: Model, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The averaged predictive probability of each type, and the training count of each word."""
    at = is_hot, place, is_pair, pair = d.places(model.hot)
    seen = np.bincount(d.word, weights=d.customers, minlength=len(d.numbers)).astype(np.int64)
    customers = d.customers
    if len(model.hot.words):
        seen = np.where(is_hot, model.count[place], seen)
    if len(model.hot.pairs):
        customers = np.where(is_pair, model.pairs[pair], customers)
    p = np.zeros(len(d.word))
    samples = (x for x in chains(d, model, at, seed) if x[0] == len(SWEEPS) - 1)
    discount, strength = LEAF
    for known, (_, tables, people, above) in zip(model.samples, samples, strict=True):
        if len(model.hot.words):
            people, above = np.where(is_hot, known.hot_people[place], people), np.where(is_hot, known.hot_above[place], above)
        if len(model.hot.pairs):
            tables = np.where(is_pair, known.pair_tables[pair], tables)
        parent = known.parent(people, above, model.uniform)
        share = strength + discount * known.tables[d.context]
        p += (customers - discount * tables + share * parent[d.word]) / (strength + model.customers[d.context])
    return p / len(model.samples), seen


def _unpack(blobs: Iterator) -> tuple[Dealt, list, np.ndarray, np.ndarray] | None:
    """The dealt share in a fixed order, with its blobs, and each occurrence's row among all blobs' documents and its count."""
    found = sorted((v for _, v in blobs), key=lambda v: v[:2])
    if not found:
        return None
    base = np.cumsum([0, *(len(v[2]) for v in found)])
    row = np.concatenate([np.frombuffer(v[4], np.int32) + b for v, b in zip(found, base, strict=False)])
    learn = np.concatenate([v[3] for v in found])
    word, context, count = (np.concatenate([np.frombuffer(v[k], t) for v in found]) for k, t in ((5, np.uint64), (6, np.uint32), (7, np.int32)))
    return Dealt.of(word, context, count, learn[row]), [v[:3] for v in found], row, count


def score(seed: int, blobs: Iterator, model: Model) -> Iterator[tuple[int, tuple]]:
    """(source, (numbers of documents, their tokens, known tokens, base scores, scores)), summed over this task's tokens."""
    if not (found := _unpack(blobs)):
        return
    d, blobs, row, count = found
    p, seen = probabilities(d, model, seed)
    logs = np.log10(p)
    base = np.log10((seen + 1) / (model.n_tokens + model.n_known + 1))
    word = d.word[d.kind]
    n_docs = sum(len(v[2]) for v in blobs)
    cols = [np.bincount(row, weights=count * x, minlength=n_docs) for x in (1, seen[word] > 0, base[word], logs[d.kind])]
    at = 0
    for source, done, docs in blobs:
        part = slice(at, at + len(docs))
        at += len(docs)
        yield source, (docs + done, cols[0][part].astype(np.int32), cols[1][part].astype(np.int32), cols[2][part], cols[3][part])


def gather(blobs: Iterator, train_tokens: int) -> Iterator[tuple]:
    """(source, number, n_tokens, n_known, train_tokens, base_score, score) of each document."""
    by_source: dict[int, list] = {}
    for source, v in blobs:
        by_source.setdefault(source, []).append(v)
    for source, parts in by_source.items():
        at = np.concatenate([v[0] for v in parts])
        cols = [np.bincount(at, weights=np.concatenate([v[k] for v in parts])) for k in range(1, 5)]
        for i in np.flatnonzero(cols[0]).tolist():
            yield source, i, int(cols[0][i]), int(cols[1][i]), train_tokens, float(cols[2][i]), float(cols[3][i])


def hot_keys(docs: DataFrame, key: str, text: str, parts: int, most: int = HOT_SAMPLE) -> Hot:
    """Words, and pairs with the word before, that hold so many of the tokens of a sample (drawn by a hash of the rows) that
    they would fill a good part of a task; a hint for dealing, not part of the model. HOT_SHARES bounds their number."""
    n = docs.count()
    rows = docs.filter(F.pmod(F.xxhash64(key, text), F.lit(1 << 20)) < int(min(1.0, most / max(1, n)) * (1 << 20)))
    ws, end = words(ascii_lower(F.col(text))), F.array(F.lit(""))
    each = rows.select(F.explode(F.arrays_zip(F.concat(ws, end).alias("x"), F.concat(end, ws).alias("u"))).alias("e")).select("e.x", "e.u")
    share = min(HOT_SHARES[1], max(HOT_SHARES[0], 1 / (4 * parts)))
    counts = materialize(each.groupBy("x", "u").agg(F.count("*").alias("n")), "pairs")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    numbered = lambda x: number(x) if x else _END
    common = [r["x"] for r in counts.groupBy("x").agg(F.sum("n").alias("n")).filter(F.col("n") > share * total).collect()]
    pairs = counts.filter(F.col("n") > share * total).collect()
    return Hot.of(map(numbered, common), [(numbered(r["x"]), numbered(r["u"])) for r in pairs])


SCHEMA = T.StructType(
    [T.StructField("_source", T.IntegerType()), T.StructField("_number", T.IntegerType())]
    + [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
    + [T.StructField(n, T.DoubleType()) for n in ("base_score", "score")]
)


def _all(found: RDD) -> Sums:
    """Sums over all tasks, added up on the executors in blocks; the driver gets the total once."""

    def cut(sums: Sums) -> Iterator[tuple[tuple[str, int], np.ndarray]]:
        for k, v in sums.items():
            short = v.astype(np.int32) if v.max(initial=0) < 1 << 31 else v  # half as much to move
            yield from (((k, s), short[s : s + BLOCK]) for s in range(0, max(1, len(v)), BLOCK))

    blocks: dict[str, dict[int, np.ndarray]] = {}
    for (k, s), v in found.flatMap(cut).reduceByKey(lambda a, b: np.add(a, b, dtype=np.int64), min(16, found.getNumPartitions())).collect():
        blocks.setdefault(k, {})[s] = v
    return {k: np.concatenate([v[s] for s in sorted(v)]).astype(np.int64) for k, v in blocks.items()}


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", per_task: int = PER_TASK) -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(key, text)
    # Bytes over six are about the tokens. Only the corpus decides on the number of parts.
    size = rows.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]
    parts = size // 6 // per_task + 1
    hot = hot_keys(rows, key, text, parts)
    source = rows.sortWithinPartitions(key, F.xxhash64(text)).rdd
    dealt = source.mapPartitionsWithIndex(lambda i, r: pack(i, r, parts, hot)).partitionBy(parts, lambda b: b)

    def over(task) -> RDD:  # noqa: ANN001
        """task(share, number of the part) for each part that has one."""
        return dealt.mapPartitionsWithIndex(lambda i, b: (task(f[0], i) for f in [_unpack(b)] if f))

    base = _all(over(lambda d, i: baseline(d, hot)))
    if not base:
        base = baseline(Dealt.of(*(np.zeros(0, t) for t in (np.uint64, np.uint32, np.int32, bool))), hot)
    model = Model.start(base, hot)
    for _ in SWEEPS:
        shared = sc.broadcast(model)
        model.advance(_all(over(lambda d, i, shared=shared: phase_sums(d, shared.value, i))) or base)
    shared = sc.broadcast(model)
    scored = dealt.mapPartitionsWithIndex(lambda i, b: score(i, b, shared.value))
    n_sources = max(1, source.getNumPartitions())
    train_tokens = model.n_tokens
    totals = scored.partitionBy(n_sources, lambda s: s).mapPartitions(lambda b: gather(b, train_tokens))
    keys = source.mapPartitionsWithIndex(lambda i, r: ((i, n, k, not learnt(k)) for n, (k, _) in enumerate(r)))
    kinds = T.StructType([*SCHEMA.fields[:2], T.StructField("_key", docs.schema[key].dataType), T.StructField("held_out", T.BooleanType())])
    named = spark.createDataFrame(keys, kinds)
    return spark.createDataFrame(totals, SCHEMA).join(named, ["_source", "_number"]).select(
        F.col("_key").alias(key), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
