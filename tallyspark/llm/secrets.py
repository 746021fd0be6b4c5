"""Secret scans through an incremental blob ledger.

A text is content-addressed by its SHA-256. The ledger holds one row per (blob, rule version) that was ever scanned,
with the spans found. A run scans only pairs the ledger lacks, each distinct blob once however many paths carry it,
and joins the findings back to every path. Everything is DataFrame expressions.

Defined results: a null text is the empty blob. Repeated rows and copies share one scan. An empty table adds nothing to
the ledger. Columns beside the key and the text are neither read nor returned by a scan; redaction keeps all columns,
whatever their names, and null texts. Work grows with a text's length and the number of its matches (times a logarithm).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import hidden, materialize

SPANS = "array<struct<start:int,rank:int,end:int>>"
BLOCK = 2048  # characters
BROADCAST_BYTES = 16 << 20
ROW_BYTES = 16


@dataclass(frozen=True)
class Rule:
    """pattern is matched leftmost, non-overlapping; a match counts if its group keep_group has min_chars or more."""

    kind: str
    version: int
    pattern: str
    keep_group: int = 0
    min_chars: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}.{self.version}"


def _either_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))

# Base kinds first, in the order of the contract; then what the method adds. For access and hex the minimum is in the
# pattern: a maximal run that is too short holds no other match, so the spans are those of the plain pattern, filtered.
RULES = (
    Rule("assign", 1, rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", 2, r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
# The rules before the last change: fewer kinds of forge tokens.
FORMER_RULES = (*RULES[:-1], Rule("forge", 1, r"ghp_[A-Za-z0-9]{36,}"))


def running(values: Column, merge: Callable[[Column, Column], Column], kind: str) -> Column:
    """The array with each element merged with all before it; in log2(n) steps of one pass each, as Spark has no such function
    and an array that is built up element by element is copied every time. merge(x, y): x after y; y is null at the start."""

    def step(acc: Column, shift: Column) -> Column:
        before = F.concat(F.array_repeat(F.lit(None).cast(kind), shift), F.slice(acc, 1, F.size(acc) - shift))
        return F.when(shift < F.size(acc), F.zip_with(acc, before, merge)).otherwise(acc)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(31)]), values, step)


def scan(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule, in code points, end exclusive.

    Spark gives no match positions, so a match ends after all pieces between matches and all matches up to it.
    """
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.keep_group))
    gaps = F.split(text, rule.pattern)
    # One more gap than hits; the last entry has no hit and gives no span.
    zipped = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), kept.alias("kept"))
    kind = "struct<end:int,size:int,ok:boolean>"
    steps = F.transform(
        zipped,
        lambda s: F.struct(
            (F.char_length(s["gap"]) + F.coalesce(F.char_length(s["hit"]), F.lit(0))).alias("end"), F.char_length(s["hit"]).alias("size"),
            (F.char_length(s["kept"]) >= rule.min_chars).alias("ok"),
        ).cast(kind),
    )
    ends = running(steps, lambda x, y: F.struct((x["end"] + F.coalesce(y["end"], F.lit(0))).alias("end"), x["size"].alias("size"), x["ok"].alias("ok")).cast(kind), kind)
    spans = F.transform(F.filter(ends, lambda x: F.coalesce(x["ok"], F.lit(False))), lambda x: F.struct((x["end"] - x["size"]).alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end")))
    return F.when(text.rlike(rule.pattern), spans.cast(SPANS)).otherwise(F.array().cast(SPANS))


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def unseen(rows: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """(at, todo) for one row of each distinct blob of rows (blob, at) that lacks rules in the ledger: bit i of todo stands for rule i."""
    whole = (1 << len(rules)) - 1
    one = rows.groupBy("blob").agg(F.min("at").alias("at"))
    if ledger is None:
        return one.select("at", F.lit(whole).alias("todo"))
    bit = F.coalesce(*[F.when(F.col("rule_id") == r.id, 1 << i) for i, r in enumerate(rules)], F.lit(0))
    seen = ledger.groupBy(F.col("blob").alias("_of")).agg(F.bit_or(bit).alias("_seen"))
    todo = F.lit(whole).bitwiseAND(F.bitwise_not(F.coalesce("_seen", F.lit(0))))
    return one.join(seen, F.col("blob") == F.col("_of"), "left").select("at", todo.alias("todo")).filter("todo <> 0")


def scan_rows(rows: DataFrame, todo: Column, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, found) of rows (blob, text): the spans of each rule whose bit is set in todo."""
    each = [F.when(todo.bitwiseAND(1 << i) != 0, F.struct(F.lit(r.id).alias("rule_id"), scan(F.col("text"), r, i).alias("spans"))) for i, r in enumerate(rules)]
    return rows.select("blob", F.filter(F.array(*each), lambda x: x.isNotNull()).alias("found"))


def scan_unseen(rows: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, limit: int = BROADCAST_BYTES) -> DataFrame:
    """New ledger rows (blob, rule_id, spans) for the pairs that the ledger lacks; rows: blob, text and, if a blob has several
    rows, at, a hash that tells them apart.

    No text moves: hashes are grouped to choose one row of each unseen blob, and the rows chosen are broadcast to the texts while
    they take no more than limit bytes. Beyond it every text is scanned where it lies for the rules that some blob lacks, copies
    and seen ones too, as that costs less than moving all texts to their blobs; only unseen pairs are returned.
    """
    rows = rows if "at" in rows.columns else rows.withColumn("at", F.xxhash64("blob"))
    chosen = materialize(unseen(rows.select("blob", "at"), ledger, rules), "unseen")
    n, lacking = chosen.agg(F.count("*"), F.coalesce(F.bit_or("todo"), F.lit(0))).first()
    if n * ROW_BYTES <= limit:
        part = rows.withColumnRenamed("at", "_at").join(F.broadcast(chosen), F.col("_at") == F.col("at"))
        found = scan_rows(part, F.col("todo"), rules)
    else:
        found = scan_rows(rows, F.lit(lacking), rules)
    # Rows that are repeated have equal findings.
    found = found.groupBy("blob").agg(F.any_value("found").alias("found")).select("blob", F.explode("found").alias("_f")).select("blob", "_f.rule_id", "_f.spans")
    if ledger is not None and n * ROW_BYTES > limit:
        found = found.join(ledger.select("blob", "rule_id"), ["blob", "rule_id"], "left_anti")
    return found


def _ledger(texts: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...], limit: int = BROADCAST_BYTES) -> DataFrame:
    """The ledger with what texts (_key, text; text not null) add to it. New rows are written, so a lost executor costs no second scan."""
    rows = texts.withColumn("blob", blob_of(F.col("text"))).select("blob", "text", F.xxhash64("blob", "_key").alias("at"))
    new = materialize(scan_unseen(rows, ledger, rules, limit), "ledger")
    return new if ledger is None else ledger.select("blob", "rule_id", "spans").unionByName(new)


def blob_spans(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, spans) of the blobs with findings of the rules, spans sorted by start and rule."""
    current = ledger.filter(F.col("rule_id").isin([r.id for r in rules]) & (F.size("spans") > 0))
    return current.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def ledger_scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES
) -> tuple[DataFrame, DataFrame]:
    """(paths, ledger): paths has key, blob and spans (all rules, sorted); ledger has the old and the new rows.

    The join back moves hashes and spans only; a blob with very many paths is one small row on the other side, and
    adaptive execution splits its paths.
    """
    paths = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole = _ledger(paths, ledger, rules)
    found = paths.select("_key", blob_of(F.col("text")).alias("blob")).join(blob_spans(whole, rules), "blob", "left")
    found = found.select(F.col("_key").alias(key), "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))
    return found, whole


def span_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")


def secret_digest(found: DataFrame, key: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts by base kind, the hash of the base spans and all spans as text."""

    def of(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    base = F.filter("spans", lambda s: s["rank"] < 3)
    return found.select(
        key, of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(span_text(base, rules).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans"), rules).alias("spans"),
    )


def _piece(blocks: Column, start: Column, end: Column) -> Column:
    """Characters start to end of a text in blocks; a block is looked up by its place, so a piece costs no more than its size and two blocks."""
    i, j = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
    block = lambda k: F.coalesce(F.get(blocks, k), F.lit(""))
    across = F.concat(
        F.substring(block(i), start % BLOCK + 1, F.lit(BLOCK)), F.array_join(F.slice(blocks, i + 2, F.greatest(F.lit(0), j - i - 1)), ""), F.substring(block(j), F.lit(1), end % BLOCK)
    )
    return F.when(i == j, F.substring(block(i), start % BLOCK + 1, end - start)).otherwise(across)


def redact(docs: DataFrame, text: str, spans: str, mark: str = "<secret>") -> DataFrame:
    """docs with each maximal run of span characters in text replaced by the mark; spans: a column, sorted by start."""
    blocks, before = hidden(docs, "_blocks", "_before")
    some = F.size(spans) > 0
    out = docs.withColumn(blocks, F.when(some, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))
    kind = "struct<start:int,end:int>"
    reach = F.transform(F.col(spans), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")).cast(kind))
    # Each span with how far the spans up to it reach, then with how far those before it reach: a gap is left where it starts beyond.
    reach = running(reach, lambda x, y: F.struct(x["start"].alias("start"), F.greatest(x["end"], y["end"]).alias("end")).cast(kind), kind)
    out = out.withColumn(before, F.when(some, reach))
    last = F.get(F.col(before), F.size(before) - 1)["end"]
    earlier = F.concat(F.array(F.lit(None).cast(kind)), F.slice(F.col(before), 1, F.size(before) - 1))

    def part(x: Column, y: Column) -> Column:
        at = F.coalesce(y["end"], F.lit(0))
        return F.when(x["start"] >= at, F.concat(_piece(F.col(blocks), at, x["start"]), F.when(y.isNull() | (x["start"] > at), F.lit(mark)).otherwise("")))

    pieces = F.array_join(F.zip_with(F.col(before), earlier, part), "")
    cut = F.concat(pieces, _piece(F.col(blocks), last, F.char_length(text)))
    return out.withColumn(text, F.when(some, cut).otherwise(F.col(text))).select(*docs.columns)


def redact_documents(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """docs with secrets masked; every row and column stays. Findings come from the ledger, by blob; they are written and
    measured, and broadcast, so that no text moves, while they take no more than limit bytes. Beyond it texts that no rule
    matches stay where they are, and only the others go to their findings."""
    plain = [c for c, kind in docs.dtypes if c != text and not re.search("map|array|struct|variant", kind)]  # what can be hashed tells copies apart
    whole = _ledger(docs.select(F.xxhash64(F.lit(0), *plain).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text")), ledger, rules, limit)
    blob, of, spans = hidden(docs, "_blob", "_of", "_spans")
    found = materialize(blob_spans(whole, rules).toDF(of, spans), "findings")
    size = found.agg(F.sum(F.size(spans) * 12 + 64).alias("n")).first()["n"] or 0

    def masked(part: DataFrame, found: DataFrame) -> DataFrame:
        joined = part.withColumn(blob, blob_of(F.col(text))).join(found, F.col(blob) == F.col(of), "left")
        return redact(joined.withColumn(spans, F.coalesce(spans, F.array().cast(SPANS))), text, spans).select(*docs.columns)

    if size <= limit:
        return masked(docs, F.broadcast(found))
    hit = F.coalesce(reduce(Column.__or__, [F.col(text).rlike(r.pattern) for r in rules]), F.lit(False))
    return docs.filter(~hit).unionByName(masked(docs.filter(hit), found))


def changed_history(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """What ledger_scan gives for docs whose history is in two commits: about half of the paths were there at the first one
    and scanned under the rules of then; all paths are there now, under the rules of now. Every path is in the result."""
    there = docs.filter(F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(0)) % 2 == 0)
    _, ledger = ledger_scan(there, key, text, rules=FORMER_RULES)
    return ledger_scan(docs, key, text, ledger)
