"""Host-level quality rules.

Document rules give each text its measures and failures; failures are summed by host, each host's failure rates are
shrunk with a beta prior fitted to all hosts (method of moments), and the host's verdict is joined back to its
documents. Everything is DataFrame expressions.

Defined results: a null text has no words and fails the length rule. Rows with a null host have no host verdict: they
are judged by their own rules. Repeated rows count as often as they occur. An empty table gives an empty result. Other
columns of the input, whatever their names, are left out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import materialize, words

WINDOW = 8
RULES = ("short", "repeated", "symbols", "dup_lines")


def window_keys(hashes: Column, window: int = WINDOW) -> Column:
    """A 64-bit key for each window of so many word hashes, in text order; none if there are fewer.

    hashes is a column, not an expression: an expression would be worked out again for every window.
    """
    n = F.size(hashes)
    keys = F.transform(F.sequence(F.lit(1), n - window + 1), lambda i: F.xxhash64(F.slice(hashes, i, window)))
    return F.when(n >= window, keys).otherwise(F.array().cast("array<bigint>"))


def twin_starts(ordered: Column, last: Column) -> Column:
    """Starts, in order, of the windows whose key has an equal neighbour; ordered: structs (k, i) sorted."""

    def twin(x: Column, j: Column) -> Column:
        before = F.when(j > 0, F.get(ordered, j - 1)["k"])
        after = F.when(j < last, F.get(ordered, j + 1)["k"])
        return F.coalesce(before == x["k"], F.lit(False)) | F.coalesce(after == x["k"], F.lit(False))

    return F.array_sort(F.transform(F.filter(ordered, twin), lambda x: x["i"]))


def measure(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to docs."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.withColumn("_ws", words(F.col(text))).withColumn("_wh", F.transform("_ws", lambda w: F.xxhash64(w)))
    df = df.withColumn("_keys", window_keys(F.col("_wh"), window))
    df = df.withColumns(
        {
            "n_words": F.size("_ws").cast("long"),
            "word_chars": F.char_length(F.array_join("_ws", "")).cast("long"),
            "n_symbols": F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "_twins": F.size("_keys") > F.size(F.array_distinct("_keys")),
        }
    )
    # Only texts with a repeated key pay for the sort: windows by key, those with an equal neighbour back in text order.
    ordered = F.array_sort(F.transform("_keys", lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    df = df.withColumn("_ordered", F.when(F.col("_twins"), ordered))
    df = df.withColumn("_at", F.when(F.col("_twins"), twin_starts(F.col("_ordered"), F.size("_keys") - 1)))
    # The union of the repeated windows: each adds the words up to the next one's start, a whole window at most.
    gaps = F.transform(F.col("_at"), lambda x, j: F.least(F.lit(window), F.coalesce(F.get(F.col("_at"), j + 1) - x, F.lit(window))))
    df = df.withColumn("n_repeat_words", F.coalesce(F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g), F.lit(0).cast("long")))
    return df.drop("_ws", "_wh", "_keys", "_twins", "_ordered", "_at")


def failures(min_words: int = 20, max_repeat_pct: int = 30, max_symbol_pct: int = 10, min_dup_lines: int = 3) -> dict[str, Column]:
    """The document rules, as conditions over the measures. Integer arithmetic, so no rounding decides."""
    n = F.col("n_words")
    return {
        "short": n < min_words,
        "repeated": 100 * F.col("n_repeat_words") > max_repeat_pct * n,
        "symbols": 100 * F.col("n_symbols") > max_symbol_pct * F.col("word_chars"),
        "dup_lines": F.col("n_dup_lines") > F.greatest(F.lit(min_dup_lines), n / 20),
    }


def host_rates(measured: DataFrame, host: str, rules: dict[str, Column]) -> DataFrame:
    """Per host: documents, and for each rule the failures and the rate shrunk with the fitted beta prior.

    The prior's mean m and variance v are those of the hosts' raw rates, weighted by documents;
    its strength s = m(1-m)/v - 1 is held within 1 and 1000 pseudo-documents, so a host with few documents is moved
    to the mean and one with many keeps its own rate.
    """
    per = measured.filter(F.col(host).isNotNull()).groupBy(host).agg(
        F.count("*").alias("n_docs"), *[F.count_if(c).alias(f"f_{k}") for k, c in rules.items()]
    )
    n = F.col("n_docs")
    moments = []
    for k in rules:
        rate = F.col(f"f_{k}") / n
        moments += [(F.sum(n * rate) / F.sum(n)).alias(f"m_{k}"), (F.sum(n * rate * rate) / F.sum(n)).alias(f"q_{k}")]
    prior = per.agg(*moments)  # one row
    rated = per.crossJoin(F.broadcast(prior))
    for k in rules:
        m = F.col(f"m_{k}")
        var = F.col(f"q_{k}") - m * m
        s = F.when(var > 1e-12, F.least(F.lit(1000.0), F.greatest(F.lit(1.0), m * (1 - m) / var - 1))).otherwise(F.lit(1000.0))
        rated = rated.withColumn(f"r_{k}", (F.col(f"f_{k}") + m * s) / (n + s))
    return rated.select(host, "n_docs", *[f"f_{k}" for k in rules], *[f"r_{k}" for k in rules])


def host_quality(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """One row per document: its measures, base_failed, the host's verdict and kept.

    A host is rejected if any rule's shrunken failure rate is above max_rate. Measures are written once, as both the
    host sums and the join read them. A host with a large share of the rows is summed map-side first. The join looks up the
    rejected hosts alone, written, so that their size is known: Spark broadcasts them while they are below its threshold,
    and no document moves; beyond it digest columns are shuffled, never texts, and adaptive execution splits a hot host.
    """
    rules = failures()
    base = docs.select(F.col(key).alias("_key"), F.col(host).alias("_host"), F.col(text).alias("_text"))
    m = measure(base, "_text").drop("_text")
    m = materialize(m, "quality")
    rates = host_rates(m, "_host", rules)
    bad = rates.filter(F.greatest(*[F.col(f"r_{k}") for k in rules]) > max_rate).select(F.col("_host").alias("_bad"))
    bad = materialize(bad, "rejected")
    out = m.join(bad, F.col("_host") == F.col("_bad"), "left")
    failed = rules["short"] | rules["repeated"]
    out = out.withColumn("base_failed", failed).withColumn("host_rejected", F.col("_bad").isNotNull())
    return out.select(
        F.col("_key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"), "host_rejected",
    )
