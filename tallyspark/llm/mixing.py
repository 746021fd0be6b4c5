"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells of (source, language, topic). Topics come from the corpus: of words that are in a share of the
documents within SHARES, the ANCHORS most common ones are anchors, and a document's topic is the rarest of its anchors. With 24 of
them no topic has more than a fifth of the documents at sf0.01. The cells' token weights are raked to one target marginal
after another until each is within TOLERANCE of its target share. A document is kept
with a probability in proportion to its cell's weight per token, calibrated so that the expected tokens are the asked
share of the input. Everything is DataFrame expressions; only sums by cell and by level are shuffled, never texts, and a
hot source is summed map-side first.

Defined results: a null source or language is a level of its own; a null text has no tokens, the topic "empty" and the
probability of its cell, 0 if the cell has no tokens. Repeated rows are kept or dropped together. Levels without a
target keep weight 0; targets without a level are ignored and the rest is scaled to 1. Targets that cannot be met together
are raked as near as it goes, and the residual is reported. A column named weight is replaced; all others are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import SPACES, hidden, materialize, rewrite

DIMS = ("source", "lang", "topic")
TOLERANCE = 1e-6
ALPHA = 0.5
ANCHORS = 24
SHARES = (0.01, 0.25)
BUCKETS = 1 << 16
CANDIDATES = 512


def _spaced(text: Column) -> Column:
    """The text with spaces for all white space, and one at each end: its words stand between spaces."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES.strip(" "):
        out = F.replace(out, F.lit(c), F.lit(" "))
    return F.concat(F.lit(" "), out, F.lit(" "))


def anchors(
    docs: DataFrame, text: str = "text", most: int = ANCHORS, shares: tuple[float, float] = SHARES, candidates: int = CANDIDATES
) -> list[tuple[str, int]]:
    """The topics' anchor words, each with the number of documents that hold it, from the rarest on: the most common words that
    are in at least the first and at most the second share of all documents, so words that stand everywhere anchor nothing.

    Two passes over all documents. The first counts occurrences by hash in BUCKETS buckets, summed up map-side; a word in that many
    documents fills its bucket, so the words of the fullest buckets are candidates. The second counts the documents of these.
    """
    ws = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]")
    bucket = lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int")
    n = docs.count()
    filled = docs.select(F.explode(F.transform(ws, bucket)).alias("b")).groupBy("b").agg(F.count("*").alias("n"))
    full = [r["b"] for r in filled.filter(F.col("n") >= shares[0] * n).orderBy(F.desc("n"), "b").limit(candidates).collect()]
    if not full:
        return []
    each = docs.select(F.explode(F.array_distinct(F.filter(ws, lambda w: (w != "") & bucket(w).isin(full)))).alias("word"))
    found = each.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n").between(max(2, shares[0] * n), shares[1] * n))
    top = found.orderBy(F.desc("n"), "word").limit(most).collect()
    return [(r["word"], r["n"]) for r in reversed(top)]


def anchored(text: Column, found: list[tuple[str, int]]) -> Column:
    """The rarest anchor that is a word of the text; "empty" for a text without words, "other" for one without an anchor."""

    def topic(spaced: Column) -> Column:
        out = F.when(F.btrim(spaced) == "", "empty")
        for word, _ in found:
            out = out.when(F.contains(spaced, F.lit(f" {word} ")), word)
        return out.otherwise("other")

    # The text is spaced once, as the element that all branches look at.
    return F.get(F.transform(F.array(_spaced(text)), topic), F.lit(0))


def with_cells(
    docs: DataFrame, text: str = "text", source: Column | str = "source", lang: Column | str = "lang", topic: Column | None = None
) -> tuple[DataFrame, str, str]:
    """docs with two more columns, and their names: the cell, a struct of the three levels, and the number of words.

    Levels are columns, by name or given; without a topic, documents have that of their anchor word, see anchors.
    """
    cell, tokens = hidden(docs, "_cell", "_tokens")
    level = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    levels = F.struct(level(source).alias("source"), level(lang).alias("lang"), level(anchored(F.col(text), anchors(docs, text)) if topic is None else topic).alias("topic"))
    n = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.withColumns({cell: levels, tokens: n}), cell, tokens


def smoothed_targets(cells: DataFrame, alpha: float = ALPHA) -> dict[str, DataFrame]:
    """Per dimension (level, share): each level's tokens to the power alpha; 1 keeps the input's shares, 0 levels them."""
    return {d: cells.groupBy(d).agg(F.pow(F.sum("tokens"), F.lit(alpha)).alias("share")) for d in DIMS}


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[f"_{n}"]) for n in names])


def _renamed(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumnsRenamed({n: f"_{n}" for n in names})


def _exact_sum(value: Column, of: Column | float, kind: str = "decimal(38,37)") -> Column:
    """The sum of values as shares of a number, which together stay below 10; the same double in whatever order rows are added,
    as the shares are added up as decimals."""
    return F.sum((value / (of if isinstance(of, Column) else F.lit(of))).cast(kind)).cast("double")


def _with_shares(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """cells with weight, their tokens, and the target share of each level, 0 where there is none; shares of levels with
    tokens add up to one. Levels are written, so that each plan is one of few joins."""
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for d in DIMS:
        wanted = _renamed(targets[d].select(d, F.col("share").cast("double").alias("share")), d)
        levels = cells.filter("tokens > 0").select(d).distinct()
        found = materialize(levels.join(wanted, _same(levels, wanted, d)).select(d, "share"), "levels")
        most = found.agg(F.max("share").alias("most")).first()["most"]  # a share may be as large as any other
        found = found.select(d, F.try_divide("share", F.lit(most).cast("double")).alias("share"))
        total = found.agg(_exact_sum(F.col("share"), 1.0, "decimal(28,20)").alias("all")).first()["all"]
        shares = _renamed(found.select(d, (F.col("share") / F.lit(total).cast("double")).alias(f"share_{d}")), d)
        out = out.join(shares, _same(out, shares, d), "left").drop(f"_{d}").withColumn(f"share_{d}", F.coalesce(f"share_{d}", F.lit(0.0)))
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE) -> tuple[DataFrame, float]:
    """cells (levels, tokens) with weight, the tokens scaled so that every marginal has its target share; and the residual.

    A round scales the cells to one dimension after another, by sums that are added up map-side, so that no level's cells are
    gathered. Each of these steps is written in place of the one before: its plan is one sum and one join, whatever the rounds,
    as sums of a step that is not written hold the whole plan of that step once more. The rounds end when no marginal was further than the
    tolerance from its share, or when a round brings them no nearer, as with targets that the cells cannot meet together;
    the residual, the largest distance seen in the last round, tells the two apart.
    """
    total = cells.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    now = materialize(_with_shares(cells, targets).withColumn("away", F.lit(0.0)), "rake")
    residual, last = 0.0, float("inf")
    while total:
        for i, d in enumerate(DIMS):
            sums = _renamed(now.groupBy(d).agg((_exact_sum(F.col("weight"), float(total)) * F.lit(float(total))).alias("_sum")), d)
            scale = F.when(F.col("_sum") > 0, F.col(f"share_{d}") * F.lit(float(total)) / F.col("_sum")).otherwise(0.0)
            away = F.abs(F.col("_sum") / F.lit(float(total)) - F.col(f"share_{d}"))
            step = now.join(sums, _same(now, sums, d)).withColumns({"weight": F.col("weight") * scale, "away": F.greatest("away", away) if i else away})
            now = rewrite(step.select(*now.columns), now, "rake")
        residual = now.agg(F.max("away").alias("m")).first()["m"]
        if residual <= tolerance or residual > 0.99 * last:
            break
        last = residual
    return now.drop("away", *[f"share_{d}" for d in DIMS]), residual


def keep_probabilities(raked: DataFrame, share: float) -> DataFrame:
    """raked with keep_prob: proportional to weight per token, at most 1, with the asked share of tokens expected.

    Cells at 1 give their surplus to the rest, so the scale is worked out again until no further cell reaches 1.
    """
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    total = raked.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    scale, full = 0.0, -1
    while total:
        capped = F.col("tokens") > 0 if scale == float("inf") else ratio * F.lit(scale) >= 1
        s = raked.agg(
            F.coalesce(F.sum(F.when(capped, F.col("tokens"))), F.lit(0)).alias("full"),
            F.coalesce(_exact_sum(F.when(~capped, F.col("weight")), float(total)) * F.lit(float(total)), F.lit(0.0)).alias("rest"),
        ).first()
        if s["full"] == full or not s["rest"]:
            break
        full, scale = s["full"], max(scale, (share * total - s["full"]) / s["rest"])
    return raked.withColumn("keep_prob", F.least(F.lit(1.0), ratio * F.lit(scale)))


def draw(*keys: Column, seed: int = 42) -> Column:
    """A number in [0, 1) fixed by the keys."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 53)) / F.lit(float(1 << 53))


def calibrated_cells(docs: DataFrame, cell: str, tokens: str, share: float, targets: dict[str, DataFrame] | None = None) -> tuple[DataFrame, float]:
    """(levels, weight per token, keep_prob) of the cells of docs; and the residual of the raking."""
    cells = materialize(docs.groupBy(cell).agg(F.sum(tokens).alias("tokens")).select(f"{cell}.*", "tokens"), "cells")
    raked, residual = rake(cells, targets or smoothed_targets(cells))
    chosen = keep_probabilities(raked, share)
    factor = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    return materialize(chosen.select(*DIMS, factor.alias("weight"), "keep_prob"), "chosen"), residual


def _chosen(docs: DataFrame, cell: str, chosen: DataFrame) -> tuple[DataFrame, str, str]:
    """docs with their cell's weight and keep_prob, and these columns' names; few cells are broadcast, many joined by their levels."""
    at, weight, prob = hidden(docs, "_at", "_weight", "_keep_prob")
    c = chosen.select(F.struct(*DIMS).alias(at), F.col("weight").alias(weight), F.col("keep_prob").alias(prob))
    return docs.join(c, docs[cell].eqNullSafe(c[at])), weight, prob


def mixture(
    docs: DataFrame, key: str = "doc_id", text: str = "text", share: float = 0.5, targets: dict[str, DataFrame] | None = None, seed: int = 42, **levels: Column
) -> DataFrame:
    """One row per document: key, source, lang, topic, n_tokens, weight, keep_prob, kept, and residual, how far the raked
    marginals are at most from their targets (one number, on every row)."""
    celled, cell, tokens = with_cells(docs, text, **levels)
    digest = celled.select(F.col(key).alias("_key"), F.col(cell).alias("_cell"), F.col(tokens).alias("_tokens"), draw(F.col(key), F.col(text), seed=seed).alias("_draw"))
    digest = materialize(digest, "digest")
    chosen, residual = calibrated_cells(digest, "_cell", "_tokens", share, targets)
    out, weight, prob = _chosen(digest, "_cell", chosen)
    return out.select(
        F.col("_key").alias(key), *[F.col(f"_cell.{d}").alias(d) for d in DIMS], F.col("_tokens").alias("n_tokens"), F.col(weight).alias("weight"),
        F.col(prob).alias("keep_prob"), (F.col("_draw") < F.col(prob)).alias("kept"), F.lit(residual).alias("residual"),
    )


def sample_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", share: float = 0.5, targets: dict[str, DataFrame] | None = None, seed: int = 42,
    max_residual: float | None = None, **levels: Column,
) -> DataFrame:
    """The documents drawn, with all their columns and weight, the cell's weight per token.

    Marginals further than max_residual from their targets are an error; None accepts the nearest that raking finds.
    """
    names = [c for c in docs.columns if c.lower() != "weight"]
    celled, cell, tokens = with_cells(docs.select(*names), text, **levels)
    chosen, residual = calibrated_cells(celled.select(cell, tokens), cell, tokens, share, targets)
    if max_residual is not None and residual > max_residual:
        raise ValueError(f"the targets cannot be met together: a marginal is {residual:.3g} from its share")
    out, weight, prob = _chosen(celled, cell, chosen)
    drawn = draw(F.col(key), F.col(text), seed=seed)
    return out.filter(drawn < F.col(prob)).select(*names, F.col(weight).alias("weight"))
