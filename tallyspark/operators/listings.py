"""Classifying listings and counting their units, as narrow column expressions: no shuffle, no Python."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.rules import DEFAULT, LEVELS, Pattern, Rules

TEXT = ("title", "bullets", "size", "description")
SOURCES = {
    "title": "cand_title", "bullets": "cand_bullets", "size": "cand_size", "description": "cand_description", "number_of_items": "cand_number_of_items",
    "keepa_number_of_items": "cand_keepa_number_of_items", "keepa_package_quantity": "cand_keepa_package_qty", "label_unit_num": "cand_label_unit_num", "unit_num": "cand_unit_num",
}
HIT = "struct<prio:int,neg:bigint,seq:int,n:bigint,tag:string>"
FLAGS = "(?iuU)"


def positive_int(value: Column) -> Column:
    """A number as text, cut to an integer; null unless it is positive."""
    text = F.btrim(value.cast("string"))
    number = F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,2})?$"), text.try_cast("double"))
    whole = number.try_cast("bigint")
    return F.when((whole > 0) & (whole <= 2147483647), whole.cast("int"))


def match_text(rules: Rules = DEFAULT) -> Column:
    """The title (the catalogue's where it is missing), and outside strict mode the supporting texts."""
    title = F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("keepa_title"), F.lit(""))
    if rules.strict:
        return title
    more = [F.coalesce(F.col(c), F.lit("")) for c in ("feature", "product_description", "keepa_features", "keepa_description")]
    return F.concat_ws("\n", title, *more)


def purity(listings: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Adds is_pure_bath_bomb, exclude_reason and purity_source: an ordered ladder, the first rule that fires wins."""
    t = F.col("_match")
    has = lambda rx: t.rlike(FLAGS + rx)
    at = lambda rx: F.regexp_instr(t, F.lit(FLAGS + rx))
    before = lambda rx: (at(rx) > 0) & (at(rx) < at(rules.target))
    ladder = (
        (~has(rules.target), "no-bath-bomb", "rule_no_bomb"),
        (has(rules.kit), "craft_kit", "rule_craft_kit"),
        (has(rules.companion) | (has(rules.surprise) & has(rules.inside)), "bundle", "rule_bundle"),
        (before(rules.substitute), "substitute", "rule_substitute"),
        (before(rules.ingredient), "ingredients", "rule_ingredient"),
    )
    df = listings.withColumn("_match", match_text(rules))
    rule = reduce(lambda w, i: w.when(ladder[i][0], i), range(1, len(ladder)), F.when(ladder[0][0], 0)).otherwise(len(ladder))
    df = df.withColumn("_rule", rule).drop("_match")
    reasons = F.array(*[F.lit(r) for _, r, _ in ladder], F.lit(None).cast("string"))
    sources = F.array(*[F.lit(s) for _, _, s in ladder], F.lit("rule_positive"))
    return df.withColumns(
        {"is_pure_bath_bomb": F.col("_rule") == len(ladder), "exclude_reason": F.get(reasons, F.col("_rule")), "purity_source": F.get(sources, F.col("_rule"))}
    ).drop("_rule")


def lexicon_hits(listings: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Adds where the words of each class are first met in the match text, from 1; 0 where they are not."""
    text = match_text(rules)
    classes = {"target": rules.target, "kit": rules.kit, "companion": rules.companion, "substitute": rules.substitute, "ingredient": rules.ingredient}
    return listings.withColumns({f"{k}_at": F.regexp_instr(text, F.lit(FLAGS + rx)) for k, rx in classes.items()})


def _quoted(text: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(digits: str) -> str:
    """Digits to a number; anything over nine digits is a billion, so that it still wins its channel and is capped there."""
    short = f"regexp_replace({digits}, '^0+(?=.)', '')"
    return f"CASE WHEN length({short}) > 9 THEN 1000000000L ELSE try_cast({short} AS BIGINT) END"


def _map(values: dict) -> str:
    return f"map({', '.join(f'{_quoted(k)}, {v}' for k, v in values.items())})" if values else "map('', 0)"


def _hits(text: str, p: Pattern, seq: int, rules: Rules) -> str:
    """array<struct> of all matches of a pattern, ranked: counts over one first, by priority, larger first, order found.

    The text is searched once; the groups are read from the matches, which are few and short. Written as SQL text, as one
    call for each of some thousands of column objects takes longer than running the plan.
    """
    regex = _quoted(FLAGS + p.regex)
    group = lambda g: f"regexp_extract(x, {regex}, {g})"
    n = f"CAST(try_element_at({_map(rules.number_words)}, lower({group(p.n)})) AS BIGINT)" if p.word else _number(group(p.n))
    if p.by:
        n = f"({n}) * ({_number(group(p.by))})"
    tag = f"concat({_quoted(p.tag)}, lower({group(p.unit)}))" if p.unit else _quoted(p.tag)
    prio = str(rules.priority.get(p.tag, 9))
    if p.unit:
        prio = f"coalesce(try_element_at({_map({k: v for k, v in rules.priority.items() if k.startswith(p.tag)})}, h.tag), 9)"
    counts = "h.n > 1" if p.over_one else "h.n IS NOT NULL AND NOT (h.tag = 'near_pack' AND h.n = 1)" if p.unit else "h.n IS NOT NULL"
    found = f"transform(regexp_extract_all({text}, {regex}, 0), x -> named_struct('n', {n}, 'tag', {tag}))"
    ranked = (
        f"named_struct('prio', CAST({prio} + IF(h.n > 1, 0, 100) AS INT), 'neg', IF(h.n > 1, -h.n, 0L), 'seq', CAST(i + {seq * 100_000} AS INT), 'n', h.n, 'tag', h.tag)"
    )
    return f"filter(transform({found}, (h, i) -> {ranked}), h -> {counts})"


def channel_text(channel: str, rules: Rules = DEFAULT) -> Column:
    return F.concat_ws("\n", *[F.coalesce(F.col(c), F.lit("")) for c in rules.channels[channel]])


def _channel_hits(text: str, rules: Rules) -> str:
    every = ", ".join(_hits(text, p, i, rules) for i, p in enumerate(rules.patterns))
    words = f"|\\b(?:{'|'.join(rules.number_words)})\\b" if rules.number_words else ""
    return f"CASE WHEN {text} RLIKE {_quoted(rf'{FLAGS}\d{words}')} THEN concat({every}) ELSE CAST(array() AS array<{HIT}>) END"


def channel_hits(text: str, rules: Rules = DEFAULT) -> Column:
    """All hits of a text column; texts without a digit or number word are not searched."""
    return F.expr(_channel_hits(f"`{text}`", rules))


def count_candidates(listings: DataFrame, rules: Rules = DEFAULT, only_pure: bool = False) -> DataFrame:
    """Adds the cand_ columns: the best hit of each text channel, capped after it is picked, and five catalogue fields.

    The channels are one array, so that every pattern stands in the plan once. With only_pure it is empty for listings that are
    excluded, so their texts are not searched; they have no candidates then, and take no part in any count anyway.
    """
    pure = F.coalesce("is_pure_bath_bomb", F.lit(False)) if only_pure else F.lit(True)
    cap = lambda n: F.when(pure & n.between(1, rules.max_count), n.cast("int"))
    texts = F.array(*[channel_text(c, rules) for c in TEXT])
    df = listings.withColumn("_texts", F.when(pure, texts).otherwise(F.array().cast("array<string>")) if only_pure else texts)
    df = df.withColumn("_best", F.expr(f"transform(_texts, t -> array_min({_channel_hits('t', rules)}))"))
    hit = {c: F.get("_best", F.lit(i)) for i, c in enumerate(TEXT)}
    unit = F.lower(F.coalesce("unit_text", F.lit(""))).isin("count", "each", "unit", "units")
    label = F.lower(F.coalesce("label_unit", F.lit(""))).contains("count")
    columns = {}
    for c in ("title", "size", "bullets", "description"):
        columns[f"cand_{c}"] = cap(hit[c]["n"])
        columns[f"cand_{c}_pattern"] = F.when(columns[f"cand_{c}"].isNotNull(), hit[c]["tag"])
    return df.withColumns(
        columns
        | {
            "cand_number_of_items": cap(positive_int(F.col("number_of_items"))),
            "cand_keepa_number_of_items": cap(positive_int(F.col("keepa_number_of_items"))),
            "cand_keepa_package_qty": cap(positive_int(F.col("keepa_package_quantity"))),
            "cand_unit_num": F.when(unit, cap(positive_int(F.col("unit_num")))),
            "cand_label_unit_num": F.when(label, cap(positive_int(F.col("label_unit_num")))),
        }
    ).drop("_texts", "_best")


def votes(rules: Rules = DEFAULT) -> Column:
    """The counts that are reported, as an array in the fixed order of the sources."""
    level = lambda s: LEVELS.index(rules.confidence.get(s, "medium"))
    every = ", ".join(
        f"named_struct('source', '{s}', 'n', {c}, 'w', {rules.weights.get(s, 1)}, 'text', {s in TEXT}, 'ord', {i}, 'base', {level(s)})" for i, (s, c) in enumerate(SOURCES.items())
    )
    return F.expr(f"filter(array({every}), v -> v.n IS NOT NULL)")


def consensus(candidates: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Adds the resolved count with source, confidence and flags: a weighted vote in arrays of at most nine, no shuffle."""
    df = candidates.withColumn("_votes", votes(rules))
    df = df.withColumns({"_multi": F.filter("_votes", lambda v: v["n"] > 1), "_ones": F.transform(F.filter("_votes", lambda v: v["n"] == 1), lambda v: v["source"])})
    values = F.array_distinct(F.transform("_multi", lambda v: v["n"]))

    def tally(n: Column) -> Column:
        own = F.filter("_multi", lambda v: v["n"] == n)
        weight = F.aggregate(own, F.lit(0), lambda a, v: a + v["w"])
        return F.struct(weight.alias("w"), F.exists(own, lambda v: v["text"]).alias("text"), n.alias("n"))

    df = df.withColumn("_tally", F.transform(values, tally)).withColumn("_win", F.array_max("_tally"))
    backers = F.filter("_multi", lambda v: v["n"] == F.col("_win.n"))
    df = df.withColumn("_back", F.array_sort(F.transform(backers, lambda v: F.struct((-v["w"]).alias("w"), v["ord"].alias("ord"), v["source"].alias("source"), v["base"].alias("base")))))
    rivals = F.array_max(F.transform(F.filter("_tally", lambda x: x["n"] != F.col("_win.n")), lambda x: x["w"]))
    multi, pure = F.size("_multi") > 0, F.coalesce(F.col("is_pure_bath_bomb"), F.lit(False))
    conflict = F.size("_tally") >= 2
    review = conflict & (F.col("_win.w") < 2 * F.coalesce(rivals, F.lit(0))) & F.lit(rules.conflict_needs_review)
    best = F.get("_back", F.lit(0))
    level = F.when(F.size("_back") >= 2, F.least(F.lit(2), best["base"] + 1)).when(-best["w"] <= 1, F.greatest(F.lit(0), best["base"] - 1)).otherwise(best["base"])
    level = F.when(review, 0).when((level == 2) & ~F.col("_win.text"), 1).otherwise(level)
    named = F.get(F.array(*[F.lit(x) for x in LEVELS]), level)
    firm = F.arrays_overlap("_ones", F.array(*[F.lit(s) for s in ("title", "bullets", "size", "number_of_items")]))
    level_of = lambda s, default: rules.confidence.get(s, default)
    single = F.when(firm, level_of("single_default", "medium")).otherwise("low")
    explicit = F.size("_ones") > 0
    catalogue = F.array(*[F.lit(s) for s in ("number_of_items", "keepa_number_of_items", "keepa_package_quantity", "unit_num")])
    df = df.withColumns(
        {
            "n_bomb_balls": F.when(pure, F.when(multi, F.col("_win.n")).otherwise(rules.default_single)),
            "count_confidence": F.when(~pure, "n/a").when(multi, named).when(explicit, single).otherwise(level_of("assumed_single", "low")),
            "count_source": F.when(pure, F.when(multi, best["source"]).when(explicit, "single_default").otherwise("assumed_single")),
            "count_unable": F.lit(False),
            "count_conflict": pure & conflict,
            "needs_review": F.when(pure, F.when(multi, review).when(explicit, single == "low").otherwise(True)).otherwise(False),
            "seller_counts_pack_as_one": F.exists("_multi", lambda v: v["text"]) & F.arrays_overlap("_ones", catalogue),
        }
    )
    return df.drop("_votes", "_multi", "_ones", "_tally", "_win", "_back")


def score(listings: DataFrame, rules: Rules = DEFAULT, only_pure: bool = False) -> DataFrame:
    """listings with verdict, candidates and resolved count; parsed columns stay. With only_pure, excluded listings have no
    candidates and no seller flag, and their texts are not searched; all else is as without it."""
    return consensus(count_candidates(purity(listings, rules), rules, only_pure), rules)


def class_label() -> Column:
    return F.when(F.col("is_pure_bath_bomb"), "pure").otherwise(F.coalesce(F.nullif(F.col("exclude_reason"), F.lit("")), F.lit("no-bath-bomb")))


def count_label() -> Column:
    n = F.col("n_bomb_balls")
    return (
        F.when(~F.coalesce("is_pure_bath_bomb", F.lit(False)), "n/a").when(F.coalesce("count_unable", F.lit(False)), "count_unable")
        .when(F.coalesce("seller_counts_pack_as_one", F.lit(False)), "pack_as_one").when(n >= 50, "extreme_count").when(n > 1, "multi_pack").when(n == 1, "single").otherwise("count_unable")
    )


def quality_report(scored: DataFrame) -> DataFrame:
    """(facet, value, listings, share): the class split of all rows, and among pure ones the split by confidence, the
    conflicts and the reviews; share is of all rows or of the pure ones. One pass, summed map-side."""
    pure = F.coalesce(F.col("is_pure_bath_bomb"), F.lit(False))
    pair = lambda facet, value: F.struct(F.lit(facet).alias("facet"), value.alias("value"))
    flag = lambda c: F.when(pure & F.coalesce(c, F.lit(False)), "true")
    every = F.array(
        pair("class", class_label()), pair("confidence", F.when(pure, F.col("count_confidence"))), pair("conflict", flag("count_conflict")), pair("review", flag("needs_review"))
    )
    counts = scored.select(F.explode(every).alias("f")).select("f.*").filter("value IS NOT NULL").groupBy("facet", "value").agg(F.count("*").alias("listings"))
    # A handful of rows, as many as there are classes and levels.
    of = F.when(F.col("facet") == "class", F.sum(F.when(F.col("facet") == "class", F.col("listings"))).over(Window.partitionBy())).otherwise(
        F.sum(F.when((F.col("facet") == "class") & (F.col("value") == "pure"), F.col("listings"))).over(Window.partitionBy())
    )
    return counts.select("facet", "value", "listings", (F.col("listings") / of).alias("share"))
