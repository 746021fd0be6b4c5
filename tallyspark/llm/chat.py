"""Chat formatting: tool calls linked to their results.

Calls and results meet in an equi-join by conversation and call id, calls are ordered topologically by what they depend on,
arguments are validated against schemas, and each call becomes one line of canonical JSON (keys sorted, no spaces).
Everything is DataFrame expressions. Conversations are never gathered: the order is given by (topo_level, turn) columns,
so a conversation with any number of turns is dealt over all tasks.

Defined results: equal call ids of two conversations are two calls; rows without a conversation are one conversation. A null
call id links to nothing: such a call is returned flagged no_id, such a result as an orphan. Of several results for one
call the first by turn (then text) is used and the call is flagged; repeated calls are all returned and flagged. Every
result without a call is returned as an orphan, flagged if its id repeats. Calls on a cycle, or behind one, have level null.
Dependencies that do not exist are flagged and ignored, null ones ignored. Unparsable arguments are flagged and kept as a
string. Empty tables give empty results; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import materialize

# JSON kinds by the type that Spark gives a value of a variant.
KINDS = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DECIMAL|DOUBLE)", "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT"}

Schemas = dict[str, dict[str, tuple[str, bool]]]


def problems_of(name: Column, args: Column, raw: Column, schemas: Schemas) -> Column:
    """What is wrong with the arguments; schemas: tool to argument to (kind, required)."""
    found = [F.when(~F.coalesce(name.isin(list(schemas)), F.lit(False)), "unknown_tool"), F.when(args.isNull(), "bad_json")]
    for tool, fields in schemas.items():
        here = (name == tool) & args.isNotNull()
        keys = F.json_object_keys(raw)
        found.append(F.when(here & keys.isNull(), "not_an_object"))
        extra = F.array_except(keys, F.array(*[F.lit(f) for f in fields]))
        found.append(F.when(here & (F.size(extra) > 0), F.concat(F.lit("unexpected:"), F.array_join(F.array_sort(extra), "+"))))
        for field, (kind, required) in fields.items():
            value = F.try_variant_get(args, f"$.{field}", "variant")
            type_ = F.schema_of_variant(value)
            if required:
                found.append(F.when(here & keys.isNotNull() & value.isNull(), f"missing:{field}"))
            found.append(F.when(here & value.isNotNull() & ~type_.rlike(KINDS[kind]), f"type:{field}"))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def _depths(picked: DataFrame) -> DataFrame:
    """(id, depth) of each child of picked (child, parent; one parent each): steps to the end of its chain, null if that is a cycle.

    Pointers are doubled: a round lets each child jump as far again as it has come, so a chain takes log2 of its length rounds.
    A round that settles no child leaves only cycles and what hangs on them, as of any open chain's children one settles.
    """
    ends = picked.select(F.col("child").alias("_child"), F.lit(True).alias("_open"))
    jumps = picked.join(ends, F.col("parent") == F.col("_child"), "left")
    jumps = materialize(jumps.select(F.col("child").alias("id"), F.col("parent").alias("to"), F.lit(1).alias("depth"), F.coalesce("_open", F.lit(False)).alias("open")), "jumps")
    left = None
    while (now := jumps.filter("open").count()) and now != left:
        left = now
        onward = jumps.select(F.col("id").alias("_id"), F.col("to").alias("_to"), F.col("depth").alias("_depth"), F.col("open").alias("_open"))
        moved = jumps.filter("open").join(onward, F.col("to") == F.col("_id"))
        moved = moved.select("id", F.col("_to").alias("to"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_open").alias("open"))
        jumps = materialize(jumps.filter("not open").unionByName(moved), "jumps")
    return jumps.select("id", F.when(~F.col("open"), F.col("depth")).alias("depth"))


def topological_levels(edges: DataFrame) -> DataFrame:
    """(id, level) of each child: one more than the highest of its parents' levels, those without parents having 0; null on a
    cycle or behind one. edges: child, parent, turn (of the parent), distinct.

    Each child holds on to one parent, at first the latest; the chains that this makes are measured by _depths, and a child
    with a parent deeper than its own goes over to the deepest, until none has. A parent on a cycle is deeper than any. In
    conversations the latest parent is nearly always the deepest, so chains of any length take a few times log2 rounds.
    """
    picked = materialize(edges.groupBy("child").agg(F.max_by("parent", F.struct("turn", "parent")).alias("parent")), "picked")
    while True:
        depth = _depths(picked)
        rank = F.when(F.col("_id").isNull(), 0).otherwise(F.coalesce("depth", F.lit(2147483647)))
        ranked = edges.select("child", "parent").join(depth.withColumnRenamed("id", "_id"), F.col("parent") == F.col("_id"), "left").withColumn("rank", rank)
        held = picked.select(F.col("child").alias("_child"), F.col("parent").alias("_parent"))
        best = ranked.join(held, F.col("child") == F.col("_child")).groupBy("child").agg(
            F.max_by("parent", F.struct("rank", (F.col("parent") == F.col("_parent")).alias("held"), "parent")).alias("parent"), F.max("rank").alias("rank"),
            F.max(F.when(F.col("parent") == F.col("_parent"), F.col("rank"))).alias("had"),
        )
        best = materialize(best, "picked")
        if best.filter("rank > had").isEmpty():
            return depth.select("id", F.col("depth").alias("level"))
        picked = best.select("child", "parent")


def _id(conv: Column, call: Column) -> Column:
    """Call ids are those of a conversation; all rows without a conversation are one."""
    return F.struct(conv.cast("string").alias("conv"), call.cast("string").alias("call"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call and per orphan result.

    calls: conv_id, call_id, turn, name, arguments (JSON text), depends_on (array of call ids of the conversation). results:
    conv_id, call_id, turn, content.
    """
    calls = calls.select("conv_id", "call_id", "turn", "name", "arguments", F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on"))
    named = calls.filter("call_id is not null").withColumn("id", _id(F.col("conv_id"), F.col("call_id")))
    known = materialize(named.groupBy("id").agg(F.count("*").alias("n_calls"), F.max("turn").alias("at")), "calls")
    answers = results.select("conv_id", "call_id", "turn", "content").withColumn("id", _id(F.col("conv_id"), F.col("call_id")))
    first = answers.filter("call_id is not null").groupBy("id").agg(F.count("*").alias("n_results"), F.min(F.struct("turn", "content")).alias("_first"))
    want = named.select(F.col("id").alias("child"), "conv_id", F.explode("depends_on").alias("call")).filter("call is not null")
    want = want.select("child", _id(F.col("conv_id"), F.col("call")).alias("parent")).distinct()
    have = known.select(F.col("id").alias("_id"), F.col("at").alias("turn"), F.lit(True).alias("_has"))
    want = materialize(want.join(have, F.col("parent") == F.col("_id"), "left").drop("_id"), "depends")
    levels = topological_levels(want.filter("_has").select("child", "parent", "turn"))
    lost = want.filter("_has is null").groupBy(F.col("child").alias("id")).agg(F.count("*").alias("n_lost"))
    # A call that depends on others has a level, null on or behind a cycle; any other one has 0.
    level = F.when(F.col("_depends"), F.col("level")).otherwise(0)
    linked = (
        named.join(first, "id", "left").join(known.select("id", "n_calls"), "id", "left").join(lost, "id", "left")
        .join(levels.withColumn("_depends", F.lit(True)), "id", "left").withColumn("topo_level", level).drop("id", "level", "_depends")
    )
    # Calls without an id meet nothing and are not dealt by it.
    linked = linked.unionByName(calls.filter("call_id is null"), allowMissingColumns=True)
    args = F.try_parse_json("arguments")
    flags = F.array(
        F.when(F.col("call_id").isNull(), "no_id"),
        F.when(F.col("n_calls") > 1, "repeated_call"),
        F.when(F.col("n_results").isNull(), "no_result"),
        F.when(F.col("n_results") > 1, "repeated_result"),
        F.when(F.col("n_lost") > 0, "missing_dependency"),
        F.when(F.col("topo_level").isNull() & F.col("call_id").isNotNull(), "cycle"),
    )
    found = linked.withColumn("_args", args).withColumn(
        "_problems", F.concat(F.filter(flags, lambda x: x.isNotNull()), problems_of(F.col("name"), F.col("_args"), F.col("arguments"), schemas))
    )
    # Variant objects keep their keys in order; the pieces are put together in the order of their keys.
    text = lambda c: F.coalesce(F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", ""), F.lit("null"))
    pieces = {
        "arguments": F.coalesce(F.to_json("_args"), text(F.col("arguments"))),
        "call_id": text(F.col("call_id")), "depends_on": F.to_json(F.array_sort("depends_on")), "name": text(F.col("name")), "result": text(F.col("_first.content")),
    }
    line = F.concat(F.lit("{"), reduce(lambda a, b: F.concat(a, F.lit(","), b), [F.concat(F.lit(f'"{k}":'), v) for k, v in pieces.items()]), F.lit("}"))
    done = found.select(
        "conv_id", "call_id", "turn", "topo_level", (F.size("_problems") == 0).alias("valid"), F.array_join("_problems", ",").alias("problems"), line.alias("message")
    )
    orphan = F.concat(F.lit('{"call_id":'), text(F.col("call_id")), F.lit(',"result":'), text(F.col("content")), F.lit("}"))
    lone = lambda df, problems: df.select(
        "conv_id", "call_id", "turn", F.lit(None).cast("int").alias("topo_level"), F.lit(False).alias("valid"), problems.alias("problems"), orphan.alias("message")
    )
    stray = answers.filter("call_id is not null").join(known.select("id"), "id", "left_anti").join(first.select("id", "n_results"), "id")
    again = F.when(F.col("n_results") > 1, "orphan_result,repeated_result").otherwise("orphan_result")
    return done.unionByName(lone(stray, again)).unionByName(lone(answers.filter("call_id is null"), F.lit("orphan_result,no_id")))


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame, Schemas]:
    """Calls, results and schemas derived from all conversation turns: a user's turn calls a tool, a system turn calls one that
    sets its policy, and any other turn is the result of the turn before it.

    Every third tool, some arguments of wrong kind or unknown tools, chains of dependencies through all of a conversation's
    user turns, with a second dependency further back at some, all from the turn's numbers, so every rule is met in the
    table. A turn without a number or a conversation has no call id.
    """
    at = lambda d: F.concat(F.col("conv_id").cast("string"), F.lit(":"), (F.col("turn") + d).cast("string"))
    role, turn = F.coalesce("role", F.lit("")), F.col("turn")
    odd = F.pmod(F.col("conv_id"), F.lit(11))
    name = F.when(role == "system", "configure").when(odd == 3, "forecast").when(F.pmod(turn, F.lit(4)) == 0, "search").otherwise("translate")
    args = (
        F.when(name == "configure", F.to_json(F.struct(F.col("text").alias("policy"))))
        .when(odd == 5, F.concat(F.lit("{broken "), F.col("text")))
        .when(odd == 7, F.to_json(F.struct(F.col("text").alias("query"), F.lit("many").alias("limit"))))
        .when(name == "translate", F.to_json(F.struct(F.col("text").alias("text"), F.lit("en").alias("into"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("query"), turn.alias("limit"))))
    )
    back = F.array(F.when(turn >= 2, at(-2)), F.when((turn >= 6) & (F.pmod(turn, F.lit(3)) == 0), at(-6)))
    calls = conversations.filter(role.isin("user", "system")).select(
        "conv_id", at(0).alias("call_id"), "turn", name.alias("name"), args.alias("arguments"), F.array_compact(back).alias("depends_on")
    )
    results = conversations.filter(~role.isin("user", "system")).select("conv_id", at(-1).alias("call_id"), "turn", F.col("text").alias("content"))
    schemas = {
        "search": {"query": ("string", True), "limit": ("integer", False)}, "translate": {"text": ("string", True), "into": ("string", True)},
        "configure": {"policy": ("string", True)},
    }
    return calls, results, schemas
