"""Tool calls of conversations linked with their results, ordered, validated and written as canonical JSON.

Calls and results meet by a hash join on conversation and identifier. A conversation's calls are in
topological order of the calls they depend on. Chains of calls that need one other call each are drawn
together by doubling, so that rounds grow with the logarithm of a chain's length; only calls that need
several others are settled layer by layer.
Arguments are checked against a schema per tool with the variant type, whose text form has its keys
sorted, and one line of JSON per call is the output, so a conversation of any length is never in
one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.plans.staging import stored

# What schema_of_variant says for the types of a tool's schema.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "DOUBLE|BIGINT|DECIMAL.*", "boolean": "BOOLEAN",
         "object": "OBJECT<.*", "array": "ARRAY<.*"}


def argument_faults(name: Column, arguments: Column, schemas: dict[str, dict]) -> Column:
    """ARRAY<STRING> of what is wrong with a call, in order of the words; empty for a valid one.

    A schema is ``{"required": [..], "types": {argument: type}}`` with the types of ``TYPES``.
    Faults are: unknown tool, not an object, missing and mistyped arguments, and unknown ones.
    """
    parsed = F.try_parse_json(arguments)
    kind = F.schema_of_variant(parsed)
    checks: Column | None = None
    for tool, schema in schemas.items():
        types = schema.get("types", {})
        found = []
        for argument in sorted({*types, *schema.get("required", [])}):
            value = F.try_variant_get(parsed, f'$["{argument}"]', "variant")
            present = F.array_contains(F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>")), argument)
            if argument in schema.get("required", []):
                found.append(F.when(~present, F.lit(f"missing {argument}")))
            if argument in types:
                fits = F.coalesce(F.schema_of_variant(value).rlike(f"^(?:{TYPES[types[argument]]})$"), F.lit(False))
                found.append(F.when(present & ~fits, F.lit(f"mistyped {argument}")))
        known = F.array(*map(F.lit, types)) if types else F.array().cast("array<string>")
        unknown = F.transform(F.array_except(F.json_object_keys(arguments), known), lambda k: F.concat(F.lit("unknown "), k))
        faults = F.array_sort(F.concat(F.array_compact(F.array(*found)) if found else F.array().cast("array<string>"),
                                       F.coalesce(unknown, F.array().cast("array<string>"))))
        case = name == tool
        checks = F.when(case, faults) if checks is None else checks.when(case, faults)
    no_tool = F.array(F.lit("unknown tool"))
    tools = checks.otherwise(no_tool) if checks is not None else no_tool
    return F.when(parsed.isNull() | ~F.coalesce(kind.rlike("^OBJECT"), F.lit(False)), F.array(F.lit("not an object"))).otherwise(tools)


def _levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """conv, call, level: one more than the highest level a call needs; null for calls in or behind a cycle.

    Calls that need none are at 0.
    """
    counted = needs.groupBy("conv", "call").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need"))
    nodes = stored(calls.select("conv", "call").join(counted, ["conv", "call"], "left").select(
        "conv", "call", F.coalesce("n", F.lit(0)).alias("n"), "need"), "nodes")
    jumps = _drawn_together(nodes.where("n = 1").select("conv", "call", F.col("need").alias("anchor"), F.lit(1).alias("steps")))
    # Where a chain's end still needs one call, the chain runs into a circle.
    ends = jumps.join(nodes.select("conv", F.col("call").alias("anchor"), F.col("n").alias("ends_in")), ["conv", "anchor"])
    ends = stored(ends.where("ends_in != 1").select("conv", "call", "anchor", "steps"), "ends")
    done = stored(nodes.where("n = 0").select("conv", "call", F.lit(0).alias("level")), "level")
    several = nodes.where("n > 1").select("conv", "call")
    if not several.isEmpty():
        done = _settled(needs.join(several, ["conv", "call"], "left_semi"), ends, done)
    behind = done.select("conv", F.col("call").alias("anchor"), F.col("level").alias("base"))
    chained = ends.join(behind, ["conv", "anchor"]).select("conv", "call", (F.col("base") + F.col("steps")).alias("level"))
    return calls.select("conv", "call").join(done.unionByName(chained), ["conv", "call"], "left")


def _drawn_together(jumps: DataFrame) -> DataFrame:
    """conv, call, anchor, steps: every link of a chain with the end of the chain and its distance.

    Each round joins a link with the one it points to, so distances double.
    """
    jumps, reach = stored(jumps, "jumps"), 1
    longest = jumps.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    while reach < longest:
        onto = jumps.select("conv", F.col("call").alias("anchor"), F.col("anchor").alias("next"), F.col("steps").alias("more"))
        jumps = stored(jumps.join(onto, ["conv", "anchor"], "left").select(
            "conv", "call", F.coalesce("next", "anchor").alias("anchor"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), "jumps")
        reach *= 2
    return jumps


def _settled(needs: DataFrame, ends: DataFrame, done: DataFrame) -> DataFrame:
    """``done`` with the calls that need several others, settled as soon as all their needs are."""
    chains = ends.select("conv", F.col("call").alias("need"), "anchor", "steps")
    # A need in a chain stands for the chain's end; one in a circle for itself, which is never settled.
    left = needs.join(chains, ["conv", "need"], "left").select(
        "conv", "call", F.coalesce("anchor", "need").alias("need"), F.coalesce("steps", F.lit(0)).alias("steps"))
    left, settled = stored(left, "needs"), done
    while not settled.isEmpty() and not left.isEmpty():
        known = done.select("conv", F.col("call").alias("need"), "level")
        tried = left.join(known, ["conv", "need"], "left").groupBy("conv", "call").agg(
            F.max(F.col("level") + F.col("steps")).alias("level"), F.count_if(F.col("level").isNull()).alias("missing"))
        settled = stored(tried.where("missing = 0").select("conv", "call", (F.col("level") + 1).alias("level")), "level")
        done = stored(done.unionByName(settled), "done")
        left = stored(left.join(settled, ["conv", "call"], "left_anti"), "needs")
    return done


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call or orphaned result, with its place in the conversation's order and its JSON.

    ``calls`` has conv, call (identifier), turn, name, arguments (JSON text) and needs (array of
    identifiers in the conversation); ``results`` has conv, call, turn and content. Other columns
    are not read. Returns conv, call, status, level, turn, faults and line. The status is
    ``linked``, ``unanswered`` (no result) or ``orphan`` (a result without call). Of repeated calls
    or results of one identifier the first by turn, then by content, counts; rows without
    conversation or identifier are left out. Needs that name no call, or the call itself, are
    ignored. ``level`` is one more than the highest level among a call's needs, 0 for a call without any and for an
    orphan, and null in and behind a circle: the order within a conversation is (level, turn, call), nulls last.
    """
    known = "conv IS NOT NULL AND call IS NOT NULL"
    asked = stored(calls.where(known).groupBy("conv", "call").agg(
        F.min(F.struct("turn", "name", "arguments", "needs")).alias("first")), "calls")
    asked = asked.select("conv", "call", "first.*", F.lit(True).alias("asked"))
    answered = results.where(known).groupBy("conv", "call").agg(F.min(F.struct("turn", "content")).alias("result"))

    each = asked.select("conv", "call", "turn", F.explode(F.array_distinct("needs")).alias("need")).where("need != call")
    needs = each.join(asked.select("conv", F.col("call").alias("need")), ["conv", "need"])
    levels = _levels(asked, stored(needs.select("conv", "call", "need"), "needs"))

    joined = asked.join(answered, ["conv", "call"], "full").join(levels, ["conv", "call"], "left")
    status = F.when(F.col("asked").isNull(), "orphan").when(F.col("result").isNull(), "unanswered").otherwise("linked")
    faults = F.when(F.col("status") == "orphan", F.array().cast("array<string>")).otherwise(
        argument_faults(F.col("name"), F.col("arguments"), schemas))
    rows = joined.withColumn("status", status).select(
        "conv", "call", "status", F.when(F.col("asked"), F.col("level")).otherwise(0).alias("level"),
        F.when(F.col("asked"), F.col("turn")).otherwise(F.col("result.turn")).alias("turn"), "name", "arguments", "result",
        faults.alias("faults"))
    return rows.select("conv", "call", "status", "level", "turn", "faults", canonical(F.struct(
        F.when(F.col("arguments").isNotNull(), F.coalesce(
            F.try_parse_json("arguments"), F.to_variant_object(F.struct(F.col("arguments").alias("text"))))).alias("arguments"),
        F.col("call"), F.col("conv"), F.col("faults"), F.col("name"), F.col("result.content").alias("result"), F.col("status"),
        F.col("turn"))).alias("line"))


def canonical(value: Column) -> Column:
    """JSON text without spaces and null entries; fields as they are given, keys of variants sorted."""
    return F.to_json(value)
