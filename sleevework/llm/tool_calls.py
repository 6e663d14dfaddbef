"""Tool calls and their results: linked by identifier, ordered by dependency, validated, in canonical JSON.

Built-in column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleevework.llm.shared import ranked, saved

#: Types of a tool's parameters, with the names that Spark gives to the type of a JSON value.
JSON_TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DECIMAL", "DOUBLE"), "boolean": ("BOOLEAN",), "object": ("OBJECT",), "array": ("ARRAY",)}


def _path(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def argument_problems(name: str, arguments: str, tools: dict[str, dict[str, dict]]) -> Column:
    """The sorted problems of a call's arguments against the schema of its tool; empty if there are none.

    A schema maps parameter names to ``type`` and optionally ``required``, ``enum``, ``minimum``, ``maximum``.
    Other parameters are not allowed. Arguments that are null or not a JSON object have that one problem.
    """
    value = F.try_parse_json(F.col(arguments))
    problems = F.array(F.lit("unknown tool"))
    for tool, parameters in tools.items():
        found: list[Column] = []
        for key, rule in parameters.items():
            given = F.try_variant_get(value, _path(key), "variant")
            kind = F.regexp_extract(F.schema_of_variant(given), r"^[A-Z]+", 0)
            present = F.array_contains(F.json_object_keys(arguments), key)
            if rule.get("required"):
                found.append(F.when(~present, F.lit(f"missing {key}")))
            found.append(F.when(present & ~F.coalesce(kind.isin(*JSON_TYPES[rule["type"]]), F.lit(False)), F.lit(f"type {key}")))
            if "enum" in rule:
                found.append(F.when(present & ~F.coalesce(F.try_variant_get(value, _path(key), "string").isin(*rule["enum"]), F.lit(False)), F.lit(f"value {key}")))
            number = F.try_variant_get(value, _path(key), "double")
            for bound, beyond in (("minimum", number < rule.get("minimum")), ("maximum", number > rule.get("maximum"))) if {"minimum", "maximum"} & set(rule) else ():
                if bound in rule:
                    found.append(F.when(present & beyond, F.lit(f"{bound} {key}")))
        extra = F.transform(F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(k) for k in parameters]).cast("array<string>")), lambda k: F.concat(F.lit("unexpected "), k))
        listed = F.concat(F.array_compact(F.array(*found)) if found else F.array().cast("array<string>"), F.coalesce(extra, F.array().cast("array<string>")))
        problems = F.when(F.col(name) == tool, F.array_sort(listed)).otherwise(problems)
    is_object = F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.lit(False))
    return F.when(~is_object, F.array(F.lit("not a JSON object"))).otherwise(problems)


def canonical_json(column: str) -> Column:
    """The same JSON value with sorted keys and no blanks; NULL for text that is not JSON or repeats a key."""
    return F.to_json(F.try_parse_json(F.col(column)))


def _depths(nodes: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) of (conv_id, call_id, parent_id): calls above a call; NULL on or below a cycle.

    Every round each call looks twice as far up, so a chain of n calls takes log2(n) rounds.
    """
    known = nodes.select(F.col("conv_id").alias("conv_"), F.col("call_id").alias("parent_"))
    same = F.col("conv_id").eqNullSafe(F.col("conv_"))
    up = nodes.join(known, same & (F.col("parent_id") == F.col("parent_")), "left")
    up = saved(up.select("conv_id", "call_id", F.col("parent_").alias("above"), F.when(F.col("parent_").isNull(), 0).otherwise(1).cast("long").alias("depth")), "calls-up")
    longest = up.count()
    reach = 1
    while reach <= longest and up.where("above is not null").limit(1).count():
        further = up.select(F.col("conv_id").alias("conv_"), F.col("call_id").alias("call_"), F.col("above").alias("above_"), F.col("depth").alias("depth_"))
        step = up.join(further, same & (F.col("above") == F.col("call_")), "left")
        up = saved(step.select("conv_id", "call_id", F.col("above_").alias("above"), (F.col("depth") + F.coalesce("depth_", F.lit(0))).alias("depth")), "calls-up")
        reach *= 2
    return up.select("conv_id", "call_id", F.when(F.col("above").isNull(), F.col("depth")).alias("depth"))


def link_tool_calls(calls: DataFrame, results: DataFrame, tools: dict[str, dict[str, dict]]) -> DataFrame:
    """One row per call, and per result without a call, in ``call_order`` within its conversation.

    ``calls``: (conv_id, call_id, parent_id, name, arguments, position); ``results``: (conv_id, call_id, content,
    position); other columns are not read. Output: conv_id, call_id, status, name, arguments (canonical JSON),
    problems, content (of the first result), n_results, n_calls, depth, call_order.

    * Of calls that share conversation and identifier the first by (position, name, arguments) counts; ``n_calls``
      has their number. Of several results the first by (position, content) is linked; ``n_results`` has all.
    * ``status``: ``linked``, ``unanswered`` (no result), ``orphan`` (result without call, a row of its own),
      ``cycle`` (the call is on or below a cycle of parents; it has no depth and comes after the others).
    * A parent that is null or names no call makes a root. Depth first, then position, then identifier orders the
      calls, so every call comes after the one it depends on; orphans come last.
    * A null call identifier links with nothing: such a call is unanswered, each by itself, such a result an
      orphan. A null conversation is a conversation of its own. Empty tables give no rows.
    """
    first = F.min(F.struct("position", "name", "arguments", "parent_id")).alias("first")
    named = calls.where("call_id is not null").groupBy("conv_id", "call_id").agg(first, F.count("*").alias("n_calls"))
    named = named.select("conv_id", "call_id", "n_calls", "first.*")
    loose = calls.where("call_id is null").select("conv_id", F.lit(None).cast("string").alias("call_id"), F.lit(1).cast("long").alias("n_calls"), "position", "name", "arguments", "parent_id")
    named = saved(named.select(loose.columns), "calls")
    answer = results.groupBy(F.col("conv_id").alias("conv_r"), F.col("call_id").alias("call_r")).agg(F.min(F.struct("position", "content")).alias("answer"), F.count("*").alias("n_results"))
    depths = _depths(named.select("conv_id", "call_id", "parent_id")).withColumnsRenamed({"conv_id": "conv_d", "call_id": "call_d"})

    same_result = F.col("conv_id").eqNullSafe(F.col("conv_r")) & (F.col("call_id") == F.col("call_r"))
    both = named.join(answer, same_result, "full")
    conv, call = F.coalesce("conv_id", "conv_r"), F.coalesce("call_id", "call_r")
    is_call = F.col("n_calls").isNotNull()
    both = both.select(conv.alias("conv_id"), call.alias("call_id"), "name", "arguments", "n_calls", "answer", "n_results", F.coalesce("position", "answer.position").alias("position"), is_call.alias("is_call"))
    rows = both.unionByName(loose.select("conv_id", "call_id", "name", "arguments", "n_calls", F.lit(None).cast(both.schema["answer"].dataType).alias("answer"), F.lit(None).cast("long").alias("n_results"), "position", F.lit(True).alias("is_call")))
    same_depth = F.col("conv_id").eqNullSafe(F.col("conv_d")) & (F.col("call_id") == F.col("call_d"))
    rows = rows.join(depths.withColumn("known", F.lit(True)), same_depth, "left")
    depth = F.when(F.col("known"), F.col("depth")).when(F.col("is_call"), F.lit(0).cast("long"))
    status = (
        F.when(~F.col("is_call"), "orphan")
        .when(F.col("known") & F.col("depth").isNull(), "cycle")
        .when(F.col("n_results").isNull(), "unanswered")
        .otherwise("linked")
    )
    done = rows.select(
        "conv_id", "call_id", status.alias("status"), "name", canonical_json("arguments").alias("arguments"),
        F.when(F.col("is_call"), argument_problems("name", "arguments", tools)).alias("problems"),
        F.col("answer.content").alias("content"), F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"),
        depth.alias("depth"), F.when(~F.col("is_call"), 2).when(depth.isNull(), 1).otherwise(0).alias("late_"), F.coalesce(depth, F.lit(0)).alias("depth_"), "position",
    )
    return ranked(saved(done, "calls-done"), ["conv_id"], ["late_", "depth_", "position", "call_id"], "call_order").drop("late_", "depth_", "position")


#: The tools of the sample conversations.
SAMPLE_TOOLS = {
    "search": {"query": {"type": "string", "required": True}, "limit": {"type": "integer", "required": True, "minimum": 1, "maximum": 60}, "strict": {"type": "boolean"}},
    "lookup": {"query": {"type": "string", "required": True}, "lines": {"type": "integer", "minimum": 1, "maximum": 3}, "mode": {"type": "string", "enum": ["short", "long"]}},
}


def calls_of_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as the turns of conversations hold them.

    Every assistant turn is a call whose arguments come from its text; it depends on the assistant turn two
    places before. Every user turn after the first is the result of the call one place before.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words, lines = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), (F.regexp_count(text, F.lit("\n")) + 1).cast("long")
    name = F.when(words % 3 == 0, "search").when(words % 3 == 1, "lookup").otherwise("browse")
    search = F.to_json(F.struct((words % 2 == 0).alias("strict"), text.alias("query"), words.alias("limit")))
    lookup = F.to_json(F.struct(text.alias("query"), F.when(lines == 2, "brief").otherwise("short").alias("mode"), lines.alias("lines")))
    told = F.when(words % 3 == 0, search).when(words % 3 == 1, lookup).otherwise(text)
    place = F.col("turn")
    calls = turns.where("role = 'assistant'").select("conv_id", F.concat(F.lit("c"), place).alias("call_id"), F.concat(F.lit("c"), place - 2).alias("parent_id"), name.alias("name"), told.alias("arguments"), place.alias("position"))
    results = turns.where("role = 'user' and turn > 0").select("conv_id", F.concat(F.lit("c"), place - 1).alias("call_id"), text.alias("content"), place.alias("position"))
    return calls, results
