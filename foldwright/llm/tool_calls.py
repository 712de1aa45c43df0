"""Tool-call linking for chat data. DataFrame operations only.

Assistant messages carry calls, tool messages carry results. Both are taken out of their JSON, joined
by conversation and call id, put in dependency order, checked against the schema of the tool, and
written as canonical JSON.

Message formats:

* a message with ``{"tool_calls": [{"id", "name", "arguments": {...}, "after": [ids]}]}`` makes calls;
* a message of role ``tool`` with ``{"tool_call_id", "content"}`` is a result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.staging import stage

#: For each tool: its arguments, as (type, required). Types: string, integer, number, boolean, array, object.
Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]

_CALLS = "tool_calls array<struct<id: string, name: string, arguments: string, after: array<string>>>"
_RESULT = "tool_call_id string, content string"
#: How Spark names the type of a JSON value.
_KINDS = {
    "string": "^STRING$",
    "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$",
    "number": "^(BIGINT|DOUBLE|DECIMAL\\(\\d+,\\d+\\))$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY<.*>$",
    "object": "^OBJECT<.*>$",
}


def tool_calls(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``conv, turn, id, name, arguments, after``: one row per call with an id; other messages give none."""
    calls = F.explode(F.from_json(F.col(text), _CALLS)["tool_calls"]).alias("call")
    found = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), calls)
    return found.select("conv", "turn", "call.*").filter("id is not null")


def tool_results(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, id, result_turn, content, n_results``: the first result of each call id (by turn, then content).

    Results are summed up before the shuffle, so an id that was answered a million times is one row.
    """
    parsed = F.from_json(F.col(text), _RESULT)
    rows = messages.filter(F.col(role) == "tool").select(
        F.col(conv).alias("conv"), parsed["tool_call_id"].alias("id"), F.struct(F.col(turn).alias("turn"), parsed["content"].alias("content")).alias("answer")
    )
    summed = rows.filter("id is not null").groupBy("conv", "id").agg(F.min("answer").alias("first"), F.count("*").alias("n_results"))
    return summed.select("conv", "id", F.col("first.turn").alias("result_turn"), F.col("first.content").alias("content"), "n_results")


def dependency_levels(calls: DataFrame) -> DataFrame:
    """``conv, id, level``: 0 without dependencies, else one more than the highest of them; null in or behind a cycle.

    Dependencies on ids that the conversation does not call are ignored. Each round takes the calls
    whose dependencies are all placed; there are as many rounds as the longest chain has calls, and
    every round is written to the shared folder.
    """
    nodes = stage(calls.select("conv", "id").distinct(), "calls")
    wanted = calls.select("conv", "id", F.explode("after").alias("needs")).filter("needs is not null").distinct()
    known = nodes.withColumnRenamed("id", "needs")
    left = stage(wanted.join(known, ["conv", "needs"], "left_semi"), "dependencies")
    placed, level = None, 0
    waiting = nodes
    while True:
        free = stage(waiting.join(left, ["conv", "id"], "left_anti").select("conv", "id", F.lit(level).alias("level")), "level")
        if free.isEmpty():
            break
        placed = free if placed is None else placed.union(free)
        waiting = stage(waiting.join(free, ["conv", "id"], "left_anti"), "waiting")
        left = stage(left.join(free.select("conv", F.col("id").alias("needs")), ["conv", "needs"], "left_anti"), "dependencies")
        level += 1
    stuck = waiting.select("conv", "id", F.lit(None).cast("int").alias("level"))
    return stuck if placed is None else placed.union(stuck)


def problems(schemas: Schemas, name: Column, arguments: Column) -> Column:
    """What is wrong with the arguments, in a fixed order: an empty array if nothing is."""
    parsed = F.try_parse_json(arguments)
    cases = F.when(name.isNull() | ~name.isin(*schemas), F.array(F.lit("unknown tool")))
    cases = cases.when(~F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT<"), F.lit(False)), F.array(F.lit("arguments are no object")))
    for tool, fields in schemas.items():
        found = []
        for field in sorted(fields):
            kind, required = fields[field]
            value = F.schema_of_variant(F.try_variant_get(parsed, f"$['{field}']", "variant"))
            missing = F.when(F.lit(required) & (value.isNull() | (value == "VOID")), F.lit(f"missing {field}"))
            found.append(missing.when(value.isNotNull() & (value != "VOID") & ~value.rlike(_KINDS[kind]), F.lit(f"type of {field}")))
        unknown = F.transform(
            F.array_sort(F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(f) for f in fields]).cast("array<string>"))),
            lambda key: F.concat(F.lit("unknown "), key),
        )
        cases = cases.when(name == tool, F.concat(F.array_compact(F.array(*found).cast("array<string>")), F.coalesce(unknown, F.array().cast("array<string>"))))
    return cases


def canonical(json: Column) -> Column:
    """The JSON value with sorted keys and no spaces; null where it is no JSON."""
    return F.to_json(F.try_parse_json(json))


def link_tool_calls(
    messages: DataFrame, schemas: Schemas, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per call: ``conv_id, call_id, name, call_turn, level, result_turn, n_results, problems, valid, json``.

    Calls without a result keep a null ``result_turn`` and 0 results; results without a call are left
    out. An id that is called again gives a row each time, with the same result. Rows with a null
    conversation form one conversation. (``level``, ``call_turn``) is a topological order within a
    conversation. ``json`` holds arguments, id, name and result with sorted keys; arguments or content
    that are no JSON stay as strings. No messages, or none of these formats: no rows.
    """
    calls = stage(tool_calls(messages, conv, turn, text).withColumn("conv", F.col("conv").cast("string")), "tool-calls")
    results = tool_results(messages, conv, turn, role, text).withColumn("conv", F.col("conv").cast("string"))
    blank = F.lit("\u0000")
    keyed = calls.withColumn("conv", F.coalesce("conv", blank))
    linked = keyed.join(results.withColumn("conv", F.coalesce("conv", blank)), ["conv", "id"], "left").join(dependency_levels(keyed), ["conv", "id"])

    def value(name: str) -> Column:
        text_value = F.to_json(F.array(F.col(name)))
        whole = F.coalesce(canonical(F.col(name)), F.substring(text_value, F.lit(2), F.length(text_value) - 2))
        return F.coalesce(whole, F.lit("null"))

    def quoted(name: str) -> Column:
        text_value = F.to_json(F.array(F.coalesce(F.col(name), F.lit(""))))
        return F.substring(text_value, F.lit(2), F.length(text_value) - 2)

    line = F.concat(
        F.lit('{"arguments":'), value("arguments"), F.lit(',"id":'), quoted("id"), F.lit(',"name":'), quoted("name"), F.lit(',"result":'), value("content"), F.lit("}")
    )
    wrong = problems(schemas, F.col("name"), F.col("arguments"))
    kind = dict(messages.dtypes)[conv]
    return linked.select(
        F.when(F.col("conv") != blank, F.col("conv")).cast(kind).alias("conv_id"),
        F.col("id").alias("call_id"),
        "name",
        F.col("turn").alias("call_turn"),
        "level",
        "result_turn",
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.array_join(wrong, "; ").alias("problems"),
        ((F.size(wrong) == 0) & F.col("level").isNotNull()).alias("valid"),
        line.alias("json"),
    )
