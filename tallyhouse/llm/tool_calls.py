"""Tool-call linking: calls and results meet by identifier, in topological order, as canonical JSON.

A call may name the call that it comes after. Its level is its distance from a call that comes after none: every call
stands on a higher level than the one it follows, so (level, turn) is a topological order. Levels come from pointer
jumping, a join a round and a number of rounds logarithmic in the longest chain; no conversation is gathered in a task.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_through

#: Tools and bytes of their schemas that are sent to the tasks.
MOST_TOOLS, MOST_SCHEMA_BYTES = 10_000, 16 << 20

KINDS = {
    "object": dict, "array": list, "string": str, "boolean": bool, "null": type(None), "number": (int, float), "integer": int,
}


def canonical(value) -> str:
    """Sorted keys, no white space, only the escapes that JSON needs."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _is(value, kind: str) -> bool:
    if kind in ("number", "integer") and isinstance(value, bool):
        return False
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return kind in KINDS and isinstance(value, KINDS[kind])


def violation(value, schema, at: str = "$") -> str | None:
    """The first way in which a value breaks a schema, or none; keywords: type, enum, const, properties, required,
    additionalProperties, items, minItems, maxItems, minimum, maximum, minLength, maxLength, pattern."""
    if schema is True or schema == {}:
        return None
    if schema is False:
        return f"{at}: not allowed"
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return f"{at}: not {' or '.join(kinds)}"
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        return f"{at}: not in enum"
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        return f"{at}: not the constant"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in sorted(schema.get("required", [])):
            if name not in value:
                return f"{at}.{name}: missing"
        for name in sorted(value):
            found = violation(value[name], known.get(name, schema.get("additionalProperties", True)), f"{at}.{name}")
            if found:
                return found
    elif isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            return f"{at}: {len(value)} items"
        for i, item in enumerate(value):
            found = violation(item, schema.get("items", True), f"{at}[{i}]")
            if found:
                return found
    elif isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
            return f"{at}: length {len(value)}"
        if "pattern" in schema and not re.search(schema["pattern"], value):
            return f"{at}: no match"
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        if not schema.get("minimum", value) <= value <= schema.get("maximum", value):
            return f"{at}: out of range"
    return None


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, after) with unique identifiers -> (conv_id, call_id, level).

    ``level`` is null for a call that follows itself by any way. An ``after`` that names no call counts as none. Each
    round a call that has not reached its chain's start adds the level of the call it points to, and points to where
    that one points; a round that brings no call to a start leaves only circles.
    """
    keys = calls.select(F.col("conv_id").alias("k"), F.col("call_id").alias("known"))
    match = calls["conv_id"].eqNullSafe(keys["k"]) & (calls["after"] == keys["known"])
    first = calls.join(keys, match, "left").select("conv_id", "call_id", F.col("known").alias("to"))
    state = write_through(first.withColumn("level", F.when(F.col("to").isNull(), 0).otherwise(1).cast("long")), "levels")
    left = state.filter("to is not null").count()
    while left:
        done, going = state.filter("to is null"), state.filter("to is not null")
        other = state.select(F.col("conv_id").alias("k"), F.col("call_id").alias("id"), F.col("to").alias("next"), F.col("level").alias("more"))
        moved = going.join(other, going["conv_id"].eqNullSafe(other["k"]) & (going["to"] == other["id"])).select(
            "conv_id", "call_id", F.col("next").alias("to"), (F.col("level") + F.col("more")).alias("level")
        )
        state = write_through(done.union(moved), "levels")
        before, left = left, state.filter("to is not null").count()
        if left == before:
            break
    return state.select("conv_id", "call_id", F.when(F.col("to").isNull(), F.col("level")).alias("level"))


def _finish(schemas: dict[str, object]):
    """Linked rows -> with valid, error and the canonical JSON of call and result."""
    names = ["conv_id", "call_id", "level", "turn", "name", "copies", "status", "valid", "error", "json"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                out: list[list] = [[], [], []]
                for row in rows.to_pylist():
                    error, value = None, None
                    try:
                        value = json.loads(row["arguments"] if row["arguments"] is not None else "null", parse_constant=_no_constant)
                    except (ValueError, RecursionError):
                        error = "$: no JSON"
                    if error is None:
                        known = row["name"] in schemas
                        error = violation(value, schemas[row["name"]]) if known else "unknown tool"
                    call = {"arguments": value, "id": row["call_id"], "name": row["name"]}
                    if value is None and error == "$: no JSON":
                        call["arguments"] = row["arguments"]
                    result = None if row["status"] == "unanswered" else {"content": row["content"], "turn": row["result_turn"]}
                    out[0].append(error is None)
                    out[1].append(error)
                    out[2].append(canonical({"call": call, "level": row["level"], "result": result}))
                kept = [rows.column(rows.schema.get_field_index(n)) for n in names[:7]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(out[0], pa.bool_()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], names
                )

    return run


def _no_constant(name: str):
    raise ValueError(name)


def link_calls(calls: DataFrame, results: DataFrame, tools: DataFrame) -> DataFrame:
    """conv_id, call_id, level, turn, name, copies, status, valid, error, json: a row for each call's identifier.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON), after (the call_id of the same conversation that it
    follows, or null); ``results``: conv_id, call_id, turn, content; ``tools``: name, schema (JSON schema).

    Calls that repeat an identifier are one row, that with the smallest turn (then name, arguments), counted in
    ``copies``; of several results the one with the smallest turn (then content) is taken. status: linked, unanswered,
    or circular for calls that follow themselves, whose level is null. Calls without an identifier are left out, and
    results that name no call are too; a null conv_id is a conversation like others. Arguments that are no JSON, that
    break the schema, or that are for an unknown tool are invalid, with the first fault; they are kept. A null argument
    is JSON's null. json holds the call with its result, with sorted keys and no white space. Empty calls give no rows.
    """
    size = tools.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("schema")), F.lit(0)).alias("bytes")).first()
    if size["n"] > MOST_TOOLS or size["bytes"] > MOST_SCHEMA_BYTES:
        raise ValueError(f"more than {MOST_TOOLS} tools or {MOST_SCHEMA_BYTES} bytes of schemas")
    schemas = {r["name"]: json.loads(r["schema"] or "true") for r in tools.select("name", "schema").collect() if r["name"] is not None}
    one = calls.filter("call_id is not null").groupBy("conv_id", "call_id")
    one = one.agg(F.min(F.struct("turn", "name", "arguments", "after")).alias("c"), F.count(F.lit(1)).alias("copies"))
    one = write_through(one.select("conv_id", "call_id", "c.turn", "c.name", "c.arguments", "c.after", "copies"), "calls")
    answered = results.filter("call_id is not null").groupBy(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call"))
    answered = answered.agg(F.min(F.struct("turn", "content")).alias("r"))
    placed = levels(one.select("conv_id", "call_id", "after")).select(
        F.col("conv_id").alias("l_conv"), F.col("call_id").alias("l_call"), "level"
    )
    linked = (
        one.join(
            answered.hint("shuffle_hash"), one["conv_id"].eqNullSafe(answered["r_conv"]) & (one["call_id"] == answered["r_call"]), "left"
        )
        .join(placed, F.col("conv_id").eqNullSafe(F.col("l_conv")) & (F.col("call_id") == F.col("l_call")))
        .select(
            "conv_id", "call_id", "level", "turn", "name", "copies",
            F.when(F.col("level").isNull(), "circular").when(F.col("r").isNull(), "unanswered").otherwise("linked").alias("status"),
            "arguments", F.col("r.content").alias("content"), F.col("r.turn").alias("result_turn"),
        )
    )
    kinds = dict(linked.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("conv_id", "call_id", "level", "turn", "name", "copies", "status"))
    return linked.mapInArrow(_finish(schemas), f"{schema}, valid boolean, error string, json string")


# ---- conversations as calls -----------------------------------------------------------------------------------------

TOOLS = [
    ("lookup", {"type": "object", "required": ["query", "turn"], "additionalProperties": False,
                "properties": {"query": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}}),
    ("report", {"type": "object", "required": ["query", "turn"], "additionalProperties": False,
                "properties": {"query": {"type": "string", "maxLength": 1000}, "turn": {"type": "integer", "minimum": 0}}}),
]
#: Characters from which on a request goes to the second tool.
LONG_REQUEST = 300


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of plain conversations: a user's turn calls a tool with its text, the next turn answers.

    A call follows that of two turns before. Null texts are empty; rows without a turn are left out.
    """
    turns = conversations.filter("turn is not null").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text")
    )

    def name(shift):
        return F.concat(F.lit("call_"), (F.col("turn") - shift).cast("string"))

    calls = turns.filter("role = 'user'").select(
        "conv_id",
        name(0).alias("call_id"),
        "turn",
        F.when(F.length("text") < LONG_REQUEST, "lookup").otherwise("report").alias("name"),
        F.to_json(F.struct("turn", F.col("text").alias("query"))).alias("arguments"),
        F.when(F.col("turn") >= 2, name(2)).alias("after"),
    )
    results = turns.filter("role = 'assistant'").select("conv_id", name(1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results
