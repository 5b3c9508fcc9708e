"""Chat formatting: tool calls linked to their results, ordered, checked and written as JSON.

Calls and results meet in a hash join on (conversation, call id). The order is topological: a call's
level is the number of calls that come before it along `after_id`, found by pointer doubling, so
a chain of n calls takes log n joins. Arguments are checked against the schema of the call's tool.
Each linked call becomes one line of canonical JSON: keys in code point order, no white space, whole
numbers and booleans bare, strings escaped as JSON asks. DataFrame functions only.

A conversation is never gathered: every row is one call, whatever the conversation's length."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.sources.scratch import release, written


class Field(NamedTuple):
    """One argument of a tool: its JSON type, and whether it has to be there (and not be empty)."""

    kind: str
    required: bool = True


#: Turns of a conversation as calls: what a user says asks the tool `reply` for the next turn.
REPLY = {"reply": {"text": Field("string"), "turn": Field("integer")}}

_PATTERNS = {
    "integer": r"^-?(0|[1-9][0-9]*)$", "number": r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$",
    "boolean": r"^(true|false)$", "string": r"(?s)^.*$"}


def json_string(value: Column) -> Column:
    """A JSON string literal; null stays null."""
    listed = F.to_json(F.array(value))
    return F.when(value.isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))


def json_object(members: Column) -> Column:
    """Canonical JSON of a map from keys to finished JSON values; null values are left out."""
    keys = F.array_sort(F.map_keys(F.map_filter(members, lambda _, v: v.isNotNull())))
    return F.concat(F.lit("{"), F.array_join(F.transform(keys, lambda k: F.concat(json_string(k), F.lit(":"), members[k])), ","), F.lit("}"))


def problems(name: Column, arguments: Column, schemas: Mapping[str, Mapping[str, Field]]) -> Column:
    """What is wrong with a call, in a fixed order; an empty array if nothing is."""
    found = [F.when(~F.coalesce(name.isin(list(schemas)), F.lit(False)), F.lit("unknown tool"))]
    for tool, fields in schemas.items():
        own = name == tool
        for key, rule in sorted(fields.items()):
            value = arguments[key]
            if rule.required:
                found.append(F.when(own & (value.isNull() | (value == "")), F.lit(f"{key} is missing")))
            found.append(F.when(own & value.isNotNull() & (value != "") & ~value.rlike(_PATTERNS[rule.kind]), F.lit(f"{key} is no {rule.kind}")))
        extra = F.array_except(F.map_keys(arguments), F.array(*map(F.lit, sorted(fields))))
        found.append(F.when(own & (F.size(extra) > 0), F.lit("unknown arguments")))
    return F.array_compact(F.array(*found))


def _typed(name: Column, arguments: Column, schemas: Mapping[str, Mapping[str, Field]]) -> Column:
    """Arguments as finished JSON values: bare where the schema says so and the value is right."""
    bare = [(tool, key, rule.kind) for tool, fields in schemas.items() for key, rule in fields.items() if rule.kind != "string"]

    def value(k: Column, v: Column) -> Column:
        out = json_string(v)
        for tool, key, kind in bare:
            out = F.when((name == tool) & (k == key) & v.rlike(_PATTERNS[kind]), v).otherwise(out)
        return out

    return F.transform_values(arguments, value)


def levels(calls: DataFrame) -> DataFrame:
    """(conv, call_id, level): calls ahead along `after_id`; null if the chain is a ring. An
    `after_id` that names no call of the conversation is no link."""
    known = calls.select(F.col("conv").alias("c"), F.col("call_id").alias("i"))
    state = calls.select("conv", "call_id", "after_id").join(
        known, F.col("conv").eqNullSafe(F.col("c")) & (F.col("after_id") == F.col("i")), "left")
    state = written(state.select("conv", "call_id", F.col("i").alias("to"), F.when(F.col("i").isNotNull(), 1).otherwise(0).cast("bigint").alias("level")), "chat-levels")
    rows = state.count()
    reach = 1
    while reach <= rows and (open_ := state.filter("to IS NOT NULL").limit(1).count()):
        ahead = state.select(F.col("conv").alias("c"), F.col("call_id").alias("i"), F.col("to").alias("next"), F.col("level").alias("more"))
        state = written(state.join(ahead, F.col("conv").eqNullSafe(F.col("c")) & (F.col("to") == F.col("i")), "left").select(
            "conv", "call_id", F.col("next").alias("to"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")), "chat-levels")
        reach *= 2
        if reach > 2 * rows and open_:
            break
    release(calls.sparkSession)
    return state.select("conv", "call_id", F.when(F.col("to").isNull(), F.col("level")).alias("level"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping[str, Field]]) -> DataFrame:
    """(conv, call_id, level, linked, valid, problems, line), one row for each call.

    calls: conv, call_id, after_id, name, arguments (map of strings); results: conv, call_id, content.
    Of repeated ids the call and the result that sort first count. A call without a result is
    not linked; results without a call go; null ids are no ids. No rows give no rows."""
    one = calls.filter("call_id IS NOT NULL").groupBy("conv", "call_id").agg(F.min(F.struct(
        "after_id", "name", F.array_sort(F.map_entries("arguments")).alias("entries"))).alias("s"))
    one = written(one.select("conv", "call_id", "s.after_id", "s.name", F.map_from_entries("s.entries").alias("arguments")), "chat-calls")
    replies = results.filter("call_id IS NOT NULL").groupBy(F.col("conv").alias("rc"), F.col("call_id").alias("ri")).agg(
        F.min(F.struct(F.col("content").isNull().alias("none"), "content")).alias("r"))
    placed = levels(one).withColumnsRenamed({"conv": "lc", "call_id": "li"})
    linked = one.join(replies, F.col("conv").eqNullSafe(F.col("rc")) & (F.col("call_id") == F.col("ri")), "left")
    linked = linked.join(placed, F.col("conv").eqNullSafe(F.col("lc")) & (F.col("call_id") == F.col("li")))
    wrong = problems(F.col("name"), F.col("arguments"), schemas)
    line = json_object(F.create_map(
        F.lit("arguments"), json_object(_typed(F.col("name"), F.col("arguments"), schemas)),
        F.lit("id"), json_string(F.col("call_id")), F.lit("name"), json_string(F.col("name")),
        F.lit("result"), F.when(F.col("ri").isNotNull(), F.coalesce(json_string(F.col("r.content")), F.lit("null")))))
    return linked.select("conv", "call_id", "level", F.col("ri").isNotNull().alias("linked"),
                         (F.size(wrong) == 0).alias("valid"), F.array_join(wrong, "; ").alias("problems"), line.alias("line"))


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of a table of turns (conv_id, turn, role, text): a user's turn is a call of
    `reply`, after the user's turn two before it; the assistant's next turn is its result. Turns
    without a number, and of other roles, are neither; other columns are ignored."""
    def name(turn: Column) -> Column:
        return F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))

    at = turns.filter("turn IS NOT NULL")
    filled = F.map_filter(F.create_map(F.lit("text"), F.col("text"), F.lit("turn"), F.col("turn").cast("string")), lambda _, v: v.isNotNull())
    calls = at.filter("role = 'user'").select(
        F.col("conv_id").alias("conv"), name(F.col("turn")).alias("call_id"), name(F.col("turn") - 2).alias("after_id"),
        F.lit("reply").alias("name"), filled.alias("arguments"))
    results = at.filter("role = 'assistant'").select(
        F.col("conv_id").alias("conv"), name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


CHAT_SQL = """
WITH RECURSIVE users AS (
  SELECT conv_id, turn, min(text) AS text, count(*) > count(text) AS has_null FROM conversations
  WHERE role = 'user' AND turn IS NOT NULL GROUP BY conv_id, turn),
replies AS (
  SELECT conv_id, turn - 1 AS turn, min(text) AS text FROM conversations
  WHERE role = 'assistant' AND turn IS NOT NULL GROUP BY conv_id, turn),
chains AS (
  SELECT u.conv_id, u.turn, 0::BIGINT AS level FROM users u
  WHERE NOT EXISTS (SELECT 1 FROM users p WHERE p.conv_id = u.conv_id AND p.turn = u.turn - 2)
  UNION ALL
  SELECT u.conv_id, u.turn, c.level + 1 FROM chains c JOIN users u ON u.conv_id = c.conv_id AND u.turn = c.turn + 2)
SELECT u.conv_id, u.conv_id || ':' || u.turn AS call_id, c.level, r.turn IS NOT NULL AS linked,
  coalesce(u.text, '') <> '' AS valid, CASE WHEN coalesce(u.text, '') = '' THEN 'text is missing' ELSE '' END AS problems,
  '{"arguments":{' || coalesce('"text":' || to_json(u.text) || ',', '') || '"turn":' || u.turn || '},"id":"' || u.conv_id || ':' || u.turn
    || '","name":"reply"' || CASE WHEN r.turn IS NULL THEN '' ELSE ',"result":' || coalesce(to_json(r.text)::VARCHAR, 'null') END || '}' AS line
FROM users u JOIN chains c USING (conv_id, turn) LEFT JOIN replies r USING (conv_id, turn)
"""
