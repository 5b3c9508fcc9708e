"""Linked calls against plain Python: order, checks and canonical JSON."""

import json

import pytest

from riskloom.llm import chat, queries

SCHEMAS = {"add": {"a": chat.Field("integer"), "b": chat.Field("number", False)}, "say": {"text": chat.Field("string")},
           "set": {"on": chat.Field("boolean")}}
CALLS = "conv long, call_id string, after_id string, name string, arguments map<string,string>"


@pytest.fixture(scope="module")
def linked(spark):
    calls = [
        (1, "x", None, "add", {"b": "2.5e1", "a": "1"}), (1, "y", "x", "say", {"text": 'q"\n\\é\t\U0001f600'}),
        (1, "z", "y", "set", {"on": "true"}), (1, "w", "gone", "set", {"on": "yes"}), (1, "v", "z", "nope", {}),
        (2, "x", "y", "add", {"a": "01"}), (2, "y", "x", "add", {"a": "", "c": "1"}),
        (None, "x", None, "say", {"text": "none"}), (3, None, None, "say", {"text": "no id"}),
        (4, "x", None, "say", {"text": "b"}), (4, "x", None, "say", {"text": "a"}),
    ] + [(9, f"n{i}", f"n{i - 1}", "add", {"a": str(i)}) for i in range(100)]
    results = [(1, "x", "3"), (1, "y", None), (1, "q", "lost"), (None, "x", "r"), (4, "x", "2"), (4, "x", "1")]
    frame = chat.link_calls(spark.createDataFrame(calls, CALLS).repartition(4), spark.createDataFrame(results, "conv long, call_id string, content string"), SCHEMAS)
    return {(r.conv, r.call_id): r for r in frame.collect()}


def test_levels(linked):
    assert [linked[1, c].level for c in "xyzwv"] == [0, 1, 2, 0, 3]
    assert linked[2, "x"].level is None and linked[2, "y"].level is None  # a ring
    assert [linked[9, f"n{i}"].level for i in range(100)] == list(range(100))


def test_links_and_checks(linked):
    assert {k for k, r in linked.items() if r.linked} == {(1, "x"), (1, "y"), (None, "x"), (4, "x")}
    assert (None, None) not in linked and len(linked) == 109
    assert linked[1, "x"].valid and linked[1, "w"].problems == "on is no boolean"
    assert linked[1, "v"].problems == "unknown tool" and linked[2, "x"].problems == "a is no integer"
    assert linked[2, "y"].problems == "a is missing; unknown arguments"


def test_canonical_json(linked):
    assert linked[1, "x"].line == '{"arguments":{"a":1,"b":2.5e1},"id":"x","name":"add","result":"3"}'
    assert linked[1, "y"].line == json.dumps({"arguments": {"text": 'q"\n\\é\t\U0001f600'}, "id": "y", "name": "say", "result": None},
                                             separators=(",", ":"), ensure_ascii=False)
    assert linked[1, "z"].line == '{"arguments":{"on":true},"id":"z","name":"set"}'
    assert json.loads(linked[4, "x"].line) == {"arguments": {"text": "a"}, "id": "x", "name": "say", "result": "1"}
    for r in linked.values():
        keys = list(json.loads(r.line))
        assert keys == sorted(keys)


def test_empty_and_odd_turns(spark):
    turns = spark.createDataFrame([(1, 0, "user", None), (1, None, "user", "x"), (1, 1, "assistant", "a"), (2, 5, None, "y"), (None, 0, "user", "u")],
                                  "conv_id long, turn long, role string, text string").selectExpr("*", "1 as name", "2 as line")
    rows = chat.link_calls(*chat.conversation_calls(turns), chat.REPLY).collect()
    assert sorted((str(r.conv), r.linked, r.valid) for r in rows) == [("1", True, False), ("None", False, True)]
    assert chat.link_calls(*chat.conversation_calls(turns.limit(0)), chat.REPLY).count() == 0


def test_query(spark):
    rows = queries.op8_chat_calls(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(json.loads(r.line)["id"] == r.call_id for r in rows)
