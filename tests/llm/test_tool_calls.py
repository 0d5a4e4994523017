import json
import random

import pytest

from tallyhouse.llm import tool_calls as t
from tallyhouse.llm.common import read_table

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, after string, level int, r string"
RESULTS = "conv_id long, call_id string, turn long, content string, copies int"
TOOL = {
    "type": "object", "required": ["n"], "additionalProperties": False,
    "properties": {"n": {"type": "integer", "minimum": 1, "maximum": 9}, "s": {"type": ["string", "null"], "pattern": "^a"},
                   "l": {"type": "array", "items": {"enum": [1, "x"]}, "maxItems": 2}},
}


def tools(spark):
    return spark.createDataFrame([("f", json.dumps(TOOL)), ("any", None)], "name string, schema string")


def test_violations():
    good = [{"n": 1}, {"n": 9, "s": None}, {"n": 2.0, "s": "ab", "l": [1, "x"]}, {"n": 3, "l": []}]
    bad = [None, [], {}, {"n": 0}, {"n": 10}, {"n": True}, {"n": 1.5}, {"n": 1, "s": "b"}, {"n": 1, "l": [1, 1, 1]}, {"n": 1, "l": [2]}, {"n": 1, "z": 1}]
    assert [t.violation(x, TOOL) for x in good] == [None] * len(good)
    assert all(t.violation(x, TOOL) for x in bad)


def test_canonical():
    assert t.canonical({"b": [1, 2.5, None], "a": 'é"\\\n\u0001'}) == '{"a":"é\\"\\\\\\n\\u0001","b":[1,2.5,null]}'


def test_awkward(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", 0, "f", '{"n": 1}', None, 1, "x"), (1, "b", 2, "f", '{"n": 0}', "a", 1, "x"), (1, "c", 4, "any", "{not json", "b", 1, "x"),
            (1, "c", 4, "any", "{not json", "b", 1, "x"), (2, "a", 0, None, None, "gone", 1, "x"), (None, "a", 1, "any", None, None, 1, "x"),
            (3, "p", 0, "any", "1", "q", 1, "x"), (3, "q", 1, "any", "NaN", "p", 1, "x"), (3, "r", 2, "any", "2", "q", 1, "x"),
            (4, None, 0, "f", "{}", None, 1, "x"), (5, "s", 0, "any", '"\\ud83d\\ude00"', "s", 1, "x"), (6, "e", None, "any", "{}", "", 1, "x"),
        ],
        CALLS,
    )
    results = spark.createDataFrame(
        [(1, "a", 3, "late", 1), (1, "a", 1, "first", 1), (1, "zz", 1, "orphan", 1), (None, "a", 2, None, 1), (1, None, 1, "none", 1)], RESULTS
    )
    rows = {(r.conv_id, r.call_id): r for r in t.link_calls(calls, results, tools(spark)).collect()}
    assert set(rows) == {(1, "a"), (1, "b"), (1, "c"), (2, "a"), (None, "a"), (3, "p"), (3, "q"), (3, "r"), (5, "s"), (6, "e")}
    assert [rows[1, x].level for x in "abc"] == [0, 1, 2] and rows[2, "a"].level == 0
    assert [rows[1, x].status for x in "abc"] == ["linked", "unanswered", "unanswered"] and rows[1, "c"].copies == 2
    assert [rows[k].status for k in ((3, "p"), (3, "q"), (3, "r"), (5, "s"))] == ["circular"] * 4 and rows[3, "p"].level is None
    assert [rows[1, x].valid for x in "abc"] == [True, False, False] and rows[2, "a"].error == "unknown tool"
    assert json.loads(rows[1, "a"].json) == {
        "call": {"arguments": {"n": 1}, "id": "a", "name": "f"}, "level": 0, "result": {"content": "first", "turn": 1},
    }
    assert rows[3, "q"].error == "$: no JSON" and json.loads(rows[None, "a"].json)["result"] == {"content": None, "turn": 2}


def test_empty(spark):
    calls, results = spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS)
    assert t.link_calls(calls, results, tools(spark)).collect() == []
    assert t.link_calls(calls, results, tools(spark).limit(0)).collect() == []


def test_too_many_tools(spark, monkeypatch):
    monkeypatch.setattr(t, "MOST_TOOLS", 1)
    with pytest.raises(ValueError):
        t.link_calls(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), tools(spark))


def test_levels_of_long_chains_and_trees(spark):
    draw = random.Random(3)
    after = {i: i - 1 for i in range(1, 700)} | {0: None} | {i: draw.randrange(i) for i in range(700, 1200)}
    after |= {2000 + i: 2000 + (i + 1) % 50 for i in range(50)} | {2100: 2003}
    shuffled = [(7, f"c{i}", None if a is None else f"c{a}") for i, a in after.items()]
    draw.shuffle(shuffled)
    found = {int(r.call_id[1:]): r.level for r in t.levels(spark.createDataFrame(shuffled, "conv_id long, call_id string, after string")).collect()}
    expected = {0: 0}
    for i in range(1, 1200):
        expected[i] = expected[after[i]] + 1
    expected |= {i: None for i in after if i >= 2000}
    assert found == expected


def test_conversations(spark):
    talk = read_table(spark, "/root/testdata/sf0.01", "conversations")
    rows = t.link_calls(*t.calls_of(talk), spark.createDataFrame([(n, json.dumps(s)) for n, s in t.TOOLS], "name string, schema string")).collect()
    turns = {(r.conv_id, r.turn): r for r in talk.collect()}
    users = {k for k, r in turns.items() if r.role == "user"}
    assert {(r.conv_id, r.turn) for r in rows} == users
    for r in rows:
        level, turn = 0, r.turn
        while (r.conv_id, turn - 2) in users:
            level, turn = level + 1, turn - 2
        value = json.loads(r.json)
        own = turns[r.conv_id, r.turn].text or ""
        answer = turns.get((r.conv_id, r.turn + 1))
        assert r.level == level and r.copies == 1 and value["call"]["arguments"] == {"query": own, "turn": r.turn}
        assert (value["result"] or {}).get("content") == (answer.text if answer and answer.role == "assistant" else None)
        assert r.json == t.canonical(value)
