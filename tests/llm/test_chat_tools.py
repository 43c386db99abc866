import json
import random

import pytest

from topicloom.llm import chat_tools as c

SCHEMA = {"add": {"type": "object", "required": ["x"], "additionalProperties": False, "properties": {"x": {"type": "number", "minimum": 0}, "tags": {"type": "array", "items": {"type": "string", "enum": ["a", "b"]}}}}}
CALLS = "conv_id long, call_id string, turn long, name string, arguments string, after string, level int"
RESULTS = "conv_id long, call_id string, turn long, content string"


def run(spark, calls, results):
    rows = c.link_calls(spark.createDataFrame([(*r, 0) for r in calls], CALLS), spark.createDataFrame(results, RESULTS), SCHEMA).collect()
    return {(r.conv_id, r.call_id, r.turn): r for r in rows}, len(rows)


def test_links_levels_and_errors(spark):
    calls = [
        (1, "a", 0, "add", '{"x": 1.5, "tags": ["b", "a"]}', None), (1, "b", 1, "add", '{"x": -1}', "a"), (1, "c", 2, "add", '{"tags": [], "x": 2}', "b"),
        (1, "d", 3, "add", "not json", "nowhere"), (1, "e", 4, "none", "{}", "f"), (1, "f", 5, "add", None, "e"), (2, "a", 0, "add", '{"x": true}', None),
        (None, "a", 0, "add", '{"y": 1, "x": 1}', None), (2, None, 1, "add", '{"x": NaN}', None), (2, "s", 2, "add", '{"x": 1, "tags": ["q"]}', "s"),
    ]
    results = [(1, "a", 9, "late"), (1, "a", 8, "z"), (1, "a", 8, "early"), (1, "zzz", 1, "lost"), (None, "a", 1, "never"), (2, "a", 1, None)]
    got, n = run(spark, calls, results)
    assert n == len(calls)
    a = got[1, "a", 0]
    assert (a.level, a.n_results, a.error) == (0, 3, None)
    assert a.json == '{"arguments":{"tags":["b","a"],"x":1.5},"error":null,"id":"a","name":"add","result":"early"}'
    assert [got[1, k, t].level for k, t in (("b", 1), ("c", 2), ("d", 3), ("e", 4), ("f", 5))] == [1, 2, 0, None, None]
    errors = {k: r.error for k, r in got.items()}
    assert errors[1, "b", 1] == "$.x: limit" and errors[1, "d", 3] == errors[1, "f", 5] == errors[2, None, 1] == "$: not JSON"
    assert errors[1, "e", 4] == "$: unknown tool" and errors[2, "a", 0] == "$.x: not number" and errors[None, "a", 0] == "$.y: unknown"
    assert errors[2, "s", 2] == "$.tags[0]: not in enum" and got[2, "s", 2].level is None
    assert got[None, "a", 0].n_results == 0 and json.loads(got[2, "a", 0].json)["result"] is None


def test_long_chains_and_repeated_calls(spark):
    calls = [(7, f"k{i}", i, "add", '{"x": 1}', f"k{i - 1}" if i else None) for i in range(200)] + [(7, "k5", 5, "add", '{"x": 1}', "k4")]
    rows = c.link_calls(spark.createDataFrame([(*r, 0) for r in calls], CALLS), spark.createDataFrame([], RESULTS), SCHEMA).collect()
    assert len(rows) == 201 and all(r.level == r.turn for r in rows)


def longest(edges, names):
    """Longest ways by hand; None for circles and what waits for them."""
    level, left = {}, set(names)
    while free := {v for v in left if all(u not in left for w, u in edges if w == v)}:
        level |= {v: max((level[u] + 1 for w, u in edges if w == v and u in level), default=0) for v in free}
        left -= free
    return level | dict.fromkeys(left)


@pytest.mark.parametrize("seed", [1, 2])
def test_levels_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    calls, want = [], {}
    for conv in range(12):
        n = rng.randrange(1, 14)
        names = [f"{conv}:{i}" for i in range(n)]
        circle = conv % 3 == 0
        edges = {(names[i], names[rng.randrange(n if circle else i)]) for i in range(n) for _ in range(rng.randrange(3)) if circle or i}
        calls += [(conv, v, None) for v in names] + [(conv, v, u) for v, u in edges]
        want |= {f"{len(str(conv))}:{conv}{v}": x for v, x in longest(edges, names).items()}
    waits = spark.createDataFrame(calls[1::2] + [(99, "no", "call")], "conv_id long, call_id string, after string")
    own = spark.createDataFrame([(c, v, None) for c, v, _ in calls] + calls[::2], "conv_id long, call_id string, after string")
    assert {r.key: r.level for r in c.levels(own, waits).collect()} == want


def test_several_dependencies_take_the_longest(spark):
    edges = [(1, "c", "b"), (1, "b", "a"), (1, "d", "a"), (1, "d", "c"), (1, "e", "d"), (1, "x", "y"), (1, "x", "z"), (1, "y", "x"), (1, "y", "z"), (1, "w", "x"), (1, "a", None), (1, "z", None)]
    got = c.levels(spark.createDataFrame(edges, "conv_id long, call_id string, after string")).collect()
    assert {r.key[3:]: r.level for r in got} == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4, "z": 0, "x": None, "y": None, "w": None}


def test_schema_words():
    error = lambda value, **schema: c.schema_error(value, schema)
    assert error(None, type=["string", "null"]) is None and error(1, type=["string", "null"]) == "$: not string or null"
    assert error(1.0, type="integer") is None and error(1.5, type="integer") and error(True, type="integer")
    assert error(True, enum=[1]) and error(1.0, enum=[1]) is None and error([True], const=[1]) and error({"a": 1}, const={"a": 1.0}) is None
    assert error("abc", pattern="^b") == "$: pattern" and error("abc", pattern="b") is None
    assert error([], minItems=1) and error([1, 2], maxItems=1) and error([1], minItems=1, maxItems=1) is None
    assert error(3, anyOf=[{"type": "string"}, {"minimum": 3}]) is None and error(2, anyOf=[{"type": "string"}, {"minimum": 3}])
    for bad in ({"$ref": "#"}, {"type": "text"}, {"properties": {"x": {"oneOf": []}}}, {"items": True}):
        with pytest.raises(ValueError):
            c.check_schema(bad)


def test_odd_arguments_and_null_keys(spark):
    odd = ["[" * 5000 + "]" * 5000, '{"x": ' + "[" * 600 + "]" * 600 + "}", '{"x": 1e999}', '{"x": 1, "\\ud800": 2}', '{"x": ' + "9" * 5000 + "}", "", '{"x": 1}' + " " * 500_000]
    calls = [(i, "a", 0, "add", x, None) for i, x in enumerate(odd)] + [(None, "a", 1, "add", "{}", "a")] * 3 + [(5, None, 1, "add", "{}", "a")] * 2
    got, n = run(spark, calls, [(0, "a", 1, ""), (None, "a", 1, "x"), (3, "b", 2, "lost")])
    assert n == len(calls)
    errors = [got[i, "a", 0].error for i in range(len(odd))]
    assert errors == ["$: nested too deeply"] * 2 + ["$: not JSON", "$.\\ud800: unknown", "$: not JSON", "$: not JSON", None]
    assert json.loads(got[3, "a", 0].json)["arguments"] == {"x": 1, "\ud800": 2} and json.loads(got[0, "a", 0].json)["result"] == ""
    lost = c.unmatched_results(spark.createDataFrame([(*r, 0) for r in calls], CALLS), spark.createDataFrame([(0, "a", 1, ""), (None, "a", 1, "x"), (3, "b", 2, "lost")], RESULTS))
    assert sorted(r.content for r in lost.collect()) == ["lost", "x"]
    none = c.link_calls(spark.createDataFrame([], CALLS), spark.createDataFrame([(1, "a", 1, "x")], RESULTS), SCHEMA)
    assert none.count() == 0
