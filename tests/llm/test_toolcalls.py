"""Tool calls: linking, order, validation, canonical JSON."""

import json
import random

import pytest

from pulsegrid.llm import toolcalls as t

SCHEMA = "conv_id long, turn long, role string, text string"


def call(*calls):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments", "depends_on"), c)) for c in calls]})


def result(i, content="r"):
    return json.dumps({"tool_call_id": i, "content": content})


def linked(spark, rows, **tools):
    return [r for r in t.link(spark.createDataFrame(rows, SCHEMA), tools or t.TOOLS).orderBy("conv_id", "turn", "part").collect()]


def test_statuses(spark):
    ok = {"query": "q"}
    rows = [
        (1, 0, "user", "hello {"), (1, 1, "assistant", call(("a", "search", ok), ("b", "search", ok), ("a", "search", ok), (None, "search", ok))),
        (1, 2, "tool", result("a")), (1, 3, "tool", result("a")), (1, 4, "tool", result("z")),
        (2, 0, "tool", result("a")), (2, 1, "assistant", call(("a", "search", ok))), (None, 0, "assistant", call(("n", "search", ok))), (None, 1, "tool", result("n")),
    ]
    out = [(r["conv_id"], r["turn"], r["kind"], r["status"]) for r in linked(spark, rows)]
    assert out == [
        (None, 0, "call", "linked"), (None, 1, "result", "linked"), (1, 0, "message", "message"), (1, 1, "call", "linked"), (1, 1, "call", "unanswered"), (1, 1, "call", "duplicate"), (1, 1, "call", "unnamed"),
        (1, 2, "result", "linked"), (1, 3, "result", "duplicate"), (1, 4, "result", "orphan"), (2, 0, "result", "early"), (2, 1, "call", "early"),
    ]


def test_levels(spark):
    ok = {"query": "q"}
    chain = [(f"c{i}", "search", ok, [f"c{i - 1}"] if i else []) for i in range(6)]
    more = [("d", "search", ok, ["c0", "c3"]), ("x", "search", ok, ["y"]), ("y", "search", ok, ["x"]), ("w", "search", ok, ["x"]), ("u", "search", ok, ["nowhere"]), ("s", "search", ok, ["s"])]
    out = {r["call_id"]: (r["level"], r["errors"]) for r in linked(spark, [(1, 0, "assistant", call(*chain, *more)), (2, 0, "assistant", call(("c3", "search", ok)))]) if r["conv_id"] == 1}
    assert {k: v[0] for k, v in out.items()} == {**{f"c{i}": i for i in range(6)}, "d": 4, "x": None, "y": None, "w": None, "u": None, "s": None}
    assert out["x"][1] == ["dependency"] and out["d"][1] == []


@pytest.mark.parametrize(
    "value,wanted",
    [({"query": "x"}, []), ({"query": "x", "limit": 3}, []), ({"query": "x", "limit": 3.0}, []), ({}, ["$.query:required"]), ({"query": ""}, ["$.query:minLength"]), ({"query": 1, "limit": True, "z": 1}, ["$.limit:type", "$.query:type", "$.z:additional"]), ("text", ["$:type"]), (None, ["$:type"])],
)
def test_validation(value, wanted):
    assert t.violations(value, t.TOOLS["search"]) == wanted


def test_nested_schemas():
    schema = {"type": "array", "items": {"type": "object", "properties": {"k": {"enum": [1, "b"]}}}}
    assert t.violations([{"k": 1}, {"k": 2}, 3], schema) == ["$[1].k:enum", "$[2]:type"]


def test_canonical_json():
    assert t.canonical({"b": [1.0, 0.5, float("nan")], "a": "é\n", "c": {"z": None, "y": True}}) == '{"a":"é\\n","b":[1,0.5,null],"c":{"y":true,"z":null}}'


def test_rows_are_canonical_json(spark):
    rows = [(1, 0, "user", 'say "hi"\n é\\'), (1, 1, "assistant", call(("a", "search", '{"query": "x", "limit": 2}'), ("b", "nothing", {"k": 1}))), (1, 2, "tool", result("a", {"z": 1, "a": [1.5]})), (2, None, None, None), (3, 0, "assistant", '{"tool_calls": [broken'), (3, 1, "assistant", '{"tool_calls": [1]}')]
    for r in linked(spark, rows):
        found = json.loads(r["json"])
        assert r["json"] == json.dumps(found, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert (found["kind"], found["call_id"], found["status"], found["turn"]) == (r["kind"], r["call_id"], r["status"], r["turn"])


def test_plain_dialogue(spark, small):
    talk = spark.read.parquet(f"{small}/conversations.parquet")
    rows = {(r["conv_id"], r["turn"]): r for r in talk.collect()}
    out = t.report(talk).collect()
    assert len(out) == len(rows)
    for r in out:
        at, before, after = (rows.get((r["conv_id"], r["turn"] + k)) for k in (0, -1, 1))
        role = at["role"]
        if role == "user":
            assert (r["kind"], r["status"]) == ("call", "linked" if after and after["role"] == "assistant" else "unanswered")
            assert json.loads(r["json"])["body"] == {"question": at["text"], "turn": at["turn"]}
        elif role == "assistant":
            assert (r["kind"], r["status"]) == ("result", "linked" if before and before["role"] == "user" else "orphan")
        else:
            assert r["kind"] == "message"


def test_odd_rows(spark):
    odd = spark.createDataFrame([(1, 0, "user", None, "own"), (1, 0, "user", None, "own"), (None, None, None, "", "own"), (2, 0, "user", "x " * 50_000, "own")], SCHEMA + ", status string")
    assert t.report(odd).count() == 4 and t.report(odd.limit(0)).count() == 0


def test_json_that_cannot_be_walked_or_written(spark):
    deep = "[" * 3000 + "]" * 3000
    rows = [(1, 0, "assistant", '{"tool_calls": [{"id": "a", "name": "search", "arguments": {"query": ' + deep + "}}]}"), (1, 1, "tool", '{"tool_call_id": "a", "content": ' + deep + "}"),
            (2, 0, "assistant", '{"tool_calls": [{"id": "b", "name": "search", "arguments": {"query": "x", "limit": ' + "9" * 400 + "}}]}"),
            (3, 0, "assistant", '{"tool_calls": [{"id": "c\\ud800", "name": "search\\udfff", "arguments": {"query": "\\ud800"}, "depends_on": ["\\ud801"]}]}'), (3, 1, "tool", '{"tool_call_id": "c\\ud800", "content": "\\ud800x"}')]
    out = linked(spark, rows)
    kinds = {(r["conv_id"], r["turn"]): (r["kind"], r["status"]) for r in out}
    assert kinds == {(1, 0): ("message", "message"), (1, 1): ("message", "message"), (2, 0): ("call", "unanswered"), (3, 0): ("call", "linked"), (3, 1): ("result", "linked")}
    assert all(json.loads(r["json"]) for r in out)


@pytest.mark.parametrize("most", [t.ONE_TASK, 0])
def test_levels_against_the_longest_chain(spark, most):
    rng = random.Random(6)
    rows, wanted = [], {}
    for conv in (None, 1, 2):
        needs = {i: sorted(rng.sample(range(i), min(i, rng.randrange(3)))) for i in range(30)}
        needs[30], needs[31], needs[32] = [31], [30], [99]
        needs[33] = [3, 32]
        level = {}
        for i in range(30):
            level[i] = 1 + max((level[k] for k in needs[i]), default=-1)
        wanted |= {(conv, str(i)): n for i, n in level.items()}
        rows += [(conv, str(i), [str(k) for k in n]) for i, n in needs.items()]
    found = t.levels(spark.createDataFrame(rows, "conv_id long, call_id string, depends_on array<string>"), most).collect()
    assert len(found) == len(wanted) and {(r["conv_id"], r["call_id"]): r["level"] for r in found} == wanted


def test_real_calls_stay_as_they_are(spark):
    rows = [(1, 0, "user", "hello"), (1, 1, "assistant", call(("a", "search", {"query": "x"}))), (1, 2, "tool", result("a", 1)), (1, 3, "assistant", "there"), (2, 0, "user", "one"), (2, 1, "assistant", "two"), (2, 2, "user", "three"), (2, 3, "assistant", "four")]
    out = {(r["conv_id"], r["turn"]): (r["kind"], r["call_id"], r["status"], r["level"]) for r in t.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {(1, 0): ("call", "turn-1", "unanswered", 0), (1, 1): ("call", "a", "linked", 0), (1, 2): ("result", "a", "linked", 0), (1, 3): ("result", "turn-3", "orphan", None),
                   (2, 0): ("call", "turn-1", "linked", 0), (2, 1): ("result", "turn-1", "linked", 0), (2, 2): ("call", "turn-3", "linked", 1), (2, 3): ("result", "turn-3", "linked", 1)}
