import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tarnlake.llm import chat

TOOLS = {"search": {"query": ("string", True), "limit": ("integer", False), "exact": ("boolean", False)},
         "sum": {"terms": ("array", True), "by": ("object", False), "scale": ("number", False)}, "now": {}}
SCHEMA = "conv_id long, turn int, role string, text string, call_id string, tool string, arguments string, needs array<string>, slot int, level int"


def message(conv, turn, role, text=None, call_id=None, tool=None, arguments=None, needs=()):
    return conv, turn, role, text, call_id, tool, arguments, list(needs), -1, -1


def linked(spark, rows):
    return chat.link(spark.createDataFrame(rows, SCHEMA), TOOLS).collect()


@pytest.mark.parametrize("tool, arguments, errors", [
    ("search", '{"query": "x"}', []),
    ("search", '{"limit": 3, "query": "x", "exact": true}', []),
    ("search", '{"query": null}', ["missing query"]),
    ("search", '{"query": 7, "limit": "3", "exact": 0}', ["type of exact", "type of limit", "type of query"]),
    ("search", '{"query": "x", "limit": 1.5, "zeta": 1, "alpha": 2}', ["type of limit", "unknown field alpha", "unknown field zeta"]),
    ("search", '{"query": "x", "limit": 12345678901234567890}', []),
    ("sum", '{"terms": [], "by": {}, "scale": 2}', []),
    ("sum", '{"terms": {}, "by": [1], "scale": "2"}', ["type of by", "type of scale", "type of terms"]),
    ("now", "{}", []),
    ("now", '{"x": null}', ["unknown field x"]),
    ("now", "[1]", ["no JSON object"]),
    ("now", '{"a": 1, "a": 2}', ["no JSON object"]),
    ("now", '{"a"', ["no JSON object"]),
    ("now", None, ["no JSON object"]),
    ("other", "{}", ["unknown tool"]),
    (None, "{}", ["unknown tool"]),
])
def test_arguments_are_held_against_the_schema(spark, tool, arguments, errors):
    out = linked(spark, [message(1, 0, "tool_call", call_id="c", tool=tool, arguments=arguments)])
    assert out[0]["errors"] == errors
    assert out[0]["status"] == ("invalid" if errors else "no result")


def test_links_and_their_faults(spark):
    rows = [
        message(1, 0, "user", "hi"), message(1, 1, "tool_call", call_id="a", tool="now", arguments="{}"),
        message(1, 2, "tool_result", "12:00", "a"), message(1, 3, "tool_result", "12:01", "a"),
        message(1, 4, "tool_call", call_id="a", tool="now", arguments="{}"), message(1, 5, "tool_result", "?", "b"),
        message(1, 6, "tool_call", call_id=None, tool="now", arguments="{}"), message(1, 7, "tool_result", "?", None),
        message(2, 1, "tool_call", call_id="b", tool="now", arguments="{}"), message(None, 1, "tool_call", call_id="a", tool="now", arguments="{}"),
    ]
    got = {(r["conv_id"], r["turn"]): r["status"] for r in linked(spark, rows)}
    assert got == {(1, 0): "ok", (1, 1): "ok", (1, 2): "ok", (1, 3): "duplicate result", (1, 4): "duplicate id", (1, 5): "no call",
                   (1, 6): "no id", (1, 7): "no id", (2, 1): "no result", (None, 1): "no id"}


def brute_places(calls):
    """(slot, level) by id, from {id: (turn, result_turn or None, needs)}."""
    done = {}
    while True:
        ready = {c for c, (_, _, needs) in calls.items() if c not in done and all(n in done for n in needs if n in calls)}
        if not ready:
            return done
        new = {}
        for c in ready:
            turn, _, needs = calls[c]
            known = [n for n in needs if n in calls]
            until = [max(done[n][0], calls[n][0], calls[n][1] or 0) for n in known]
            new[c] = (max([turn, *until]), 1 + max(done[n][1] for n in known) if known else 0)
        done |= new


def test_calls_are_placed_after_what_they_need(spark):
    calls = {"a": (5, 9, []), "b": (1, 2, ["a"]), "c": (2, None, ["b", "a", "gone"]), "d": (3, 4, []), "x": (1, 2, ["y"]),
             "y": (2, 3, ["x"]), "z": (7, 8, ["y", "d"]), "self": (1, 2, ["self"]), "e": (0, 1, ["d", "d"])}
    rows = [message(1, t, "tool_call", call_id=c, tool="now", arguments="{}", needs=n) for c, (t, _, n) in calls.items()]
    rows += [message(1, r, "tool_result", "r", c) for c, (_, r, _) in calls.items() if r is not None]
    rows += [message(2, 3, "tool_call", call_id="b", tool="now", arguments="{}", needs=["a"])]
    out = [r for r in linked(spark, rows) if r["role"] == "tool_call" and r["conv_id"] == 1]
    want = brute_places(calls)
    assert {r["call_id"]: (r["slot"], r["level"]) for r in out if r["status"] != "cycle"} == want
    assert {r["call_id"] for r in out if r["status"] == "cycle"} == {"x", "y", "z", "self"} == set(calls) - set(want)


def test_a_long_chain(spark):
    """Needs against the order of turns, results in between, in far fewer rounds than calls."""
    n = 400
    calls = {f"c{k}": (n - k if k % 5 else k, 2 * k if k % 3 == 0 else None, [f"c{k - 1}"]) for k in range(n)}
    rows = [message(1, t, "tool_call", call_id=c, tool="now", arguments="{}", needs=need) for c, (t, _, need) in calls.items()]
    rows += [message(1, r, "tool_result", "r", c) for c, (_, r, _) in calls.items() if r is not None]
    out = {r["call_id"]: (r["slot"], r["level"]) for r in linked(spark, rows) if r["role"] == "tool_call"}
    assert out == brute_places(calls)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_needs(spark, seed):
    rng = random.Random(seed)
    calls = {}
    for k in range(120):
        needs = [f"c{rng.randrange(max(1, k - 15), k + 1)}" for _ in range(rng.choice([0, 1, 1, 1, 1, 2, 3]))] if k > 1 else []
        if rng.random() < 0.02:
            needs.append(f"c{rng.randrange(120)}")
        calls[f"c{k}"] = (rng.randrange(200), rng.choice([None, rng.randrange(200)]), needs)
    rows = [message(1, t, "tool_call", call_id=c, tool="now", arguments="{}", needs=need) for c, (t, _, need) in calls.items()]
    rows += [message(1, r, "tool_result", "r", c) for c, (_, r, _) in calls.items() if r is not None]
    out = [r for r in linked(spark, rows) if r["role"] == "tool_call"]
    want = brute_places(calls)
    assert {r["call_id"]: (r["slot"], r["level"]) for r in out if r["status"] != "cycle"} == want
    assert {r["call_id"] for r in out if r["status"] == "cycle"} == set(calls) - set(want)


def test_a_cycle_beside_many_rounds(spark):
    """Calls on cycles, and those that need one, over more rounds than a long has bits."""
    n = 70
    calls = {f"c{k}": (k, None, [f"c{j}" for j in (k - 1, k - 2) if j >= 0]) for k in range(n)}
    calls |= {"self": (1, None, ["self"]), "x": (1, None, ["y"]), "y": (1, None, ["z"]), "z": (1, None, ["x"]), "w": (1, None, ["c0", "x"])}
    rows = [(1, c, t, r, needs) for c, (t, r, needs) in calls.items()]
    schema = "conv_id long, call_id string, turn long, result_turn long, needs array<string>"
    out = {r["call_id"]: (r["slot"], r["level"]) for r in chat.place(spark.createDataFrame(rows, schema)).collect()}
    assert out == brute_places(calls) and len(out) == n


def test_many_successive_calls_with_two_needs(spark):
    """Hundreds of calls that each need the two before, in and against the order of turns: a few rounds, not hundreds."""
    n = 400
    calls = {f"c{k}": (k, None, [f"c{j}" for j in (k - 1, k - 2) if j >= 0]) for k in range(n)}
    back = {f"d{k}": (n - k, k if k % 7 == 0 else None, [f"d{j}" for j in (k - 1, k - 2) if j >= 0]) for k in range(n)}
    rows = [(v, c, t, r, needs) for v, part in ((1, calls), (2, back)) for c, (t, r, needs) in part.items()]
    schema = "conv_id long, call_id string, turn long, result_turn long, needs array<string>"
    start = time.time()
    out = chat.place(spark.createDataFrame(rows, schema)).collect()
    assert time.time() - start < 30
    assert {r["call_id"]: (r["slot"], r["level"]) for r in out} == brute_places(calls) | brute_places(back)


@pytest.mark.parametrize("per_slice", [3, 17])
def test_slices_change_nothing(spark, per_slice):
    rng = random.Random(per_slice)
    calls = {f"c{k}": (rng.choice([5, k, 200 - k]), rng.choice([None, rng.randrange(200)]),
                       [f"c{rng.randrange(max(1, k - 6), k + 1)}" for _ in range(rng.choice([0, 1, 1, 2]))] if k > 1 else []) for k in range(60)}
    calls |= {f"t{k}": (7, None, [f"t{k - 1}"] if k else []) for k in range(40)}              # many at one turn
    rows = [(9, c, t, r, needs) for c, (t, r, needs) in calls.items()]
    schema = "conv_id long, call_id string, turn long, result_turn long, needs array<string>"
    out = chat.place(spark.createDataFrame(rows, schema), per_slice).collect()
    assert {r["call_id"]: (r["slot"], r["level"]) for r in out} == brute_places(calls)


NESTED = {"f": {
    "user.name": ("string", True), "it's": ("integer", False), "mode": (["on", "off"], True), "ids": (("array", "integer"), False),
    "where": ({"city": ("string", True), "at": ({"lat": ("number", True)}, False)}, False)}}


@pytest.mark.parametrize("arguments, errors", [
    ('{"user.name": "x", "mode": "on"}', []),
    ('{"user": {"name": "x"}, "mode": "on"}', ["missing user.name", "unknown field user"]),
    ('{"user.name": "x", "it\'s": "3", "mode": "maybe"}', ["type of it's", "value of mode"]),
    ('{"user.name": "x", "mode": 1, "ids": [1, "2"]}', ["type of ids", "type of mode"]),
    ('{"user.name": "x", "mode": "off", "ids": []}', []),
    ('{"user.name": "x", "mode": "off", "ids": [1, 2], "where": {"city": "b", "at": {"lat": 1.5}}}', []),
    ('{"user.name": "x", "mode": "off", "where": {"at": {"lat": "n", "lon": 2}, "zip": 1}}',
     ["missing where.city", "type of where.at.lat", "unknown field where.at.lon", "unknown field where.zip"]),
    ('{"user.name": "x", "mode": "off", "where": [1]}', ["type of where"]),
])
def test_nested_schemas_items_and_enumerations(spark, arguments, errors):
    row = spark.createDataFrame([("f", arguments)], "tool string, arguments string")
    assert row.select(chat.argument_errors(NESTED, F.col("tool"), F.col("arguments")).alias("e")).first()["e"] == errors


def test_json_is_canonical(spark):
    text = 'quote " slash \\ / tab \t line \n umlaut ü 日本 \u0001'
    rows = [message(1, 0, "user", text), message(1, 1, "tool_call", call_id="a", tool="search",
                                                  arguments='{ "query": "ü\\u0041", "limit": 3, "b": {"z": [1, {"k": null}], "a": 1.50} }'),
            message(1, 2, "tool_call", call_id='q"', tool="now", arguments='{"broken'), message(1, 3, "assistant", None)]
    got = {r["turn"]: r["json"] for r in linked(spark, rows)}
    assert json.loads(got[0]) == {"role": "user", "text": text}
    assert got[1] == '{"arguments":{"b":{"a":1.5,"z":[1,{"k":null}]},"limit":3,"query":"üA"},"call_id":"a","role":"tool_call","tool":"search"}'
    assert json.loads(got[2]) == {"arguments": '{"broken', "call_id": 'q"', "role": "tool_call", "tool": "now"}
    assert got[3] == '{"role":"assistant"}'


def test_repeated_rows_and_no_rows(spark):
    call = message(1, 1, "tool_call", call_id="a", tool="now", arguments="{}")
    out = linked(spark, [call, call, message(1, 2, "tool_result", "x", "a")])
    assert [r["status"] for r in out] == ["ok", "ok", "ok"]
    assert linked(spark, []) == []
