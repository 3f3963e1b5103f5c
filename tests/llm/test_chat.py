"""Chat formatting: odd rows, a brute-force linker over generated conversations, and canonical forms."""

from __future__ import annotations

import json
import random
import time
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textquarry.llm import chat

COLUMNS = "conv_id bigint, turn int, role string, text string, e int, messages string, conv string, `a.b` int"
SCHEMA = {"type": "object", "properties": {"a": {"type": "integer", "minimum": 1}, "b": {"enum": ["x", "y"]}}, "required": ["a"], "additionalProperties": False}


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "z", "c", 2) for r in rows], COLUMNS)


def test_chats(spark):
    j = json.dumps
    rows = [
        (1, 0, "system", j({"tools": [{"name": "add", "parameters": SCHEMA}]})),
        (1, 2, "assistant", j({"content": "ok", "tool_calls": [{"id": "y", "name": "add", "arguments": {"b": "${x}", "a": 2.0}}, {"id": "x", "name": "add", "arguments": {"a": 0, "q": 1}}]})),
        (1, 1, "user", "hi"),
        (1, 3, "tool", j({"tool_call_id": "x", "content": {"v": [1, 2]}})),
        (1, 4, "tool", j({"tool_call_id": "y", "content": "plain"})),
        (1, 5, "tool", j({"tool_call_id": "y", "content": "again"})),
        (1, 6, "tool", j({"tool_call_id": "zz", "content": "3"})),
        (2, 0, "user", 'é "quote"\n'),
        (2, 0, "user", 'é "quote"\n'),
        (2, None, None, None),
        (3, 0, "assistant", "{not json"),
        (4, 0, "assistant", j({"tool_calls": [{"id": "a", "name": "n", "arguments": {"r": "${b}"}}, {"id": "b", "name": "n", "arguments": {"r": "${a}"}}]})),
        (4, -1, "tool", j({"tool_call_id": "a", "content": "too early"})),
        (None, 1, "user", "x" * 100000),
    ]
    df = conversations(spark, rows)
    got = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    first = json.loads(got[1]["messages"])
    assert [m["role"] for m in first] == ["system", "user", "assistant", "tool", "tool"]
    assert [c["call"]["id"] for c in first[2]["tool_calls"]] == ["x", "y"] and first[2]["tool_calls"][0]["result"] == '{"v": [1, 2]}' and first[2]["tool_calls"][1]["result"] == "plain"
    assert first[2]["tool_calls"][1]["call"]["arguments"] == {"a": 2, "b": "${x}"} and '"a":2,' in got[1]["messages"]
    assert [m["content"] for m in first[3:]] == [rows[5][3], rows[6][3]]
    assert got[1]["problems"] == ["call x: $.a: breaks minimum", "call x: $.q: not allowed", "call y: $.b: not in enum", "result y: answered already", "result zz: answers nothing"]
    assert (got[1]["n_turns"], got[1]["n_calls"], got[1]["n_linked"]) == (7, 2, 2)
    assert json.loads(got[2]["messages"]) == [{"content": 'é "quote"\n', "role": "user"}] * 2 + [{"content": None, "role": None}]
    assert json.loads(got[3]["messages"])[0]["content"] == "{not json"
    assert got[4]["n_linked"] == 0 and sum("cycle" in p for p in got[4]["problems"]) == 2 and json.loads(got[4]["messages"])[0]["content"] == rows[12][3]
    assert len(got[None]["messages"]) > 100000
    assert all(r["messages"] == json.dumps(json.loads(r["messages"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False) for r in got.values())
    assert chat.format_chats(df.limit(0)).count() == 0


def test_rows_that_once_broke_a_task(spark):
    """Odd schemas, numbers, nesting, signs and patterns go through the query; nothing is altered or lost."""
    tool = lambda parameters: json.dumps({"tools": [{"name": "f", "parameters": parameters}]})
    call = lambda arguments: '{"content":"c","tool_calls":[{"id":"1","name":"f","arguments":%s}]}' % arguments
    deep = "[" * 3000 + "]" * 3000
    cases = [
        (tool({"required": True, "type": {"a": 1}, "enum": 3, "items": 5, "properties": [], "minimum": "x"}), call('{"a":1}'), "NaN"),
        (tool({"type": "integer"}), call("9" * 400), "1.0"),
        (tool({"type": "object"}), call('{"a":%s}' % deep), deep),
        (tool({}), call('"\\ud800 x"'), "1e5"),
        (tool({"type": "string", "pattern": "^(a+)+$"}), call('"%s"' % ("a" * 50 + "b")), '{"a":1,"a":2}'),
        (tool({"type": "string", "pattern": "(?=a)("}), call('"a"'), "\\ud800"),
        (tool({}), '{"tool_calls": [{"id": "1", "name": "f", "type": "function", "arguments": {"b": 1, "a": 2.50}}]}', "{ }"),
        (tool({"$ref": "#"}), call("1"), ""),
        (tool({"properties": {"x": {"$ref": "#"}}, "additionalProperties": {"type": "string"}}), call('{"x":{"x":{"y":1}}}'), " x "),
        (tool({}), call('{"a":1,"a":2}'), "\u2028"),
        (tool({}), call('{"a":NaN}'), "x" * 300000),
        (tool({}), '{"content":"c","content":"d","reasoning":"r","tool_calls":[{"id":"1","name":"f","arguments":{}}]}', "r"),
        (tool({}), '{"content":"c","tool_calls":[{"id":"1","name":"f","arguments":{}},{"id":"1","name":"f","arguments":{}},{"name":"f"}]}', "r"),
        (tool({}), call('{"a":1e400000,"b":1.50,"c":-0.0,"d":1E3}'), "r"),
    ]
    rows = [(k, t, role, text) for k, (a, b, c) in enumerate(cases) for t, role, text in ((0, "system", a), (1, "assistant", b), (2, "tool", '{"tool_call_id":"1","content":%s}' % json.dumps(c)))]
    rows += [(None, 0, "assistant", call("{}")), (None, 1, "tool", '{"tool_call_id":"1","content":"x"}'), (None, 1, "tool", "x")]
    began = time.time()
    found = chat.format_chats(conversations(spark, rows)).collect()
    assert time.time() - began < 60 and len(found) == len(cases) + 3
    got = {r["conv_id"]: r for r in found if r["conv_id"] is not None}
    for k, (_, _, result) in enumerate(cases):
        held = json.loads(got[k]["messages"])
        assert held[1]["role"] == "assistant"
        if k != 10:  # a text with NaN is no envelope: it stays as it is
            assert held[1]["tool_calls"][0]["result"] == result, k
    arguments = lambda k: json.loads(got[k]["messages"])[1]["tool_calls"][0]["call"]["arguments"]
    assert arguments(2) == '{"a":%s}' % deep and got[2]["problems"] == ["call 1: arguments are nested deeper than 100"]
    assert chat.envelope("[" * 10**6) is None and chat.envelope('{"content":' * 10**5) is None
    assert got[0]["problems"] == got[3]["problems"] == [] and got[1]["problems"] == []
    assert got[4]["problems"] == ["call 1: $: breaks pattern"] and got[5]["problems"] == ["call 1: $: unusable pattern"]
    assert got[7]["problems"] == ["call 1: $: schema not checked to its end"] and got[8]["problems"] == ["call 1: $.x.x.y: not of type string"]
    assert got[9]["problems"] == ["call 1: arguments repeat a key"] and arguments(9) == '{"a":1,"a":2}'
    assert got[10]["problems"] == ["result 1: answers nothing"] and json.loads(got[10]["messages"])[1]["content"] == rows[31][3]  # NaN is no JSON
    assert arguments(6) == {"a": 2.5, "b": 1} and json.loads(got[6]["messages"])[1]["envelope"] == cases[6][1]
    assert json.loads(got[11]["messages"])[1]["envelope"] == cases[11][1]
    assert got[12]["n_calls"] == 3 and len(json.loads(got[12]["messages"])[1]["tool_calls"]) == 3
    assert '{"a":1e+400000,"b":1.5,"c":0,"d":1000}' in got[13]["messages"]
    assert chat.envelope('{"tool_call_id":"1","content":"\\ud800"}')["content"] == '"\\ud800"'


def checked(value):
    """What SCHEMA says of arguments, by hand."""
    out = ["$.a: missing"] if "a" not in value else []
    for k, v in sorted(value.items()):
        if k == "a":
            out += ["$.a: not of type integer"] if isinstance(v, bool) or not isinstance(v, int) else ["$.a: breaks minimum"] if v < 1 else []
        elif k == "b":
            out += [] if v in ("x", "y") else ["$.b: not in enum"]
        else:
            out.append(f"$.{k}: not allowed")
    return out


def by_hand(rows):
    """n_calls, links and problems of one conversation, call by call, without joins."""
    turns = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0))
    calls, results, known = [], [], False
    for _, turn, role, text in turns:
        try:
            e = json.loads(text)
        except (TypeError, ValueError):
            continue
        if role == "assistant" and e.get("tool_calls") is not None:
            calls += [(turn, c) for c in e["tool_calls"]]
        if role == "tool" and e.get("tool_call_id") is not None:
            results.append((turn, e["tool_call_id"], e["content"]))
        known |= role == "system" and "tools" in e
    seen, links, problems = [], {}, []
    for turn, c in calls:
        if c["id"] in seen:
            problems.append(f"call {c['id']}: id used again")
        else:
            seen.append(c["id"])
            fit = sorted((t is None, t or 0, content) for t, i, content in results if i == c["id"] and (t is None or turn is None or t >= turn))
            if fit:
                links[c["id"]] = fit[0][2]
    done = set()
    for turn, c in calls:
        again = c["id"] in done
        done.add(c["id"])
        problems += [f"call {c['id']}: {v}" for v in (checked(c["arguments"]) if known else [f"tool {c['name']} is not declared"])]
        if not again:
            wanted = {v[2:-1] for v in c["arguments"].values() if isinstance(v, str) and v.startswith("${")} - {c["id"]}
            problems += [f"call {c['id']}: needs unknown {d}" for d in wanted - set(seen)]
        if again or c["id"] not in links:
            problems.append(f"call {c['id']}: no result")
    for _, i, content in results:
        if links.get(i) == content:
            continue
        problems.append(f"result {i}: " + ("answered already" if i in seen else "answers nothing"))
    return len(calls), links, problems


def test_generated_conversations_against_brute_force(spark):
    draw, rows, unique = random.Random(21), [], 0
    for conv in range(120):
        turns = []
        if draw.random() < 0.8:
            turns.append((0, "system", json.dumps({"tools": [{"name": "f", "parameters": SCHEMA}]})))
        ids = [f"c{k}" for k in range(draw.randint(0, 5))]
        for i in ids:
            arguments = {k: draw.choice([0, 1, 7, "x", "q", None, True, "${c0}", "${c9}"]) for k in draw.sample("abc", draw.randint(0, 3))}
            arguments = {k: v for k, v in arguments.items() if not (v == "${c0}" and i == "c0")}
            turns.append((draw.randint(1, 6), "assistant", json.dumps({"content": "say", "tool_calls": [{"id": draw.choice([i, i, i, "c1"]), "name": "f", "arguments": arguments}]})))
        for i in [*ids, "c1", "c7"]:
            unique += 1
            if draw.random() < 0.8:
                turns.append((draw.choice([None, *range(1, 9)]), "tool", json.dumps({"tool_call_id": i, "content": f"result {unique}"})))
        turns += [(draw.randint(0, 9), "user", f"text {draw.random()}") for _ in range(draw.randint(0, 3))]
        # equal turns would leave the order of calls to their texts
        places, fixed = list(range(1, 40)), []
        for t, role, text in turns:
            fixed.append((t if role != "assistant" else places.pop(draw.randrange(6)), role, text))
        rows += [(conv, *t) for t in fixed]
    got = {r["conv_id"]: r for r in chat.format_chats(conversations(spark, rows).repartition(5)).collect()}
    assert len(got) == len({r[0] for r in rows}) and sum(r["n_linked"] for r in got.values()) > 100
    for conv, r in got.items():
        n_calls, links, problems = by_hand([x for x in rows if x[0] == conv])
        held = json.loads(r["messages"])
        entries = [c for m in held for c in m.get("tool_calls", [])]
        assert (r["n_calls"], r["n_linked"], len(entries)) == (n_calls, len(links), n_calls)
        assert {c["call"]["id"]: c["result"] for c in entries if c["result"] is not None} == links
        assert sorted(p for p in r["problems"] if "cycle" not in p) == sorted(problems), conv
        texts = [x[3] for x in rows if x[0] == conv and x[2] in ("user", "system")]
        assert sorted(m["content"] for m in held if m["role"] in ("user", "system")) == sorted(texts)
        assert r["n_turns"] == sum(x[0] == conv for x in rows) == sum(m["role"] != "assistant" for m in held) + len(links) + sum(m["role"] == "assistant" for m in held)


@pytest.mark.parametrize("text, want", [("1.0", "1"), ("-0", "0"), ("1e5", "100000"), ("12e-3", "0.012"), ("1E-7", "1e-7"), ("123456789012345678901234567890", "1.2345678901234567890123456789e+29"), ("0.1", "0.1"), ("100e-2", "1"), ("1e21", "1e+21"), ("1e20", "100000000000000000000")])
def test_numbers_have_one_form(text, want):
    value, wrong = chat.parsed(text)
    assert wrong is None and chat.canonical(value) == want and Decimal(want) == Decimal(text)


@settings(max_examples=80, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=5), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=12))
def test_canonical_form_is_the_same_value(value):
    text = chat.canonical(chat.parsed(json.dumps(value))[0])
    assert chat.canonical(chat.parsed(text)[0]) == text
    assert json.loads(text, parse_float=lambda x: int(Decimal(x))) == value


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 8), st.data())
def test_topological_order(n, data):
    ids = [f"c{k}" for k in range(n)]
    needs = {c: set(data.draw(st.lists(st.sampled_from([*ids, "other"]), max_size=3))) - {c} for c in ids}
    order, stuck = chat.topological(ids, needs)
    assert sorted(order) == sorted(ids)
    for c in ids:
        if c not in stuck:
            assert all(order.index(d) < order.index(c) for d in needs[c] if d in ids)
    for c in stuck:
        assert any(d in stuck for d in needs[c])
