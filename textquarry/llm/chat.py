"""Chat formatting with linked tool calls.

Messages may be envelopes, texts that are one JSON object:

* role ``system``: ``{"tools": [{"name": ..., "parameters": <JSON schema>}, ...]}`` declares tools,
* role ``assistant``: ``{"content": ..., "tool_calls": [{"id": ..., "name": ..., "arguments": {...}}, ...]}``,
* role ``tool``: ``{"tool_call_id": ..., "content": ...}`` answers a call.

Calls and results meet in a hash join by conversation and identifier, are put in topological order (a call whose
arguments hold ``"${id}"`` comes after the call of that id), have their arguments validated against the declared
schema, and every conversation becomes one canonical JSON text: sorted keys, no white space, one way to write a number.
Only arguments are parsed; contents and results stay the strings that they are, to the sign.
"""

from __future__ import annotations

import heapq
import json
import re
from decimal import Decimal, InvalidOperation

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.plans.runtime import small_batches

#: Arguments and schemas nested deeper are not parsed but kept as text, and reported.
MAX_DEPTH = 100
#: Comparisons of values and schemas that one call may take; a schema that refers to itself can ask for more.
MAX_STEPS = 100_000

_CALL = T.StructType([T.StructField(k, T.StringType()) for k in ("id", "name", "arguments")])
_TOOL = T.StructType([T.StructField(k, T.StringType()) for k in ("name", "parameters")])
ENVELOPE = T.StructType([T.StructField("content", T.StringType()), T.StructField("tool_calls", T.ArrayType(_CALL)), T.StructField("tool_call_id", T.StringType()), T.StructField("tools", T.ArrayType(_TOOL)), T.StructField("more", T.BooleanType())])
_REFERENCE = re.compile(r"\$\{([^{}]+)\}")

RESULT = T.StructType([T.StructField("messages", T.StringType()), T.StructField("n_calls", T.IntegerType()), T.StructField("n_linked", T.IntegerType()), T.StructField("problems", T.ArrayType(T.StringType()))])


def _number(x: Decimal) -> str:
    """The exact value in its one form: plain up to 21 digits before or 6 zeros after the point, with an exponent beyond."""
    sign, digits, exponent = x.as_tuple()
    text = "".join(map(str, digits)).lstrip("0")
    if not text:
        return "0"
    short = text.rstrip("0")
    point = len(text) + exponent  # digits before the point
    minus = "-" if sign else ""
    if len(short) <= point <= 21:
        return minus + short + "0" * (point - len(short))
    if 0 < point <= 21:
        return f"{minus}{short[:point]}.{short[point:]}"
    if -6 < point <= 0:
        return f"{minus}0.{'0' * -point}{short}"
    return f"{minus}{short[0]}{'.' if len(short) > 1 else ''}{short[1:]}e{point - 1:+d}"


_SURROGATE = re.compile("[\ud800-\udfff]")


def _string(x: str) -> str:
    return _SURROGATE.sub(lambda m: f"\\u{ord(m.group()):04x}", json.dumps(x, ensure_ascii=False))


def canonical(value) -> str:
    """Canonical JSON: keys sorted by code point, no white space, numbers in the form of their value, lone surrogates escaped."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{_string(k)}:{canonical(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, str):
        return _string(value)
    return {None: "null", True: "true", False: "false"}[value] if value is None or isinstance(value, bool) else _number(Decimal(value))


def _unique(pairs: list[tuple]) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise ValueError("repeat a key")
    return out


def _constant(name: str):
    raise ValueError(f"hold {name}")


def _depth(value) -> int:
    level, depth = [value], 0
    while level:
        level = [y for x in level if isinstance(x, (dict, list)) for y in (x.values() if isinstance(x, dict) else x)]
        depth += 1
    return depth


def parsed(text: str | None):
    """The value of a JSON text with exact numbers and None, or the text itself and why it stays one."""
    if text is None:
        return None, None
    try:
        value = json.loads(text, parse_float=Decimal, parse_int=Decimal, parse_constant=_constant, object_pairs_hook=_unique)
    except json.JSONDecodeError:
        return text, "are no JSON"
    except ValueError as e:
        return text, str(e)
    except InvalidOperation:
        return text, "hold a number out of range"
    except RecursionError:
        return text, f"are nested deeper than {MAX_DEPTH}"
    return (text, f"are nested deeper than {MAX_DEPTH}") if _depth(value) > MAX_DEPTH else (value, None)


def _whole(x: Decimal) -> bool:
    _, digits, exponent = x.as_tuple()
    return exponent >= 0 or not any(digits[exponent:])


_KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None), "number": Decimal}


def _is(kind: str, x) -> bool:
    if kind == "integer":
        return isinstance(x, Decimal) and _whole(x)
    return kind not in _KINDS or isinstance(x, _KINDS[kind])


_BOUNDS = {
    "minimum": (Decimal, lambda x, m: x < m), "maximum": (Decimal, lambda x, m: x > m), "exclusiveMinimum": (Decimal, lambda x, m: x <= m), "exclusiveMaximum": (Decimal, lambda x, m: x >= m),
    "minLength": (str, lambda x, m: len(x) < m), "maxLength": (str, lambda x, m: len(x) > m), "minItems": (list, lambda x, m: len(x) < m), "maxItems": (list, lambda x, m: len(x) > m),
    "minProperties": (dict, lambda x, m: len(x) < m), "maxProperties": (dict, lambda x, m: len(x) > m),
}


class _Stopped(Exception):
    pass


def _breaks(value, schema, path: str, root, steps: list[int]) -> list[str]:
    steps[0] += 1
    if steps[0] > MAX_STEPS or steps[1] > 2 * MAX_DEPTH:
        raise _Stopped
    if not isinstance(schema, dict):
        return [f"{path}: not allowed"] if schema is False else []
    steps[1] += 1
    go = lambda v, s, p: _breaks(v, s, p, root, steps)
    out = []
    if isinstance(ref := schema.get("$ref"), str) and ref.startswith("#"):
        target = root
        for part in filter(None, ref[1:].split("/")):
            part = part.replace("~1", "/").replace("~0", "~")
            target = target.get(part) if isinstance(target, dict) else None
        out += [f"{path}: unknown {ref}"] if target is None else go(value, target, path)
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else [k for k in kinds if isinstance(k, str)] if isinstance(kinds, list) else []
    if kinds and not any(_is(k, value) for k in kinds):
        steps[1] -= 1
        return [*out, f"{path}: not of type {'/'.join(kinds)}"]
    if isinstance(schema.get("enum"), list) and canonical(value) not in map(canonical, schema["enum"]):
        out.append(f"{path}: not in enum")
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        out.append(f"{path}: not the constant")
    out += [f"{path}: breaks {key}" for key, (kind, bad) in _BOUNDS.items() if isinstance(schema.get(key), Decimal) and isinstance(value, kind) and bad(value, schema[key])]
    if isinstance(value, str) and isinstance(schema.get("pattern"), str):
        try:  # an engine without backtracking: linear in the value, whatever the pattern
            met = pc.match_substring_regex(pa.array([_SURROGATE.sub("\ufffd", value)]), pattern=_SURROGATE.sub("\ufffd", schema["pattern"]))[0].as_py()
            out += [] if met else [f"{path}: breaks pattern"]
        except pa.ArrowInvalid:
            out.append(f"{path}: unusable pattern")
    some = {k: [go(value, s, path) for s in schema[k]] for k in ("allOf", "anyOf", "oneOf") if isinstance(schema.get(k), list)}
    out += [x for found in some.get("allOf", ()) for x in found]
    if "anyOf" in some and all(some["anyOf"]):
        out.append(f"{path}: none of anyOf")
    if "oneOf" in some and sum(not found for found in some["oneOf"]) != 1:
        out.append(f"{path}: not one of oneOf")
    if "not" in schema and not go(value, schema["not"], path):
        out.append(f"{path}: breaks not")
    if isinstance(value, list):
        if "items" in schema:
            for k, x in enumerate(value):
                out += go(x, schema["items"], f"{path}[{k}]")
        if schema.get("uniqueItems") is True and len(set(map(canonical, value))) < len(value):
            out.append(f"{path}: items repeat")
    if isinstance(value, dict):
        known = schema.get("properties") if isinstance(schema.get("properties"), dict) else {}
        required = schema.get("required") if isinstance(schema.get("required"), list) else []
        out += [f"{path}.{k}: missing" for k in required if isinstance(k, str) and k not in value]
        for k in sorted(value):
            if k in known:
                out += go(value[k], known[k], f"{path}.{k}")
            elif "additionalProperties" in schema:
                out += go(value[k], schema["additionalProperties"], f"{path}.{k}")
    steps[1] -= 1
    return out


def violations(value, schema) -> list[str]:
    """What in ``value`` breaks a JSON schema, both as ``parsed`` gives them.

    Knows type, enum, const, bounds, lengths, pattern (RE2), items, uniqueItems, properties, required,
    additionalProperties, allOf, anyOf, oneOf, not and local $ref; keywords of another shape than they should have say
    nothing. Stops with a note after MAX_STEPS comparisons or where references nest too deeply.
    """
    try:
        return _breaks(value, schema, "$", schema, [0, 0])
    except _Stopped:
        return ["$: schema not checked to its end"]


def topological(ids: list[str], needs: dict[str, set[str]]) -> tuple[list[str], set[str]]:
    """``ids`` so that every one comes after those it needs, otherwise in the given order; and those caught in cycles, last."""
    place = {c: k for k, c in enumerate(ids)}
    left = {c: {d for d in needs.get(c, ()) if d in place} for c in ids}
    then: dict[str, list[str]] = {}
    for c, some in left.items():
        for d in some:
            then.setdefault(d, []).append(c)
    ready = [place[c] for c in ids if not left[c]]
    heapq.heapify(ready)
    order = []
    while ready:
        c = ids[heapq.heappop(ready)]
        order.append(c)
        for after in then.get(c, ()):
            left[after].discard(c)
            if not left[after]:
                heapq.heappush(ready, place[after])
    done = set(order)
    stuck = [c for c in ids if c not in done]
    return order + stuck, set(stuck)


def _turn(row: dict) -> tuple:
    return row["turn"] is None, row["turn"] or 0


def render(turns: list[dict], calls: list[dict], orphans: list[dict], tools: list[dict]) -> dict:
    """One conversation: its turns in order, each call directly followed by its result, calls in topological order."""
    problems: list[str] = []
    schemas: dict[str, object] = {}
    for t in tools:
        if t["name"] is None or t["name"] in schemas:
            problems.append(f"tool {t['name']}: declared again" if t["name"] else "tool without a name")
            continue
        schema, wrong = parsed(t["parameters"])
        if wrong:
            problems.append(f"tool {t['name']}: parameters {wrong}")
        schemas[t["name"]] = {} if wrong or schema is None else schema
    by_id: dict[str, dict] = {}
    apart: list[dict] = []
    for c in sorted(calls, key=lambda c: (*_turn(c), c["place"])):
        if c["id"] is None or c["id"] in by_id:
            problems.append("call without an id" if c["id"] is None else f"call {c['id']}: id used again")
            apart.append(c)
        else:
            by_id[c["id"]] = c
    needs = {i: set(_REFERENCE.findall(c["arguments"] or "")) - {i} for i, c in by_id.items()}
    order, stuck = topological(list(by_id), needs)
    linked = 0
    made: dict[object, list[str]] = {}
    for c in [*(by_id[i] for i in order), *apart]:
        own, i = c["id"] in by_id and by_id[c["id"]] is c, c["id"]
        arguments, wrong = parsed(c["arguments"])
        if wrong:
            problems.append(f"call {i}: arguments {wrong}")
        elif c["name"] not in schemas:
            problems.append(f"call {i}: tool {c['name']} is not declared")
        else:
            problems += [f"call {i}: {v}" for v in violations({} if arguments is None else arguments, schemas[c["name"]])]
        if own:
            problems += [f"call {i}: needs unknown {d}" for d in sorted(needs[i] - by_id.keys())]
            if i in stuck:
                problems.append(f"call {i}: part of a cycle")
        linked += bool(c["answered"])
        if not c["answered"]:
            problems.append(f"call {i}: no result")
        entry = {"call": {"arguments": arguments, "id": i, "name": c["name"]}, "result": c["result"]}
        made.setdefault(c["turn"], []).append(canonical(entry | ({"envelope": c["envelope"]} if c["envelope"] is not None else {})))
    problems += [f"result {r['id']}: " + ("answers nothing" if r["id"] not in by_id else "answered already") for r in sorted(orphans, key=lambda r: (*_turn(r), str(r["id"]), r["content"] or ""))]
    messages, shown = [], set()
    for t in sorted([*turns, *({**r, "role": "tool", "envelope": None} for r in orphans)], key=lambda t: (*_turn(t), t["role"] or "", t["content"] or "")):
        parts = [f'"content":{canonical(t["content"])}']
        if t["envelope"] is not None:
            parts.append(f'"envelope":{canonical(t["envelope"])}')
        parts.append(f'"role":{canonical(t["role"])}')
        if t["role"] == "assistant" and t["turn"] in made and t["turn"] not in shown:
            shown.add(t["turn"])
            parts.append(f'"tool_calls":[{",".join(made[t["turn"]])}]')
        messages.append("{" + ",".join(parts) + "}")
    return {"messages": "[" + ",".join(messages) + "]", "n_calls": len(calls), "n_linked": linked, "problems": [_SURROGATE.sub("\ufffd", p) for p in problems]}


@F.arrow_udf(RESULT)
def _render(turns: pa.Array, calls: pa.Array, orphans: pa.Array, tools: pa.Array) -> pa.Array:
    rows = [render(a.as_py() or [], b.as_py() or [], c.as_py() or [], d.as_py() or []) for a, b, c, d in zip(turns, calls, orphans, tools)]
    return pa.array(rows, pa.struct([("messages", pa.string()), ("n_calls", pa.int32()), ("n_linked", pa.int32()), ("problems", pa.list_(pa.string()))]))


_DECODER = json.JSONDecoder(parse_float=str, parse_int=str, parse_constant=_constant)
_SPACE = re.compile(r"[ \t\n\r]*")


def _parts(text: str, at: int) -> list[tuple[str | None, int, int]]:
    """Key (none in a list), start and end of every member of the valid JSON object or list at ``at``."""
    skip = lambda k: _SPACE.match(text, k).end()
    out, named, at = [], text[at] == "{", skip(at + 1)
    while text[at] not in "]}":
        key = None
        if named:
            key, at = json.decoder.scanstring(text, at + 1)
            at = skip(skip(at) + 1)  # beyond the colon
        end = _DECODER.raw_decode(text, at)[1]
        out.append((key, at, end))
        at = skip(end)
        if text[at] == ",":
            at = skip(at + 1)
    return out


def _plain(text: str, start: int, end: int) -> str | None:
    """A member as it is used: the string that it is, null, or its own signs; those too for what no UTF-8 can hold."""
    if text[start] != '"':
        return None if text[start] == "n" else text[start:end]
    held = json.loads(text[start:end])
    return text[start:end] if _SURROGATE.search(held) else held


def envelope(text: str | None) -> dict | None:
    """What an envelope holds, arguments and parameters as their own text; none for a text that is no envelope.

    ``more`` tells that it has further keys, or one of them twice (the last counts).
    """
    try:
        if text is None or not isinstance(json.loads(text, parse_float=str, parse_int=str, parse_constant=_constant), dict):
            return None
    except (ValueError, RecursionError):
        return None
    members = _parts(text, _SPACE.match(text).end())
    held = {k: (a, b) for k, a, b in members}
    out = dict.fromkeys(("content", "tool_calls", "tool_call_id", "tools")) | {"more": len(members) > len(held) or not held.keys() <= {"content", "tool_calls", "tool_call_id"}}
    for key in ("content", "tool_call_id"):
        if key in held:
            out[key] = _plain(text, *held[key])
    for key, names in (("tool_calls", ("id", "name", "arguments")), ("tools", ("name", "parameters"))):
        if key in held and text[held[key][0]] == "[":
            some = [(a, b) for _, a, b in _parts(text, held[key][0])]
            if any(text[a] != "{" for a, _ in some):
                continue
            rows = []
            for a, _ in some:
                own = _parts(text, a)
                at = {k: (x, y) for k, x, y in own}
                out["more"] |= len(own) > len(at) or not at.keys() <= set(names)
                last = names[-1]
                row = {k: _plain(text, *at[k]) if k in at else None for k in names[:-1]}
                rows.append(row | {last: text[slice(*at[last])] if last in at and text[at[last][0]] != "n" else None})
            out[key] = rows
    return out


@F.arrow_udf(ENVELOPE)
def _envelopes(text: pa.Array) -> pa.Array:
    call = pa.struct([(k, pa.string()) for k in ("id", "name", "arguments")])
    tool = pa.struct([(k, pa.string()) for k in ("name", "parameters")])
    kind = pa.struct([("content", pa.string()), ("tool_calls", pa.list_(call)), ("tool_call_id", pa.string()), ("tools", pa.list_(tool)), ("more", pa.bool_())])
    return pa.array([envelope(t.as_py()) for t in text], kind)


def format_chats(messages: DataFrame) -> DataFrame:
    """conv_id, messages (canonical JSON), n_turns, n_calls, n_linked, problems of every conversation.

    A call takes the first result after it (smallest turn, then content). Problems are reported and nothing is left out
    for them: calls without an identifier or a result, repeated identifiers (the first call gets the result), cycles,
    undeclared tools, arguments that are no JSON, repeat a key, hold NaN or are nested too deeply (kept as text) and
    arguments that break their schema. A tool turn shows in its call; one that answers nothing, or a call answered
    already, stays a turn of its own. Contents and results are kept to the sign; an envelope with further keys is kept
    whole beside what was read from it.

    A text that is no envelope of its role is content as it stands; null texts and roles are JSON nulls; empty and very
    long texts are kept whole. Turns are ordered by number, null numbers last, then by role and text; repeated rows show
    as often as they occur. A row with a null conv_id belongs to no other and is a conversation of its own. An empty table
    gives no rows; columns but conv_id, turn, role and text play no part, whatever their names. A conversation is one
    value of the result and has to fit a task.
    """
    small_batches(messages.sparkSession)
    rows = messages.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    maybe = F.col("role").isin("system", "assistant", "tool") & F.col("text").rlike(r"^\s*\{")
    split = rows.withColumn("e", _envelopes(F.when(maybe, F.col("text"))))
    is_call = F.coalesce((F.col("role") == "assistant") & F.col("e.tool_calls").isNotNull(), F.lit(False))
    is_result = F.coalesce((F.col("role") == "tool") & F.col("e.tool_call_id").isNotNull(), F.lit(False))
    is_tools = F.coalesce((F.col("role") == "system") & F.col("e.tools").isNotNull(), F.lit(False))
    content = F.when(is_call, F.col("e.content")).otherwise(F.col("text"))
    shown = F.when(~is_result, F.struct("turn", "role", content.alias("content"), F.when(is_call & F.col("e.more"), F.col("text")).alias("envelope")))
    alone, keyed = split.where("conv_id IS NULL"), split.where("conv_id IS NOT NULL")

    calls = keyed.where(is_call).select(F.col("conv_id").alias("conv"), "turn", F.posexplode("e.tool_calls").alias("place", "c")).select("conv", "turn", "place", "c.id", "c.name", "c.arguments")
    calls = calls.withColumn("first", F.row_number().over(_window("conv", "id", order=("turn", "place"))) == 1)
    answer = F.when(F.col("e.more"), F.col("text"))
    results = keyed.where(is_result).select(F.col("conv_id").alias("conv"), F.col("turn").alias("result_turn"), F.col("e.tool_call_id").alias("id"), F.col("e.content").alias("result"), answer.alias("envelope"), "text")
    results = results.withColumn("nth", F.row_number().over(_window("conv", "id", order=("result_turn", "result", "text"))))
    near = F.col("c.first") & (F.col("c.conv") == F.col("r.conv")) & (F.col("c.id") == F.col("r.id"))
    pairs = calls.alias("c").join(results.alias("r").hint("shuffle_hash"), near, "full_outer")
    after = F.col("r.result_turn").isNull() | F.col("c.turn").isNull() | (F.col("r.result_turn") >= F.col("c.turn"))
    pairs = pairs.select(F.coalesce("c.conv", "r.conv").alias("conv"), "c.turn", "c.place", F.col("c.id").alias("call_id"), "c.name", "c.arguments", "r.result_turn", "r.result", "r.envelope", "r.text", "r.nth", F.col("r.id").alias("result_id"), F.col("r.conv").isNotNull().alias("has_result"), F.col("c.conv").isNotNull().alias("has_call"), after.alias("after"))
    taken = F.col("has_call") & F.col("has_result") & F.col("after")
    best = F.row_number().over(_window("conv", "call_id", "turn", "place", order=(F.when(taken, 0).otherwise(1), "nth")))
    pairs = pairs.withColumn("best", best).withColumn("taken", taken & (F.col("best") == 1))
    call_row = F.struct("turn", "place", F.col("call_id").alias("id"), "name", "arguments", F.col("taken").alias("answered"), F.when(F.col("taken"), F.col("result")).alias("result"), F.when(F.col("taken"), F.col("envelope")).alias("envelope"))
    orphan_row = F.struct(F.col("result_turn").alias("turn"), F.col("result_id").alias("id"), F.col("text").alias("content"))
    linked = pairs.groupBy("conv").agg(
        F.collect_list(F.when(F.col("has_call") & (F.col("best") == 1), call_row)).alias("calls"),
        F.collect_list(F.when(F.col("has_result") & ~F.col("taken"), orphan_row)).alias("orphans"),
    )
    place_tools = F.when(is_tools, F.struct("turn", "e.tools"))
    chats = keyed.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.collect_list(shown).alias("turns"), F.flatten(F.transform(F.array_sort(F.collect_list(place_tools)), lambda x: x["tools"])).alias("tools"))
    chats = chats.join(linked, F.col("conv_id") == F.col("conv"), "left").select("conv_id", "n_turns", "turns", "calls", "orphans", "tools")

    own_call = lambda c, k: F.struct(F.col("turn").alias("turn"), k.alias("place"), c["id"].alias("id"), c["name"].alias("name"), c["arguments"].alias("arguments"), F.lit(False).alias("answered"), F.lit(None).cast("string").alias("result"), F.lit(None).cast("string").alias("envelope"))
    single = alone.select(
        "conv_id",
        F.lit(1).cast("bigint").alias("n_turns"),
        F.when(~is_result, F.array(shown)).alias("turns"),
        F.when(is_call, F.transform("e.tool_calls", own_call)).alias("calls"),
        F.when(is_result, F.array(F.struct("turn", F.col("e.tool_call_id").alias("id"), F.col("text").alias("content")))).alias("orphans"),
        F.when(is_tools, F.col("e.tools")).alias("tools"),
    )
    chats = chats.unionByName(single)
    return chats.select("conv_id", "n_turns", _render("turns", "calls", "orphans", "tools").alias("m")).select("conv_id", "m.messages", "n_turns", "m.n_calls", "m.n_linked", "m.problems")


def _window(*by: str, order: tuple):
    return Window.partitionBy(*by).orderBy(*[F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order])
