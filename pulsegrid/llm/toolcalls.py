"""Chat formatting: tool calls joined to their results by identifier, ordered topologically, checked against schemas, written as canonical JSON.

A turn's text may be a JSON object with tool_calls (each with id, name, arguments and, where it needs other calls'
results, depends_on), or, in a tool's turn, one with tool_call_id and content. All other turns are messages. Calls
and results are hash-joined by (conversation, identifier). A call's level is one more than the highest level of the
calls it depends on: a topological order, found in one pass over a conversation's dependencies (in rounds of joins
beyond ONE_TASK of them). Conversations are returned as rows, one for a message, call or result; their order is that of
the column place (level, turn, part), so none is gathered into one place and a conversation may be of any length.

Canonical JSON: keys sorted, no blanks between tokens, characters beyond ASCII as they are, numbers in their shortest form.

Defined results: a null text is an empty message; broken JSON is a message; a null conversation, turn or role is kept
and links like any other value; of several results for one call the first (turn, part) is linked, the others
are "duplicate"; a result of no call is "orphan", one before its call "early"; a call without result is
"unanswered"; of calls with one identifier in a conversation the first counts, the others are "duplicate"; calls on a
cycle, or dependent on one or on an unknown call, have no level and the error "dependency".
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.storage import cut, kept, small_or_shuffled

#: Schemas of the tools' arguments: a subset of JSON Schema (type, required, properties, items, enum, additionalProperties).
TOOLS: dict[str, dict] = {
    "reply": {"type": "object", "required": ["question"], "properties": {"question": {"type": "string", "minLength": 1}, "turn": {"type": "integer"}}, "additionalProperties": False},
    "search": {"type": "object", "required": ["query"], "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer"}}, "additionalProperties": False},
}
#: Dependencies of a conversation that one task orders.
ONE_TASK = 50_000
PARTS = "conv_id long, turn long, part int, role string, kind string, call_id string, name string, depends_on array<string>, errors array<string>, body string"
_SURROGATE = re.compile("[\ud800-\udfff]")
_KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def canonical(value: object) -> str:
    """Canonical JSON. Whole floats are written as integers; NaN and infinities, which JSON lacks, as null."""

    def plain(v: object) -> object:
        if isinstance(v, float):
            return None if not math.isfinite(v) else int(v) if v.is_integer() and abs(v) < 1 << 53 else v
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        return [plain(x) for x in v] if isinstance(v, list) else v

    return _written(json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False))


def _written(text: str) -> str:
    """text with lone surrogates, which UTF-8 lacks, as the escapes they came from."""
    return _SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def violations(value: object, schema: dict, at: str = "$") -> list[str]:
    """What a value has against a schema, as place:rule, in the order of the schema."""
    kind = schema.get("type")
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    whole = number and (isinstance(value, int) or value.is_integer())  # an int may be too large for a float
    fits = {"number": number, "integer": whole}[kind] if kind in ("number", "integer") else kind is None or isinstance(value, _KINDS[kind])
    if not fits:
        return [f"{at}:type"]
    found = [f"{at}:enum"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        found.append(f"{at}:minLength")
    if isinstance(value, dict):
        found += [f"{at}.{k}:required" for k in schema.get("required", ()) if k not in value]
        known = schema.get("properties", {})
        for k in sorted(value):
            if k in known:
                found += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{at}.{k}:additional")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            found += violations(v, schema["items"], f"{at}[{i}]")
    return found


def _object(text: str | None) -> dict:
    if text and text.lstrip()[:1] == "{":
        try:
            found = json.loads(text)
        except (ValueError, RecursionError):
            return {}
        return found if isinstance(found, dict) else {}
    return {}


def _parts(role: str | None, text: str | None, tools: dict[str, dict]) -> list[tuple]:
    """A turn's parts: (kind, call_id, name, depends_on, errors, body), body in canonical JSON. JSON nested too deeply to be walked is a message."""
    try:
        return _read_parts(role, _object(text), text, tools)
    except RecursionError:
        return _read_parts(role, {}, text, tools)


def _read_parts(role: str | None, found: dict, text: str | None, tools: dict[str, dict]) -> list[tuple]:
    calls = found.get("tool_calls")
    if role == "tool" and isinstance(found.get("tool_call_id"), (str, int)):
        return [("result", _written(str(found["tool_call_id"])), None, None, [], canonical(found.get("content")))]
    if not isinstance(calls, list) or not calls or not all(isinstance(c, dict) for c in calls):
        return [("message", None, None, None, [], canonical(text or ""))]
    out = [("message", None, None, None, [], canonical(found["content"]))] if found.get("content") else []
    for c in calls:
        arguments, name = c.get("arguments"), c.get("name")
        if isinstance(arguments, str):
            try:
                arguments = json.loads(arguments)
            except (ValueError, RecursionError):
                arguments = None
        schema = tools.get(name) if isinstance(name, str) else None
        errors = ["$:tool"] if schema is None else violations(arguments, schema)
        depends = c.get("depends_on") if isinstance(c.get("depends_on"), list) else []
        out.append(("call", None if c.get("id") is None else _written(str(c["id"])), _written(name) if isinstance(name, str) else None, [_written(str(d)) for d in depends], [_written(e) for e in errors], canonical(arguments)))
    return out


def parts(conversations: DataFrame, tools: dict[str, dict] = TOOLS) -> DataFrame:
    """conversations(conv_id, turn, role, text) -> their messages, calls and results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(conv, turn, i, role, *p) for conv, turn, role, text in zip(*(c.to_pylist() for c in b.columns)) for i, p in enumerate(_parts(role, text, tools))]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in PARTS.split(", ")])

    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").mapInArrow(run, PARTS)


def turns_as_calls(conversations: DataFrame) -> DataFrame:
    """Plain dialogue in the form of tool use; turns that hold tool calls or a tool's answer already stay as they are.

    A user's turn calls reply under the identifier of the turn that should answer it, and depends on the call of the user's turn
    two before, if there is one; an assistant's turn is the result of its own identifier.
    """
    text = F.coalesce("text", F.lit(""))
    used = F.ltrim("text").startswith("{") & (F.get_json_object("text", "$.tool_calls").isNotNull() | F.get_json_object("text", "$.tool_call_id").isNotNull())
    turns = conversations.select("conv_id", "turn", "role", "text", F.coalesce(used, F.lit(False)).alias("used"))
    asked = turns.where("role = 'user' AND NOT used AND turn IS NOT NULL").select(F.col("conv_id").alias("c"), (F.col("turn") + 2).alias("t")).distinct()
    turns = turns.join(asked, F.expr("conv_id <=> c AND turn = t"), "left")
    before = F.when(F.col("t").isNotNull(), F.array(F.concat(F.lit("turn-"), F.col("turn") - 1))).otherwise(F.array().cast("array<string>"))
    arguments = F.struct(text.alias("question"), F.col("turn").alias("turn"))
    call = F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("turn-"), F.col("turn") + 1).alias("id"), F.lit("reply").alias("name"), arguments.alias("arguments"), before.alias("depends_on"))).alias("tool_calls")))
    result = F.to_json(F.struct(F.concat(F.lit("turn-"), F.col("turn")).alias("tool_call_id"), text.alias("content")))
    as_text = F.when(F.col("used"), F.col("text")).when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text"))
    role = F.when(F.col("used"), F.col("role")).when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role"))
    return turns.select("conv_id", "turn", role.alias("role"), as_text.alias("text"))


def ordered(edges: list[tuple[str, str, bool]]) -> dict[str, int]:
    """(call, needs, whether that is free of needs itself) of a conversation -> level of each call that gets all it needs, in topological order."""
    waits: dict[str, int] = {}
    users: dict[str, list[str]] = {}
    level: dict[str, int] = {}
    for call, needs, free in edges:
        waits[call] = waits.get(call, 0) + (not free)
        level[call] = 1
        if not free:
            users.setdefault(needs, []).append(call)
    ready = [c for c, n in waits.items() if not n]
    for call in ready:  # grows
        for user in users.get(call, ()):
            waits[user] -= 1
            level[user] = max(level[user], level[call] + 1)
            if not waits[user]:
                ready.append(user)
    return {c: level[c] for c in ready}


def _in_rounds(edges: DataFrame, free: DataFrame) -> DataFrame:
    """The levels of calls by rounds of joins, one for each step of the longest chain: for conversations of more dependencies than a task holds."""
    needed = edges.groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("n"))
    done = last = kept(free, "call-levels")
    parts_, met, level = [], None, 0
    while not last.isEmpty():
        level += 1
        now = edges.alias("e").join(last.alias("d"), F.expr("e.conv_id <=> d.conv_id AND e.needs = d.call_id")).groupBy("e.conv_id", "e.call_id").agg(F.count(F.lit(1)).alias("m"))
        met = kept((now if met is None else met.unionByName(now)).groupBy("conv_id", "call_id").agg(F.sum("m").alias("m")), "needs-met")
        ready = met.alias("y").join(needed.alias("x"), F.expr("x.conv_id <=> y.conv_id AND x.call_id = y.call_id AND x.n = y.m")).select("y.conv_id", "y.call_id")
        last = kept(ready.withColumn("level", F.lit(level)), "call-levels")
        parts_.append(last)
        met = met.join(ready.withColumnsRenamed({"conv_id": "rc", "call_id": "ri"}), F.expr("conv_id <=> rc AND call_id = ri"), "left_anti")
    out = done
    for part in parts_:
        out = out.unionByName(part)
    return out


def levels(calls: DataFrame, most: int = ONE_TASK) -> DataFrame:
    """calls(conv_id, call_id, depends_on), each once -> (conv_id, call_id, level): 0 without dependencies. Calls that never get all they depend on are left out.

    A conversation of at most so many dependencies is ordered in one pass, from these alone; larger ones in rounds of joins.
    """
    edges = cut(calls.select("conv_id", "call_id", F.explode(F.array_distinct("depends_on")).alias("needs")))
    free = calls.where(F.coalesce(F.size("depends_on"), F.lit(0)) <= 0).select("conv_id", "call_id", F.lit(0).alias("level"))
    if edges.isEmpty():
        return free

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(conv, c, n) for conv, listed in zip(b[0].to_pylist(), b[1].to_pylist()) for c, n in ordered([(e["call_id"], e["needs"], e["free"]) for e in listed]).items()]
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((b.schema.field(0).type, pa.string(), pa.int32()))], ["conv_id", "call_id", "level"])

    large = small_or_shuffled(edges.groupBy("conv_id").count().where(F.col("count") > most).select(F.col("conv_id").alias("large")))
    crowded = not large.isEmpty()
    few = edges.join(large, F.expr("conv_id <=> large"), "left_anti") if crowded else edges
    at_once = few.alias("e").join(free.alias("f"), F.expr("e.conv_id <=> f.conv_id AND e.needs = f.call_id"), "left").select("e.conv_id", "e.call_id", "e.needs", F.col("f.level").isNotNull().alias("free"))
    listed = at_once.groupBy("conv_id").agg(F.collect_list(F.struct("call_id", "needs", "free")).alias("edges"))
    found = listed.mapInArrow(run, f"conv_id {calls.schema['conv_id'].dataType.simpleString()}, call_id string, level int")
    if not crowded:
        return found.unionByName(free)
    apart = lambda df: df.join(large, F.expr("conv_id <=> large"), "left_semi")
    rest = free.join(large, F.expr("conv_id <=> large"), "left_anti")
    return found.unionByName(rest).unionByName(_in_rounds(cut(apart(edges)), apart(free)))


def link(conversations: DataFrame, tools: dict[str, dict] = TOOLS) -> DataFrame:
    """Every message, call and result of the conversations, with status, level, errors and its canonical JSON."""
    found = cut(parts(conversations, tools))
    place = F.struct("turn", "part")
    ids = Window.partitionBy("conv_id", "kind", F.coalesce("call_id", F.concat_ws("/", "turn", "part"))).orderBy("turn", "part", "body")  # one identifier's calls or results
    named = found.where("kind <> 'message'").withColumn("nth", F.row_number().over(ids))
    calls, results = named.where("kind = 'call'"), named.where("kind = 'result'")
    first = calls.where("nth = 1 AND call_id IS NOT NULL").select(F.col("conv_id").alias("cc"), F.col("call_id").alias("ci"), place.alias("asked"), F.col("name").alias("asked_name"))
    answer = results.where("nth = 1").select(F.col("conv_id").alias("ac"), F.col("call_id").alias("ai"), place.alias("answered"))
    at = levels(calls.where("nth = 1 AND call_id IS NOT NULL").select("conv_id", "call_id", "depends_on")).select(F.col("conv_id").alias("lc"), F.col("call_id").alias("li"), "level")
    calls = calls.join(answer, F.expr("conv_id <=> ac AND call_id = ai"), "left").join(at, F.expr("conv_id <=> lc AND call_id = li"), "left")
    call_status = F.when(F.col("call_id").isNull(), "unnamed").when(F.col("nth") > 1, "duplicate").when(F.col("answered").isNull(), "unanswered").when(F.col("answered") < place, "early").otherwise("linked")
    calls = calls.withColumn("status", call_status).withColumn("errors", F.when(F.col("level").isNull() & F.col("call_id").isNotNull(), F.concat("errors", F.array(F.lit("dependency")))).otherwise(F.col("errors")))
    results = results.join(first, F.expr("conv_id <=> cc AND call_id = ci"), "left").join(at, F.expr("conv_id <=> lc AND call_id = li"), "left")
    result_status = F.when(F.col("asked").isNull(), "orphan").when(F.col("nth") > 1, "duplicate").when(place < F.col("asked"), "early").otherwise("linked")
    results = results.withColumn("status", result_status).withColumn("name", F.col("asked_name"))
    columns = ["conv_id", "turn", "part", "role", "kind", "call_id", "name", "status", "level", "errors", "body"]
    messages = found.where("kind = 'message'").withColumns({"status": F.lit("message"), "level": F.lit(0)})
    every = messages.select(*columns).unionByName(calls.select(*columns)).unionByName(results.select(*columns))
    value = lambda c: F.when(F.col(c).isNull(), "null").otherwise(F.expr(f"substring({_sql_json(c)}, 6, length({_sql_json(c)}) - 6)"))
    text = F.concat(F.lit('{"body":'), "body", F.lit(',"call_id":'), value("call_id"), F.lit(',"kind":'), value("kind"), F.lit(',"name":'), value("name"), F.lit(',"role":'), value("role"), F.lit(',"status":'), value("status"), F.lit(',"turn":'), F.coalesce(F.col("turn").cast("string"), F.lit("null")), F.lit("}"))
    digits = lambda c, n: F.when(F.col(c) >= 0, F.lpad(F.col(c).cast("string"), n, "0")).otherwise("-")
    return every.withColumn("json", text).withColumn("place", F.concat_ws("/", digits("level", 10), digits("turn", 19), digits("part", 10)))


def _sql_json(column: str) -> str:
    return f"to_json(named_struct('v', {column}))"


def report(conversations: DataFrame) -> DataFrame:
    """The conversations, their dialogue read as calls of reply and their results."""
    return link(turns_as_calls(conversations)).select("conv_id", "turn", "part", "kind", "call_id", "status", "level", "place", F.array_join("errors", ",").alias("errors"), "json")


#: The report in DuckDB's SQL: turns are unique and plain in the test data, so neighbours are joins by turn; levels follow the dependencies.
ORACLE = """
WITH RECURSIVE t AS (
  SELECT a.conv_id, a.turn, a.role, coalesce(a.text, '') AS text, coalesce(n.role = 'assistant', false) AS answered, coalesce(p.role = 'user', false) AS asked, coalesce(b.role = 'user', false) AS follows
  FROM conversations a
  LEFT JOIN conversations n ON n.conv_id = a.conv_id AND n.turn = a.turn + 1
  LEFT JOIN conversations p ON p.conv_id = a.conv_id AND p.turn = a.turn - 1
  LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn - 2),
k AS (
  SELECT *, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
    CASE role WHEN 'user' THEN concat('turn-', turn + 1) WHEN 'assistant' THEN concat('turn-', turn) END AS call_id,
    CASE role WHEN 'user' THEN CASE WHEN answered THEN 'linked' ELSE 'unanswered' END WHEN 'assistant' THEN CASE WHEN asked THEN 'linked' ELSE 'orphan' END ELSE 'message' END AS status,
    CASE role WHEN 'user' THEN 'assistant' WHEN 'assistant' THEN 'tool' ELSE role END AS said_by,
    CASE WHEN role = 'user' THEN concat('{"question":', to_json(text), ',"turn":', turn, '}') ELSE to_json(text)::VARCHAR END AS body
  FROM t),
l AS (
  SELECT conv_id, call_id, turn, 0 AS level FROM k WHERE kind = 'call' AND NOT follows
  UNION ALL SELECT k.conv_id, k.call_id, k.turn, l.level + 1 FROM l JOIN k ON k.conv_id = l.conv_id AND k.turn = l.turn + 2 AND k.kind = 'call'),
r AS (
  SELECT k.*, CASE kind WHEN 'message' THEN 0 ELSE l.level END AS lev FROM k LEFT JOIN l ON l.conv_id = k.conv_id AND l.call_id = k.call_id)
SELECT conv_id, turn, CAST(0 AS INTEGER) AS part, kind, call_id, status, CAST(lev AS INTEGER) AS level,
  concat(coalesce(lpad(lev::VARCHAR, 10, '0'), '-'), '/', lpad(turn::VARCHAR, 19, '0'), '/0000000000') AS place,
  CASE WHEN kind = 'call' AND text = '' THEN '$.question:minLength' ELSE '' END AS errors,
  concat('{"body":', body, ',"call_id":', coalesce('"' || call_id || '"', 'null'), ',"kind":"', kind, '","name":', CASE WHEN kind = 'call' OR (kind = 'result' AND status = 'linked') THEN '"reply"' ELSE 'null' END,
    ',"role":"', said_by, '","status":"', status, '","turn":', turn, '}') AS json
FROM r
"""
