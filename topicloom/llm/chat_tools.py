"""Tool-call linking for chats: calls and results by identifier, in topological order, as canonical JSON.

Calls are hash-joined to their results by conversation and identifier. A call may wait for any number of others of its
conversation; its level is the length of the longest way of waiting before it, so levels order the calls topologically.
Calls in a circle, or that wait for one, have a null level. Arguments are checked against the JSON schema of their tool
and written in canonical form: keys sorted, no spaces.

Levels come in rounds over a table of edges. An edge to a call that waits for nothing becomes a number; an edge to a
call that waits for one other jumps over it, so chains halve in each round; only calls that wait for several others take
a round for each such call on their longest way. Joins are salted by the number of rows of a key.

Each call row gives one row, equal rows equal ones; no calls give no rows. Of several results of a call the earliest
counts (then the smallest text), and their number is told; ``unmatched_results`` gives those of no call. Calls whose
conversation or identifier is null are never linked. A call waiting for one that does not exist waits for nothing.
Arguments that are null, no JSON, or nested deeper than ``DEEPEST`` are an error and null in the JSON. Texts may be
empty or as long as a row; half a surrogate pair is written as an escape. Only the named columns are read.
"""

from __future__ import annotations

import json
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import stored
from topicloom.operators.skew import join_weighted

TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
#: Schema words that are understood; others are refused before any row is read.
WORDS = {"type", "enum", "const", "anyOf", "minLength", "maxLength", "pattern", "minimum", "maximum", "items", "minItems", "maxItems", "required", "properties", "additionalProperties", "title", "description"}
#: Depth of nested arguments that are read.
DEEPEST = 100
#: The level of circles while it is computed.
NEVER = 1 << 60


def check_schema(schema, at: str = "$") -> None:
    """Raise for a schema with words or types that would be passed over."""
    if not isinstance(schema, dict) or (unknown := set(schema) - WORDS):
        raise ValueError(f"{at}: schema words not supported: {sorted(unknown) if isinstance(schema, dict) else schema}")
    for kind in _types(schema):
        if kind not in TYPES and kind not in ("integer", "number"):
            raise ValueError(f"{at}: type {kind!r}")
    re.compile(schema.get("pattern", ""))
    if not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"{at}: additionalProperties must be true or false")
    inner = [*schema.get("anyOf", ()), *schema.get("properties", {}).values(), *([schema["items"]] if "items" in schema else [])]
    for i, part in enumerate(inner):
        check_schema(part, f"{at}/{i}")


def _types(schema: dict) -> list:
    want = schema.get("type", [])
    return want if isinstance(want, list) else [want]


def _is_number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _is(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        return _is_number(value) and (kind == "number" or value == math.floor(value))
    return isinstance(value, TYPES[kind])


def _same(a, b) -> bool:
    """Equal as JSON: ``true`` is not 1, and 1.0 is."""
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(_same(a[k], b[k]) for k in a)
    return a == b and isinstance(a, bool) == isinstance(b, bool)


def schema_error(value, schema: dict, at: str = "$") -> str | None:
    """The first breach of ``schema``, in the order of ``WORDS``."""
    want = schema.get("type")
    if want is not None and not any(_is(value, kind) for kind in _types(schema)):
        return f"{at}: not {want if isinstance(want, str) else ' or '.join(want)}"
    if "enum" in schema and not any(_same(value, x) for x in schema["enum"]):
        return f"{at}: not in enum"
    if "const" in schema and not _same(value, schema["const"]):
        return f"{at}: not the constant"
    if "anyOf" in schema and all(schema_error(value, x, at) for x in schema["anyOf"]):
        return f"{at}: none of the choices"
    if isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
            return f"{at}: length"
        if not re.search(schema.get("pattern", ""), value):
            return f"{at}: pattern"
    if _is_number(value) and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        return f"{at}: limit"
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            return f"{at}: items"
        found = (schema_error(x, schema.get("items", {}), f"{at}[{i}]") for i, x in enumerate(value))
        return next(filter(None, found), None)
    if isinstance(value, dict):
        for name in schema.get("required", ()):
            if name not in value:
                return f"{at}.{name}: missing"
        known = schema.get("properties", {})
        for name in sorted(value):
            if name not in known:
                if schema.get("additionalProperties", True) is False:
                    return f"{at}.{name}: unknown"
            elif error := schema_error(value[name], known[name], f"{at}.{name}"):
                return error
    return None


def _whole(text: str) -> str:
    """Half surrogate pairs, which no column can hold, as escapes."""
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value) -> str:
    return _whole(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def _depth_within(value, most: int) -> bool:
    layer = [value]
    for _ in range(most + 1):
        layer = [x for v in layer if isinstance(v, (list, dict)) for x in (v.values() if isinstance(v, dict) else v)]
        if not layer:
            return True
    return False


def _parsed(arguments: str | None):
    def refuse(name):
        raise ValueError(name)

    def finite(text):
        return x if math.isfinite(x := float(text)) else refuse(text)

    try:
        value = json.loads(arguments, parse_constant=refuse, parse_float=finite)
    except RecursionError:
        return None, "$: nested too deeply"
    except (TypeError, ValueError):
        return None, "$: not JSON"
    return (value, None) if _depth_within(value, DEEPEST) else (None, "$: nested too deeply")


def _key(conversation: str, call: str) -> Column:
    """One text for both; null if one is. The length keeps the two apart."""
    first = F.col(conversation).cast("string")
    return F.concat(F.length(first).cast("string"), F.lit(":"), first, F.col(call))


def levels(calls: DataFrame, waits: DataFrame | None = None) -> DataFrame:
    """(key, level) of the distinct calls of (conv_id, call_id, after).

    ``waits``: further edges (conv_id, call_id, after).
    """
    nodes = stored(calls.select(_key("conv_id", "call_id").alias("key")).filter("key IS NOT NULL").distinct().withColumn("base", F.lit(0).cast("long")), "nodes")
    pairs = lambda df: df.select(_key("conv_id", "call_id").alias("key"), _key("conv_id", "after").alias("up"))
    edges = pairs(calls) if waits is None else pairs(calls).unionByName(pairs(waits))
    edges = edges.filter("key IS NOT NULL AND up IS NOT NULL").distinct()
    edges = edges.join(nodes.select("key"), "key", "left_semi").join(nodes.select(F.col("key").alias("up")), "up", "left_semi")
    edges = stored(edges.withColumn("w", F.lit(1).cast("long")), "edges")
    most, bases = nodes.count(), nodes
    while edges.limit(1).count():
        ways = edges.groupBy("key").agg(F.count("*").alias("ways"), F.max("up").alias("next"), F.max("w").alias("more"))
        asked = edges.groupBy(F.col("up").alias("key")).agg(F.count("*").alias("weight"))
        state = stored(asked.join(bases, "key").join(ways, "key", "left").withColumnRenamed("key", "up"), "state")
        step = join_weighted(edges, state, "up", "weight", ["key"])
        free, one = F.col("ways").isNull(), F.coalesce(F.col("ways") == 1, F.lit(False))
        to = F.when(one, F.col("next")).when(~free, F.col("up"))
        length = F.col("w") + F.when(one, F.col("more")).otherwise(0)
        # No way without a circle is as long as the calls are many.
        never = to.isNotNull() & (length > most)
        known = F.when(never, F.lit(NEVER)).when(free | one, F.col("base") + F.col("w"))
        step = stored(step.select("key", F.when(~never, to).alias("to"), length.alias("w"), known.alias("known"), (free | one).alias("moved")), "step")
        if not step.filter("moved").limit(1).count():
            break
        found = step.groupBy("key").agg(F.max("known").alias("known"))
        bases = stored(bases.join(found, "key", "left").select("key", F.greatest("base", F.coalesce("known", F.lit(0))).alias("base")), "bases")
        edges = stored(step.filter("to IS NOT NULL").groupBy("key", F.col("to").alias("up")).agg(F.max("w").alias("w")), "edges")
    # What still waits goes round among calls that wait for several.
    left = edges.select("key").distinct().withColumn("waits", F.lit(True))
    return bases.join(left, "key", "left").select("key", F.when(F.col("waits").isNull() & (F.col("base") < NEVER), F.col("base")).alias("level"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], waits: DataFrame | None = None) -> DataFrame:
    """A row for each call: conv_id, call_id, level, n_results, error, json.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), after (an identifier or null).
    ``results``: conv_id, call_id, turn, content. ``waits``: conv_id, call_id, after, where calls wait for several.
    """
    for name, schema in schemas.items():
        check_schema(schema, name)
    keyed = calls.select("conv_id", "call_id", "turn", "name", "arguments", _key("conv_id", "call_id").alias("key"))
    first = results.select(_key("conv_id", "call_id").alias("key"), "turn", "content").filter("key IS NOT NULL")
    first = first.groupBy("key").agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
    rows_of = keyed.filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("weight"))
    found = rows_of.join(levels(calls, waits), "key").join(first, "key", "left")
    found = stored(found.select("key", "weight", "level", F.coalesce("n_results", F.lit(0)).alias("n_results"), F.col("r.content").alias("content")), "links")
    linked = join_weighted(keyed.filter("key IS NOT NULL"), found, "key", "weight", ["turn", "name", "arguments"])
    none = keyed.filter("key IS NULL").withColumns({"level": F.lit(None).cast("long"), "n_results": F.lit(0).cast("long"), "content": F.lit(None).cast("string")})
    names = ["conv_id", "call_id", "turn", "level", "n_results", "name", "arguments", "content"]
    rows = linked.select(*names).unionByName(none.select(*names))

    def serialise(batches):
        for batch in batches:
            errors, texts = [], []
            for row in batch.select(["call_id", "name", "arguments", "content"]).to_pylist():
                value, error = _parsed(row["arguments"])
                if error is None:
                    error = schema_error(value, schemas[row["name"]]) if row["name"] in schemas else "$: unknown tool"
                errors.append(error and _whole(error))
                texts.append(canonical({"arguments": value, "error": error, "id": row["call_id"], "name": row["name"], "result": row["content"]}))
            kept = [batch.column(i) for i in range(5)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(errors, pa.string()), pa.array(texts, pa.string())], ["conv_id", "call_id", "turn", "level", "n_results", "error", "json"])

    schema = rows.select("conv_id", "call_id", "turn", "level", "n_results").schema.add("error", "string").add("json", "string")
    return rows.mapInArrow(serialise, schema)


def unmatched_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """(conv_id, call_id, turn, content) of the results that belong to no call."""
    keyed = results.select("conv_id", "call_id", "turn", "content", _key("conv_id", "call_id").alias("key"))
    known = calls.select(_key("conv_id", "call_id").alias("key")).filter("key IS NOT NULL").distinct()
    lost = keyed.filter("key IS NOT NULL").join(known, "key", "left_anti").drop("key")
    return lost.unionByName(keyed.filter("key IS NULL").drop("key"))


#: The tool that the conversations of the tables call: a question goes out, the next turn is its result.
ASK = {"ask": {"type": "object", "required": ["question", "words"], "additionalProperties": False, "properties": {"question": {"type": "string", "minLength": 1}, "words": {"type": "integer", "minimum": 4}}}}


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of (conv_id, turn, role, text): a user's turn asks, an assistant's next turn answers.

    A question waits for the one two turns before it, if that was a question. Of equal rows one counts.
    """
    turns = conversations.select("conv_id", "turn", "role", "text").distinct()
    name = lambda turn: F.concat(F.lit("call_"), F.col("conv_id"), F.lit("_"), turn)
    words = F.size(F.filter(F.split("text", " "), lambda x: x != ""))
    calls = turns.filter("role = 'user'").select(
        "conv_id", name(F.col("turn")).alias("call_id"), "turn", F.lit("ask").alias("name"),
        F.to_json(F.struct(F.col("text").alias("question"), F.when(F.col("text").isNotNull(), words).alias("words"))).alias("arguments"),
        name(F.col("turn") - 2).alias("after"),
    )
    results = turns.filter("role = 'assistant'").select("conv_id", name(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (SELECT *, 'call_' || conv_id || '_' || turn AS call_id, len(list_filter(string_split(text, ' '), lambda x: x <> '')) AS words FROM t WHERE role = 'user'),
l AS (SELECT *, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain FROM
    (SELECT *, turn - coalesce(lag(turn) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn), -9) <> 2 AS gap FROM c)),
r AS (SELECT conv_id, turn - 1 AS turn, min(text) AS content, count(*) AS n FROM t WHERE role = 'assistant' GROUP BY ALL),
e AS (SELECT l.*, r.content, coalesce(r.n, 0) AS n_results, CASE WHEN text = '' THEN '$.question: length' WHEN words < 4 THEN '$.words: limit' END AS error,
    row_number() OVER (PARTITION BY l.conv_id, l.turn % 2, chain ORDER BY l.turn) - 1 AS level FROM l LEFT JOIN r ON l.conv_id = r.conv_id AND l.turn = r.turn)
SELECT conv_id, call_id, turn, level, n_results, error, '{"arguments":{"question":' || to_json(text) || ',"words":' || words || '},"error":' ||
    coalesce(to_json(error)::VARCHAR, 'null') || ',"id":"' || call_id || '","name":"ask","result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS json FROM e
"""
