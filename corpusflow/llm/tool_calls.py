"""Linking tool calls to their results, ordering them by their references, and writing canonical JSON."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.llm.tables import stored

# A string argument ``$name`` stands for the result of the call with that identifier.
REFERENCE = re.compile(r"\$([A-Za-z0-9_-]+)")
KINDS = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}
# Keywords of JSON schema that are checked, and those that say nothing about values.
CHECKED = frozenset(
    "type enum minimum maximum minLength maxLength pattern required properties additionalProperties items minItems maxItems".split()
)
NOTES = frozenset("title description default examples $schema $id $comment".split())
# Calls of one conversation that are put in order in one task; longer conversations go in rounds of joins.
CALL_BUDGET = 100_000


def number(text: str) -> float:
    value = float(text)
    if math.isinf(value):
        raise ValueError("a number beyond the range")
    return value


def refuse(text: str) -> None:
    raise ValueError(f"{text} is not JSON")


def plain(value: object) -> object:
    """Numbers that are equal in the same form: whole ones as integers, up to where these get long."""
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [plain(v) for v in value]
    if isinstance(value, float) and value.is_integer() and abs(value) < 1e21:
        return int(value)
    if isinstance(value, int) and abs(value) >= 10**21 and abs(value) < 10**300 and float(value) == value:
        return float(value)
    return value


def read_json(text: str) -> object:
    """The value of a JSON text. Names that JSON lacks (NaN) and numbers beyond its range are errors."""
    return plain(json.loads(text, parse_float=number, parse_constant=refuse))


def canonical(value: object) -> str:
    """JSON with sorted keys, no spaces, and characters as they are; equal values give equal strings."""
    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def is_a(value: object, kind: str | list[str]) -> bool:
    if isinstance(kind, list):
        return any(is_a(value, k) for k in kind)
    if isinstance(value, bool) or kind not in ("integer", "number"):
        return isinstance(value, KINDS.get(kind, ()))
    return isinstance(value, int) or isinstance(value, float) and (kind == "number" or value.is_integer())


def check_schema(schema: object, path: str = "") -> None:
    """An error for what :func:`faults` would not look at, so that no rule is passed over in silence."""
    if not isinstance(schema, dict):
        raise ValueError(f"{path or '.'}: a schema must be an object")
    if unknown := set(schema) - CHECKED - NOTES:
        raise ValueError(f"{path or '.'}: keywords that are not checked: {sorted(unknown)}")
    kinds = schema.get("type", [])
    if unknown := set(kinds if isinstance(kinds, list) else [kinds]) - set(KINDS) - {"integer", "number"}:
        raise ValueError(f"{path or '.'}: unknown types: {sorted(unknown)}")
    re.compile(schema.get("pattern", ""))
    for name, one in schema.get("properties", {}).items():
        check_schema(one, f"{path}.{name}")
    for name in ("items", "additionalProperties"):
        if not isinstance(schema.get(name, True), bool):
            check_schema(schema[name], f"{path}.{name}")


def faults(value: object, schema: dict, path: str = "") -> list[str]:
    """What in ``value`` does not fit ``schema``, by the keywords in ``CHECKED``. A reference fits any schema."""
    if isinstance(value, str) and REFERENCE.fullmatch(value):
        return []
    here = path or "."
    kind = schema.get("type")
    if kind and not is_a(value, kind):
        return [f"{here}: not {' or '.join(kind) if isinstance(kind, list) else kind}"]
    out = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        out.append(f"{here}: not in enum")
    if is_a(value, "number"):
        if value < schema.get("minimum", value):
            out.append(f"{here}: below minimum")
        if value > schema.get("maximum", value):
            out.append(f"{here}: above maximum")
    for of, least, most in ((str, "minLength", "maxLength"), (list, "minItems", "maxItems")):
        if isinstance(value, of):
            if len(value) < schema.get(least, 0):
                out.append(f"{here}: shorter than {least}")
            if len(value) > schema.get(most, len(value)):
                out.append(f"{here}: longer than {most}")
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        out.append(f"{here}: not of the pattern")
    if isinstance(value, dict):
        known, other = schema.get("properties", {}), schema.get("additionalProperties", True)
        out += [f"{path}.{name}: missing" for name in sorted(set(schema.get("required", ())) - set(value))]
        for name in sorted(value):
            if name in known:
                out += faults(value[name], known[name], f"{path}.{name}")
            elif other is False:
                out.append(f"{path}.{name}: unknown")
            elif other is not True:
                out += faults(value[name], other, f"{path}.{name}")
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for i, one in enumerate(value):
            out += faults(one, schema["items"], f"{path}[{i}]")
    return out


def references(value: object) -> set[str]:
    if isinstance(value, str):
        return {m[1]} if (m := REFERENCE.fullmatch(value)) else set()
    parts = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return set().union(*map(references, parts))


def parsed(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Adds ``arguments`` in canonical form (null if malformed), ``errors`` and ``needs``, from ``raw``."""

    def check(raw: str | None, name: str | None) -> tuple[str | None, list[str], list[str]]:
        try:
            value = read_json(raw) if raw and raw.strip() else {}
            text = canonical(value)
            text.encode()
            found = faults(value, schemas[name]) if name in schemas else ["unknown tool"]
            return text, found, sorted(references(value))
        except (ValueError, RecursionError):
            return None, ["malformed arguments"], []

    @F.arrow_udf("struct<arguments:string,errors:array<string>,needs:array<string>>")
    def parse(raw: pa.Array, name: pa.Array) -> pa.Array:
        rows = [check(r, n) for r, n in zip(raw.to_pylist(), name.to_pylist())]
        text, errors, needs = zip(*rows) if rows else ((), (), ())
        strings = pa.list_(pa.string())
        columns = [pa.array(text, pa.string()), pa.array(errors, strings), pa.array(needs, strings)]
        return pa.StructArray.from_arrays(columns, ["arguments", "errors", "needs"])

    return calls.withColumn("parsed", parse(F.col("raw"), F.col("name"))).select(*[c for c in calls.columns if c != "raw"], "parsed.*")


def in_order(needs: dict[str, list[str]]) -> dict[str, int]:
    """Levels of one conversation's calls: 0 without needs, else one more than the highest of them."""
    wanted = {c: [n for n in dict.fromkeys(ns) if n in needs] for c, ns in needs.items()}
    users: dict[str, list[str]] = {}
    for call, ns in wanted.items():
        for n in ns:
            users.setdefault(n, []).append(call)
    open_needs = {c: len(ns) for c, ns in wanted.items()}
    level = {c: 0 for c, n in open_needs.items() if not n}
    ready = list(level)
    while ready:
        call = ready.pop()
        for user in users.get(call, ()):
            level[user] = max(level.get(user, 0), level[call] + 1)
            open_needs[user] -= 1
            if not open_needs[user]:
                ready.append(user)
    return {c: at for c, at in level.items() if not open_needs[c]}


def levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of ``calls(conv_id, call_id, needs)``: 0 without needs that exist,
    else one more than the highest of them. Calls on or behind a cycle are left out.

    Conversations of up to ``CALL_BUDGET`` calls are put in order in one task each, however long their chains
    of references are; only longer ones take a round of joins for each link.
    """
    many = calls.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CALL_BUDGET).select("conv_id")
    many = stored(many, "long-conversations")  # a row for so many calls, at most

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for conv, own in groupby(rows, lambda r: r[0]):
            found = in_order({call: needs or [] for _, call, needs in own})
            columns = [pa.array([conv] * len(found), ids), pa.array(found, pa.string()), pa.array(found.values(), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "call_id", "level"])

    ids = pa.string() if calls.schema["conv_id"].dataType.simpleString() == "string" else pa.int64()
    few = calls.join(F.broadcast(many), "conv_id", "left_anti").select("conv_id", "call_id", "needs")
    ordered = few.repartition("conv_id").sortWithinPartitions("conv_id")
    kind = calls.schema["conv_id"].dataType.simpleString()
    out = ordered.mapInArrow(order, f"conv_id {kind}, call_id string, level int")
    return out if many.isEmpty() else out.unionByName(levels_by_rounds(calls.join(F.broadcast(many), "conv_id", "left_semi")))


def levels_by_rounds(calls: DataFrame) -> DataFrame:
    """The same as :func:`levels`, by joins. Each round settles the calls whose needs are settled, so rounds
    follow the longest chain of references; what is left shrinks and is stored, and a round that settles
    nothing ends it.
    """
    known = calls.select("conv_id", F.col("call_id").alias("need"))
    edges = calls.select("conv_id", "call_id", F.explode(F.array_distinct("needs")).alias("need")).join(known, ["conv_id", "need"])
    edges = stored(edges, "call-edges")
    settled = calls.select("conv_id", "call_id").join(edges, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(0))
    settled = stored(settled, "call-levels")
    waiting = edges.withColumn("above", F.lit(-1))
    done = [settled]
    while True:
        fresh = settled.select("conv_id", F.col("call_id").alias("need"), F.col("level").alias("met"))
        tried = waiting.join(fresh, ["conv_id", "need"], "left").withColumn("above", F.greatest("above", F.coalesce("met", F.lit(-1))))
        ready = tried.groupBy("conv_id", "call_id").agg(F.max("above").alias("level"), F.min(F.col("above") >= 0).alias("all"))
        settled = stored(ready.filter("all").select("conv_id", "call_id", (F.col("level") + 1).alias("level")), "call-levels")
        if settled.isEmpty():
            break
        done.append(settled)
        waiting = stored(tried.drop("met").join(settled, ["conv_id", "call_id"], "left_anti"), "call-waiting")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call and per result without a call, with the canonical JSON to train on.

    ``calls(conv_id, turn, pos, call_id, name, raw)`` hold raw JSON arguments; ``results(conv_id, turn,
    call_id, content)``; ``schemas`` maps a tool's name to the JSON schema of its arguments. Other columns
    are ignored. Columns returned: ``conv_id, turn, pos, call_id, name, status, level, valid, errors, json``.

    A call and the first result of its identifier in its conversation that comes after it are linked
    (``linked``); a call without one is ``unanswered``, a result without a call, or before it, an
    ``orphan``, and further results of a call are ``repeated``. Of calls that repeat an identifier, the
    first by turn and position counts, the others are ``repeated``. A null conversation or identifier
    joins nothing. ``level`` orders calls by their ``$identifier`` references (null on or behind a cycle,
    which is an error of the call, and for results): a conversation's topological order is that of
    ``level, turn, pos``. A call is ``valid`` without errors in its arguments; malformed, deeply nested or
    empty JSON gives a row too, and so do numbers that JSON does not have. Empty tables give an empty result.
    A schema with keywords other than ``CHECKED`` and ``NOTES`` is an error at once.

    Calls and results meet in a hash join on conversation and identifier, and all ordering is relative to
    one identifier, so a conversation of any length never has to fit a task.
    """
    for schema in schemas.values():
        check_schema(schema)
    order = Window.partitionBy("conv_id", "call_id").orderBy("turn", "pos", "name", "raw")
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    plain_calls = calls.select("conv_id", "turn", "pos", "call_id", "name", "raw")
    numbered = plain_calls.filter(named).withColumn("first", F.row_number().over(order) == 1)
    lone = plain_calls.filter(~named).withColumn("first", F.lit(False))  # these never meet in one group
    ranked = stored(parsed(numbered.unionByName(lone), schemas), "tool-calls")
    firsts = ranked.filter("first")
    starts = firsts.select("conv_id", "call_id", F.col("turn").alias("call_turn"))
    answers = results.select("conv_id", F.col("turn").alias("result_turn"), "call_id", "content").join(starts, ["conv_id", "call_id"], "left")
    answers = answers.withColumn("answers", F.coalesce(F.col("result_turn") > F.col("call_turn"), F.lit(False)))
    by_turn = Window.partitionBy("conv_id", "call_id", "answers").orderBy("result_turn", "content")
    numbered = answers.filter("answers").withColumn("nth", F.row_number().over(by_turn))
    answers = stored(numbered.unionByName(answers.filter("not answers").withColumn("nth", F.lit(0))), "tool-results")
    chosen = answers.filter("answers and nth = 1").select("conv_id", "call_id", "result_turn", "content")
    placed = firsts.join(levels(firsts), ["conv_id", "call_id"], "left").join(chosen, ["conv_id", "call_id"], "left")
    again = ranked.filter(~F.col("first")).withColumns(
        {"level": F.lit(None).cast("int"), "result_turn": F.lit(None).cast("long"), "content": F.lit(None).cast("string")}
    )
    cyclic = F.col("first") & F.col("level").isNull()
    rows = placed.unionByName(again).withColumns(
        {
            "status": F.when(named & ~F.col("first"), "repeated").when(F.col("result_turn").isNotNull(), "linked").otherwise("unanswered"),
            "errors": F.when(cyclic, F.concat("errors", F.array(F.lit("cyclic reference")))).otherwise(F.col("errors")),
        }
    )
    extra = answers.filter("not (answers and nth = 1)").select(
        "conv_id",
        F.col("result_turn").cast("long").alias("turn"),
        F.lit(None).cast("int").alias("pos"),
        "call_id",
        F.lit(None).cast("string").alias("name"),
        F.when(F.col("answers"), "repeated").otherwise("orphan").alias("status"),
        F.lit(None).cast("int").alias("level"),
        F.array().cast("array<string>").alias("errors"),
        F.lit(None).cast("string").alias("arguments"),
        F.lit(None).cast("long").alias("result_turn"),
        "content",
    )
    every = rows.select(*extra.columns).unionByName(extra)
    return every.select(
        "conv_id",
        "turn",
        "pos",
        "call_id",
        "name",
        "status",
        "level",
        (F.size("errors") == 0).alias("valid"),
        "errors",
        as_json(F.struct("conv_id", "turn", "call_id", "name", "arguments", "content", "status", "result_turn")).alias("json"),
    )


def as_json(row: Column) -> Column:
    """A line of canonical JSON for each row: arguments are embedded as the value they are."""

    @F.arrow_udf("string")
    def write(rows: pa.Array) -> pa.Array:
        def one(r: dict) -> str:
            line = {"conversation": r["conv_id"], "id": r["call_id"], "status": r["status"], "turn": r["turn"]}
            if r["name"] is not None:
                line |= {"name": r["name"]}
                # Already canonical; null stands for malformed arguments.
                line["arguments"] = json.loads(r["arguments"]) if r["arguments"] is not None else None
            if r["content"] is not None:
                line["result"] = {"content": r["content"], "turn": r["result_turn"] if r["result_turn"] is not None else r["turn"]}
            return canonical(line)

        return pa.array([one(r) for r in rows.to_pylist()], pa.string())

    return write(row)


# Tools of the derived calls, for the registered query.
SCHEMAS = {
    "search": {
        "type": "object",
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 500}, "after": {"type": "string"}},
        "required": ["query"],
        "additionalProperties": False,
    },
    "lookup": {
        "type": "object",
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer"}, "after": {"type": "string"}},
        "required": ["query", "after"],
    },
}


def calls_from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results derived from plain conversations: each assistant turn becomes a call whose
    arguments carry its text, refer to the assistant turn two before, and are answered by the next turn.
    Where a turn's text has a length divisible by 7 the JSON is cut short; by 11, the result is missing."""

    def ident(turn: Column) -> Column:
        return F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))

    said = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).filter(F.col("turn").isNotNull())
    n = F.length("text")
    spoken = said.filter("role = 'assistant'")
    before = F.when(F.col("turn") >= 2, F.concat(F.lit("$"), ident(F.col("turn") - 2)))
    raw = F.to_json(F.struct(before.alias("after"), n.alias("limit"), F.col("text").alias("query")))
    raw = F.when(n % 7 == 0, F.left(raw, F.length(raw) - 2)).otherwise(raw)
    name = F.when(n % 3 == 0, "lookup").otherwise("search")
    calls = spoken.select("conv_id", "turn", F.lit(0).alias("pos"), ident(F.col("turn")).alias("call_id"), name.alias("name"), raw.alias("raw"))
    results = said.filter((F.col("turn") >= 1) & (F.col("role") != "assistant") & (n % 11 != 0)).select(
        "conv_id", "turn", ident(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results
