"""Reading tool calls and reasoning out of model responses."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from corpusflow.functions.text import SPACE, strip

CALL = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("arguments", T.StringType()),
        T.StructField("decoded", T.StringType()),
    ]
)
_CALL_ARROW = pa.list_(
    pa.struct([("position", pa.int32()), ("name", pa.string()), ("arguments", pa.string()), ("decoded", pa.string())])
)


def _text(value) -> str:
    return json.dumps(value, ensure_ascii=False)


def _read(position: int, body: str):
    try:
        call = json.loads(body)
    except (ValueError, RecursionError):
        return None
    call = call if isinstance(call, dict) else {}
    arguments = call.get("arguments", {})
    decoded = arguments
    if isinstance(arguments, str):
        try:
            decoded = json.loads(arguments)
        except (ValueError, RecursionError):
            decoded = {}
    name = call.get("name", "")
    return {
        "position": position,
        "name": name if isinstance(name, str) else _text(name),
        "arguments": _text(arguments),
        "decoded": _text(decoded),
    }


@F.arrow_udf(T.ArrayType(CALL))
def _strict_calls(lists: pa.Array) -> pa.Array:
    """Strict JSON, which Spark's parsers are not: they accept trailing text and single quotes."""
    rows = []
    for bodies in lists.to_pylist():
        found = [_read(i, b) for i, b in enumerate(bodies)] if bodies is not None else None
        rows.append(None if found is None else [c for c in found if c is not None])
    return pa.array(rows, _CALL_ARROW)


def decode_calls(bodies: Column) -> Column:
    """Only rows that have bodies reach Python."""
    return F.coalesce(_strict_calls(F.when(F.size(bodies) > 0, bodies)), F.array().cast(T.ArrayType(CALL)))


def call_bodies(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit("(?s)<tool_call>(.*?)</tool_call>"), F.lit(1))
    return F.transform(found, strip)


def parse_tool_calls(text: Column) -> Column:
    """Well-formed calls of one text as ``array<struct<position, name, arguments, decoded>>``.

    ``position`` counts every tagged body, malformed ones included; ``arguments`` is the JSON as
    sent; ``decoded`` has arguments that were sent as a JSON string parsed, or ``{}``.
    """
    return decode_calls(call_bodies(text))


def tool_calls_openai(text: Column) -> Column:
    """Calls whose body is an object, as ``array<struct<id, name, arguments>>``; null when none."""
    bodies = F.regexp_extract_all(
        text, F.lit(rf"(?s)<tool_call>{SPACE}*(\{{.*?\}}){SPACE}*</tool_call>"), F.lit(1)
    )
    calls = F.transform(
        decode_calls(bodies),
        lambda c: F.struct(
            F.concat(F.lit("call_"), c["position"].cast("string")).alias("id"),
            c["name"].alias("name"),
            c["arguments"].alias("arguments"),
        ),
    )
    return F.when(F.size(calls) > 0, calls)


def split_response(text: Column) -> Column:
    """``struct<content, reasoning, tool_calls, finish_reason>`` of one raw response."""
    closed = text.rlike("(?s)<think>.*?</think>")
    unopened = ~closed & F.contains(text, F.lit("</think>"))
    head = F.substring_index(text, "</think>", 1)
    tail = F.substring(text, F.length(head) + len("</think>") + 1, F.length(text))
    reasoning = F.when(closed, strip(F.regexp_extract(text, "(?s)<think>(.*?)</think>", 1))).when(
        unopened, strip(head)
    )
    rest = (
        F.when(closed, F.regexp_replace(text, rf"(?s)<think>.*?</think>{SPACE}*", ""))
        .when(unopened, strip(tail))
        .otherwise(text)
    )
    calls = parse_tool_calls(rest)
    some = F.size(calls) > 0
    content = strip(F.when(some, F.regexp_replace(rest, "(?s)<tool_call>.*?</tool_call>", "")).otherwise(rest))
    return F.struct(
        content.alias("content"),
        reasoning.alias("reasoning"),
        F.when(some, calls).alias("tool_calls"),
        F.when(some, F.lit("tool_calls")).otherwise(F.lit("stop")).alias("finish_reason"),
    )
