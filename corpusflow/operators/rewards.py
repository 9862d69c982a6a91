"""Tool-call checks and rule rewards over tables of responses."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions import parse, score
from corpusflow.operators.batching import with_positions


@dataclass(frozen=True)
class ToolSpec:
    """A known tool: arguments that must be given, and arguments that must only not be null."""

    name: str
    required: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()


# The argument rules of the built-in tools.
BUILT_IN_TOOLS = (
    ToolSpec("calculate_math", ("expression",)),
    ToolSpec("unit_converter", ("from_unit", "to_unit"), ("value",)),
    ToolSpec("get_current_weather", ("location",)),
    ToolSpec("get_current_time"),
    ToolSpec("get_exchange_rate", ("from_currency", "to_currency")),
    ToolSpec("translate_text", ("text", "target_language")),
)


def attach_tools(df: DataFrame, registry: DataFrame, key: str, names: str = "tool_names") -> DataFrame:
    """Definitions of the named tools, in the order named, as ``tools``; unknown names in ``unknown``."""
    named = df.select(key, F.posexplode_outer(names).alias("pos", "name"))
    found = named.join(registry, "name", "left")
    return found.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("definition").isNotNull(), F.struct("pos", "definition")))),
            lambda t: t["definition"],
        ).alias("tools"),
        F.array_sort(F.collect_set(F.when(F.col("definition").isNull(), F.col("name")))).alias("unknown"),
    )


def _argument(call: Column, name: str) -> Column:
    """JSON text of one argument; null when absent."""
    return F.to_json(F.try_variant_get(F.try_parse_json(call["decoded"]), f"$['{name}']", "variant"))


def is_valid_call(call: Column, offered: Column, specs: tuple[ToolSpec, ...]) -> Column:
    """The tool was offered with this sample, is known, and its arguments pass the tool's rule."""
    passes = F.lit(False)
    for spec in specs:
        ok = call["name"] == spec.name
        for name in spec.required:
            ok = ok & score.truthy(_argument(call, name))
        for name in spec.not_null:
            value = _argument(call, name)
            ok = ok & value.isNotNull() & (value != "null")
        passes = passes | F.coalesce(ok, F.lit(False))
    return passes & F.coalesce(F.array_contains(offered, call["name"]), F.lit(False))


def validate_calls(
    df: DataFrame, specs: tuple[ToolSpec, ...] = BUILT_IN_TOOLS, calls: str = "calls", offered: str = "offered"
) -> DataFrame:
    """Add ``n_calls`` and ``n_valid``. The rules are a few constants, so nothing is joined."""
    valid = F.filter(F.col(calls), lambda c: is_valid_call(c, F.col(offered), specs))
    return df.withColumns({"n_calls": F.size(calls), "n_valid": F.size(valid)})


def compile_registry(registry: DataFrame) -> DataFrame:
    """``name, required, not_null, types`` of a registry table ``name, parameters_json[, not_null]``.

    ``parameters_json`` is the JSON schema of a tool's arguments; of it count ``required`` and the ``type`` of each
    property. ``not_null`` lists arguments that may be empty but not null.
    """
    kind = "struct<properties:map<string,struct<type:string>>,required:array<string>>"
    schema = F.from_json("parameters_json", kind)
    none = F.array().cast("array<string>")
    return registry.select(
        "name",
        F.coalesce(schema["required"], none).alias("required"),
        (F.coalesce("not_null", none) if "not_null" in registry.columns else none).alias("not_null"),
        F.coalesce(F.map_entries(F.transform_values(schema["properties"], lambda _, p: p["type"])), F.array().cast("array<struct<key:string,value:string>>")).alias("types"),
    )


def _is_of_type(value: Column, kind: Column) -> Column:
    """Whether a JSON text is of a type of JSON schema; types that it does not know fit everything."""
    number = value.rlike(r"^-?[0-9]")
    whole = value.rlike(r"^-?[0-9]+(\.0+)?$")
    checks = {
        "string": value.startswith('"'), "object": value.startswith("{"), "array": value.startswith("["),
        "boolean": value.isin("true", "false"), "null": value == "null", "number": number, "integer": whole,
    }
    fits = F.lit(True)
    for name, check in checks.items():
        fits = F.when(kind == name, check).otherwise(fits)
    return fits


def validate_by_registry(
    df: DataFrame,
    registry: DataFrame,
    key: str,
    calls: str = "calls",
    offered: str = "offered",
    predicates: dict[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Add ``n_calls`` and ``n_valid``, by the rules of a registry table of any size (see :func:`compile_registry`).

    A call is valid if its tool was offered with the row and is registered, its required arguments are given, the
    ``not_null`` ones are not null, each argument that is given has its declared type, and the tool's predicate
    (of the arguments as a VARIANT), if it has one, holds. ``key`` tells rows apart, and names are unique.
    """
    each = df.select(key, F.col(offered).alias("_offered"), F.explode(calls).alias("_call"))
    parsed = each.select(key, "_offered", F.col("_call.name").alias("name"), F.try_parse_json(F.col("_call.decoded")).alias("_v"))
    joined = parsed.join(compile_registry(registry), "name", "left")

    def argument(name: Column) -> Column:
        return F.to_json(F.try_variant_get(F.col("_v"), F.concat(F.lit("$['"), name, F.lit("']")), "variant"))

    def given(value: Column) -> Column:
        return value.isNotNull() & (value != "null")

    ok = F.forall("required", lambda n: F.coalesce(score.truthy(argument(n)), F.lit(False)))
    ok &= F.forall("not_null", lambda n: F.coalesce(given(argument(n)), F.lit(False)))
    ok &= F.forall("types", lambda t: ~given(argument(t["key"])) | F.coalesce(_is_of_type(argument(t["key"]), t["value"]), F.lit(True)))
    for name, holds in (predicates or {}).items():
        ok &= (F.col("name") != name) | F.coalesce(holds(F.col("_v")), F.lit(False))
    valid = F.coalesce(ok & F.array_contains("_offered", F.col("name")), F.lit(False))
    counts = joined.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("n_calls"), F.count_if(valid).cast("int").alias("n_valid"))
    none = F.lit(0)
    return df.join(counts, key, "left").withColumns({c: F.coalesce(c, none) for c in ("n_calls", "n_valid")})


def join_prompts(prompts: DataFrame, completions: DataFrame, n: int) -> DataFrame:
    """Each completion with its prompt: the completion in place i belongs to the prompt in place i // n.

    Places are those of the rows in the tables as they are ordered, so both must have an order: that of one
    file, or of a sort. They are numbered by partition, without one window over all. Completions beyond the
    last prompt are an error in the data and are left out, as are prompts without one.
    """
    placed = with_positions(completions, "_at").withColumn("_prompt", F.expr(f"_at div {n}")).drop("_at")
    return with_positions(prompts, "_prompt").join(placed, "_prompt").drop("_prompt")


def merge_deltas(df: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """Join the fragments of each streamed tool call in arrival order."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order), "id", "name", "arguments")))
    merged = df.groupBy(*keys).agg(parts.alias("_p"))
    # Fragments without a value add nothing.
    joined = {
        n: F.array_join(F.transform("_p", lambda p: F.coalesce(p[n], F.lit(""))), "") for n in ("id", "name", "arguments")
    }
    return merged.withColumns(joined).drop("_p")


def chat_reward(
    df: DataFrame, response: str = "response", scorer: Column | None = None, min_len: int = 20
) -> DataFrame:
    """Add ``reward``: format score, less repetition, plus the clipped score of the answer."""
    text = F.col(response)
    given = score.clip_score(scorer) if scorer is not None else F.lit(0.0)
    total = score.format_score(text, min_len) - score.rep_penalty(score.answer_text(text)) + given
    return df.withColumn("reward", total)


def agent_reward(
    df: DataFrame,
    specs: tuple[ToolSpec, ...] = BUILT_IN_TOOLS,
    response: str = "response",
    turns: str = "turns",
    gt: str = "gt",
    offered: str = "offered",
    unfinished: str = "unfinished",
    scorer: Column | None = None,
    bound: float = 3.0,
) -> DataFrame:
    """Add ``reward`` (and the call counts it rests on) to completed agent runs; row-local.

    Runs without a call are scored by format, runs with calls by the calls and the expected answers.
    """
    bodies = F.flatten(F.transform("_answers", parse.call_bodies))
    staged = (
        df.withColumn("_answers", F.transform(turns, score.after_think))
        .withColumn("_last", F.coalesce(F.get("_answers", F.size("_answers") - 1), score.strip(F.col(response))))
        .withColumn("_calls", parse.decode_calls(bodies))
    )
    staged = validate_calls(staged, specs, "_calls", offered)
    open_ended = F.coalesce(F.col(unfinished), F.lit(False))
    text, last = F.col(response), F.col("_last")
    penalty = score.tag_penalty(F.col("_answers"))

    plain_answer = F.when(F.contains(text, F.lit("</think>")), score.after_think(text)).otherwise(last)
    given = score.clip_score(scorer) if scorer is not None else F.lit(0.0)
    plain = score.format_score(text, 5) + given - score.rep_penalty(plain_answer)

    final = F.when(open_ended, F.lit("")).otherwise(F.substring_index(last, "</tool_call>", -1))
    expected = F.coalesce(F.size(gt), F.lit(0))
    found = F.size(score.verify_gt(final, F.col(gt)))
    called = (
        score.tool_gap_score(F.col("n_valid"), expected, F.col("n_calls"))
        + F.when(expected > 0, found * 2.5 / expected).otherwise(F.lit(0.0))
        - F.when(open_ended, F.lit(0.5)).otherwise(F.lit(0.0))
        - score.rep_penalty(F.when(final != "", final).otherwise(last))
    )
    total = F.when(F.col("n_calls") > 0, called).otherwise(plain) - penalty
    return staged.withColumn("reward", score.clip_score(total, bound)).drop("_answers", "_calls", "_last")
