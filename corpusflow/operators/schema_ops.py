"""Column renaming, required fields, and guessing what kind of records a table or file holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusflow.functions.text import text_view
from corpusflow.schemas import ALIASES, REQUIRED, ROLES

# File-name keywords per task, first group wins.
TASK_KEYWORDS = (
    ("pretrain", ("pretrain",)),
    ("full_sft", ("sft", "chat", "instruct", "conversation")),
    ("dpo", ("dpo", "preference", "chosen", "reject")),
    ("grpo", ("rl", "rlaif", "reward")),
    ("agent", ("agent", "tool", "function_call")),
    ("lora", ("lora", "medical", "domain")),
)
DEFAULT_TASK = "full_sft"

# Names of the column that holds the text, per rule.
MAIN_TEXT = ("text", "conversations", "chosen")
FIRST_TEXT = ("text", "content", "prompt", "conversations", "messages", "input")


def normalize_schema(df: DataFrame, kind: str) -> DataFrame:
    """Rename alternative columns to the kind's canonical names.

    When several columns mean the same field, the canonical one is preferred and the others fill
    its nulls.
    """
    for target, others in ALIASES.get(kind, {}).items():
        present = [c for c in (target, *others) if c in df.columns]
        if present == [target] or not present:
            continue
        if len(present) == 1:
            df = df.withColumnRenamed(present[0], target)
        else:
            merged = F.coalesce(*[F.col(c) for c in present])
            df = df.withColumn(target, merged).drop(*[c for c in present if c != target])
    return df


def validate_schema(df: DataFrame, kind: str, strict: bool = False) -> DataFrame:
    """Keep rows whose required fields are all set; an absent column passes unless ``strict``."""
    required = REQUIRED.get(kind, ())
    missing = [c for c in required if c not in df.columns]
    if strict and missing:
        raise ValueError(f"{kind} records need the columns {missing}")
    for name in required:
        if name in df.columns:
            df = df.filter(F.col(name).isNotNull())
    return df


def detect_kind(df: DataFrame) -> str:
    """Kind of a whole table, from its column names."""
    names = set(df.columns)
    if {"chosen", "rejected"} <= names:
        return "dpo"
    if "conversations" in names:
        return "agent" if "gt" in names else "sft"
    if "text" in names:
        return "pretrain"
    if names & {"messages", "dialog", "chat"}:
        return "sft"
    return "pretrain" if names & {"content", "passage", "document"} else "unknown"


def detect_kind_col(record: Column) -> Column:
    """Kind of every record of a column of JSON objects."""
    keys = F.json_object_keys(record)

    def has(*names):
        found = F.lit(False)
        for name in names:
            found = found | F.array_contains(keys, name)
        return F.coalesce(found, F.lit(False))

    turns = F.from_json(
        F.get_json_object(record, "$.conversations"),
        T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])),
    )
    last = F.get(turns, F.size(turns) - 1)
    asks = (last["role"] == "user") & (F.coalesce(last["content"], F.lit("")) == "")
    return (
        F.when(has("chosen") & has("rejected"), "dpo")
        .when(has("conversations") & has("gt"), "agent")
        .when(has("conversations") & F.coalesce(asks, F.lit(False)), "rlaif")
        .when(has("conversations"), "sft")
        .when(has("text"), "pretrain")
        .when(has("messages", "dialog", "chat"), "sft")
        .when(has("content", "passage", "document"), "pretrain")
        .otherwise("unknown")
    )


def detect_task(path: Column) -> Column:
    """Training task suggested by a file name."""
    lowered = F.lower(path)
    guess = F.lit(None).cast("string")
    for task, keywords in TASK_KEYWORDS:
        hit = F.lit(False)
        for word in keywords:
            hit = hit | F.contains(lowered, F.lit(word))
        guess = F.coalesce(guess, F.when(hit, F.lit(task)))
    return F.coalesce(guess, F.lit(DEFAULT_TASK))


def find_text_column(df: DataFrame, rule: str = "main") -> str | None:
    """The column that holds the text: the ``main`` one, or the ``first`` with a usual name."""
    if rule == "main":
        return next((c for c in MAIN_TEXT if c in df.columns), None)
    named = [c for c in df.columns if c.lower() in FIRST_TEXT]
    return (named or df.columns or ["text"])[0]


def view_of(df: DataFrame, name: str, mode: str = "join") -> Column:
    """Text view of a column of ``df``, by its type."""
    return text_view(F.col(name), df.schema[name].dataType, mode)


def is_valid_conversation(messages: Column) -> Column:
    """Not empty, known roles only, and content or tool calls in every message."""
    return F.coalesce(
        (F.size(messages) > 0)
        & F.forall(
            messages,
            lambda m: F.coalesce(m["role"].isin(*ROLES), F.lit(False))
            & (m["content"].isNotNull() | m["tool_calls"].isNotNull()),
        ),
        F.lit(False),
    )


def assemble_conversations(df: DataFrame, key: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Long-form turns to one row of ordered messages per conversation."""
    nothing = F.lit(None).cast("string")
    message = F.struct(
        F.col(turn).alias("turn"),
        F.col("role"),
        F.col("text").alias("content"),
        nothing.alias("reasoning_content"),
        nothing.alias("tools"),
        nothing.alias("tool_calls"),
    )
    return df.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(message)), lambda m: m.dropFields("turn")).alias("conversations")
    )
