"""Record kinds, their canonical fields, and the alternative column names readers accept."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("reasoning_content", T.StringType()),
        T.StructField("tools", T.StringType()),
        T.StructField("tool_calls", T.StringType()),
    ]
)
MESSAGES = T.ArrayType(MESSAGE)

SCHEMAS = {
    "pretrain": T.StructType([T.StructField("text", T.StringType())]),
    "sft": T.StructType([T.StructField("conversations", MESSAGES)]),
    "dpo": T.StructType([T.StructField("chosen", MESSAGES), T.StructField("rejected", MESSAGES)]),
    "rlaif": T.StructType([T.StructField("conversations", MESSAGES)]),
    "agent": T.StructType(
        [T.StructField("conversations", MESSAGES), T.StructField("gt", T.ArrayType(T.StringType()))]
    ),
}

REQUIRED = {kind: tuple(schema.fieldNames()) for kind, schema in SCHEMAS.items()}

# Accepted source names per canonical field, in order of preference.
ALIASES = {
    "pretrain": {"text": ("content", "document", "passage", "sentence", "body", "article")},
    "sft": {"conversations": ("messages", "dialog", "dialogue", "chat", "conversation", "history")},
    "dpo": {
        "chosen": ("preferred", "chosen_response", "positive"),
        "rejected": ("dispreferred", "rejected_response", "negative"),
    },
    "rlaif": {"conversations": ("messages", "dialog", "chat")},
    "agent": {"conversations": ("messages", "dialog"), "gt": ("ground_truth", "answers", "answer")},
}

# The format that a file suffix stands for.
FORMAT_OF = {
    ".jsonl": "json",
    ".json": "json",
    ".csv": "csv",
    ".tsv": "tsv",
    ".parquet": "parquet",
    ".pq": "parquet",
    ".txt": "text",
    ".text": "text",
    ".md": "text",
}

# Message roles a valid conversation may use.
ROLES = ("system", "user", "assistant", "tool")
