"""Cleaning and length filters, and the staged curation job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from corpusflow.functions.fence import fence
from corpusflow.functions.text import clean_text, words_and_marks
from corpusflow.operators.dedup import near_duplicate_keys
from corpusflow.operators.schema_ops import is_valid_conversation, view_of
from corpusflow.session import cut_lineage

Counter = Callable[[Column], Column]


def count_words_and_marks(text: Column) -> Column:
    """Default token counter: needs no trained model."""
    return F.size(words_and_marks(text))


def clean_columns(df: DataFrame) -> DataFrame:
    """Clean every string column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return fence(df, {n: clean_text(F.col(n)) for n in names}) if names else df


def _length(df: DataFrame, text_key: str) -> Column:
    return F.coalesce(F.length(view_of(df, text_key)), F.lit(0))


def filter_by_length(df: DataFrame, lo: int = 10, hi: int = 1_000_000, text_key: str = "text") -> DataFrame:
    return df.filter(_length(df, text_key).between(lo, hi))


def filter_by_token_length(
    df: DataFrame, count: Counter = count_words_and_marks, lo: int = 5, hi: int = 8192, text_key: str = "text"
) -> DataFrame:
    return df.filter(F.coalesce(count(view_of(df, text_key)), F.lit(0)).between(lo, hi))


def flag_stages(
    df: DataFrame,
    count: Counter | None = count_words_and_marks,
    min_chars: int = 10,
    max_chars: int = 500_000,
    min_tokens: int = 5,
    max_tokens: int = 8192,
    clean: bool = True,
    validate: bool = False,
    text_key: str = "text",
) -> DataFrame:
    """Row-local stages as one column ``_dropped_by``; null for the rows that stay."""
    if clean:
        df = clean_columns(df)
    view = view_of(df, text_key)
    reason = F.when(~_length(df, text_key).between(min_chars, max_chars), F.lit("chars"))
    if count is not None and min_tokens > 0:
        df = fence(df, {"_n_tokens": F.coalesce(count(view), F.lit(0))})
        short = ~F.col("_n_tokens").between(min_tokens, max_tokens)
        reason = reason.when(short, F.lit("tokens"))
    if validate and isinstance(df.schema[text_key].dataType, T.ArrayType):
        reason = F.when(~is_valid_conversation(F.col(text_key)), F.lit("invalid")).otherwise(reason)
    return df.withColumn("_dropped_by", reason).drop("_n_tokens")


def process(
    df: DataFrame,
    dedup: bool = True,
    dedup_threshold: int = 3,
    text_key: str = "text",
    order_key: str = "doc_id",
    **stages,
) -> tuple[DataFrame, DataFrame]:
    """The curated rows and the report on them, from one pass over ``df``.

    The cleaned rows with their flags are written to the checkpoint folder once, and the stages' counts are
    observed while that happens; fingerprints and the result are read from there. Rows are removed by an
    anti-join with the keys of the near duplicates only.
    """
    names = ["chars", "tokens"] + (["invalid"] if stages.get("validate") else [])
    counts = Observation()
    flagged = cut_lineage(
        flag_stages(df, text_key=text_key, **stages).observe(
            counts,
            F.count(F.lit(1)).alias("n_total"),
            *[F.count_if(F.col("_dropped_by") == n).alias(f"dropped_{n}") for n in names],
        )
    )
    kept = flagged.filter(F.col("_dropped_by").isNull()).drop("_dropped_by")
    found = dict(counts.get)
    found["dropped_duplicates"] = 0
    if dedup:
        gone = cut_lineage(near_duplicate_keys(kept, dedup_threshold, text_key, order_key))
        kept = kept.join(gone, order_key, "left_anti")
        found["dropped_duplicates"] = gone.count()
    dropped = [f"dropped_{n}" for n in names] + ["dropped_duplicates"]
    one = df.sparkSession.range(1).select(*[F.lit(found[c]).cast("long").alias(c) for c in ("n_total", *dropped)])
    removed = sum((F.col(c) for c in dropped[1:]), F.col(dropped[0]))
    report = one.select(
        "n_total",
        (F.col("n_total") - removed).alias("n_kept"),
        *dropped,
        removed.alias("n_removed"),
        F.round(removed * 100.0 / F.greatest(F.col("n_total"), F.lit(1)), 1).alias("removed_pct"),
    )
    return kept, report


def process_dataset(df: DataFrame, **options) -> DataFrame:
    """Clean, filter by characters, filter by tokens, remove near duplicates."""
    return process(df, **options)[0]


def process_report(df: DataFrame, **options) -> DataFrame:
    """Rows in, rows removed per stage and in all, and the share removed, as one row."""
    return process(df, **options)[1]
