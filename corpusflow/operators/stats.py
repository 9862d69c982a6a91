"""Corpus statistics: counts, lengths, index-based percentiles, token ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.operators.curate import Counter
from corpusflow.operators.schema_ops import find_text_column, view_of

# Fixed value: characters per token assumed when no tokenizer is at hand.
CHARS_PER_TOKEN = 2


def head(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first ``n`` rows in ``key`` order."""
    return df.orderBy(key).limit(n)


def describe_dataset(
    df: DataFrame,
    count: Counter | None = None,
    sample: int | None = None,
    token_sample: int | None = None,
    order_key: str | None = None,
    text_key: str | None = None,
) -> DataFrame:
    """Rows, columns, mean characters and, with a token counter, token estimates; one row.

    All rows are measured unless ``sample`` (and ``token_sample``) ask for the first ones.
    """
    text_key = text_key or find_text_column(df)
    source = head(df, sample, order_key) if sample else df
    view = view_of(source, text_key, "json")
    measured = source.select(
        F.coalesce(F.length(view), F.lit(0)).alias("chars"),
        (F.coalesce(count(view), F.lit(0)) if count else F.lit(0)).alias("tokens"),
        *([F.col(order_key)] if order_key else []),
    )
    per_token = (F.sum("chars") / F.nullif(F.sum("tokens"), F.lit(0))) if count else F.lit(None).cast("double")
    sums = measured.agg(F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n"), per_token.alias("_ratio"))
    if token_sample:
        sums = sums.withColumn("_ratio", head(measured, token_sample, order_key).agg(per_token.alias("r")).scalar() if count else F.col("_ratio"))
    # Without samples all of it comes from one scan of the text.
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar() if sample else F.col("n")
    named = sums.select(
        F.lit(len(df.columns)).alias("n_columns"),
        (F.coalesce(F.col("chars"), F.lit(0)) / F.greatest(F.col("n"), F.lit(1))).alias("avg_chars"),
        "_ratio",
        "n",
    ).withColumn("n_rows", rows)
    return named.select(
        "n_rows",
        "n_columns",
        "avg_chars",
        F.bround("_ratio", 2).alias("chars_per_token"),
        F.floor(F.col("avg_chars") * F.col("n_rows") / F.col("_ratio")).cast("long").alias("est_total_tokens"),
        F.bround(F.col("avg_chars") * F.col("n_rows") / (1024 * 1024), 2).alias("raw_text_mb"),
    )


def _at_rank(rank: Column) -> Column:
    """Value of the histogram bin that covers the 1-based ``rank``."""
    return F.min(F.when(F.col("_upto") >= rank, F.col("_len")))


def profile(df: DataFrame, by: list[str], text_key: str = "text", sample: int | None = None, order_key: str | None = None) -> DataFrame:
    """Per group: rows, rounded mean, exact p50 and p90 by rank, longest, and token estimates.

    Ranks are read off a histogram of lengths, so only distinct lengths are ever sorted. Without ``by``, they are
    all in one window: as many rows as there are different lengths, however many texts there are.
    """
    source = head(df, sample, order_key) if sample else df
    lengths = source.select(*by, F.coalesce(F.length(view_of(source, text_key, "json")), F.lit(0)).alias("_len"))
    bins = lengths.groupBy(*by, "_len").agg(F.count(F.lit(1)).alias("_c"))
    along = Window.partitionBy(*by, F.lit(0)).orderBy("_len")
    whole = Window.partitionBy(*by, F.lit(0))
    ranked = bins.withColumns({"_upto": F.sum("_c").over(along), "_n": F.sum("_c").over(whole)})
    half = F.floor(F.col("_n") / 2) + 1
    late = F.when(F.col("_n") >= 10, F.floor(9 * F.col("_n") / 10) + 1).otherwise(F.col("_n"))
    stats = ranked.groupBy(*by).agg(
        F.sum("_c").alias("n_rows"),
        F.bround(F.sum(F.col("_len") * F.col("_c")) / F.sum("_c"), 0).cast("long").alias("avg_chars"),
        _at_rank(half).alias("char_p50"),
        _at_rank(late).alias("char_p90"),
        F.max("_len").alias("char_max"),
    )
    per_row = F.bround(F.col("avg_chars") / CHARS_PER_TOKEN, 0).cast("long")
    return stats.withColumns(
        {"est_tokens_per_row": per_row, "est_total_tokens": per_row * F.col("n_rows")}
    )


def analyze_dataset(df: DataFrame, text_key: str | None = None, sample: int | None = None, order_key: str | None = None) -> DataFrame:
    """Length profile of the whole table as one row; totals count every row even when sampled."""
    text_key = text_key or find_text_column(df, "first")
    stats = profile(df, [], text_key, sample, order_key)
    if sample is None:
        return stats
    stats = stats.withColumn("n_rows", df.agg(F.count(F.lit(1)).alias("n")).scalar())
    return stats.withColumn("est_total_tokens", F.col("est_tokens_per_row") * F.col("n_rows"))


def compression_ratio(df: DataFrame, count: Counter, by: list[str], text_key: str = "text") -> DataFrame:
    """Mean of characters per token over the texts of each group."""
    view = view_of(df, text_key)
    sized = df.select(*by, F.length(view).alias("_chars"), count(view).alias("_tokens")).filter("_tokens > 0")
    return sized.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("_chars").alias("chars"),
        F.sum("_tokens").cast("long").alias("tokens"),
        F.avg(F.col("_chars") / F.col("_tokens")).alias("mean_ratio"),
    )


def truncation_report(df: DataFrame, max_length: int, by: list[str], n_tokens: Column) -> DataFrame:
    """Share of rows and of tokens cut at ``max_length``."""
    over = F.greatest(F.col("_t") - max_length, F.lit(0))
    sized = df.select(*by, n_tokens.cast("long").alias("_t"))
    return sized.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("_t") > max_length).alias("rows_cut"),
        (F.count_if(F.col("_t") > max_length) / F.count(F.lit(1))).alias("rows_cut_share"),
        F.sum(over).alias("tokens_cut"),
        (F.sum(over) / F.greatest(F.sum("_t"), F.lit(1))).alias("tokens_cut_share"),
    )


def masked_mean(df: DataFrame, value: Column, mask: Column, by: list[str], eps: float | None = None) -> DataFrame:
    """Sum of masked values over the size of the mask, which counts as at least one (or plus ``eps``)."""
    size = F.sum(mask)
    bottom = size + eps if eps is not None else F.greatest(size, F.lit(1))
    return df.groupBy(*by).agg(size.cast("long").alias("n_masked"), (F.sum(value * mask) / bottom).alias("masked_mean"))
