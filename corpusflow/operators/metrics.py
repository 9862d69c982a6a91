"""Run metrics: long form, rolling means, latest values, throughput."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from corpusflow.functions.skew import attach, ordered_index, with_lookback

# The widest rolling window, its share of the records, and the fewest records to smooth.
WIDEST, SHARE, FEWEST = 20, 3, 10


def melt_metrics(df: DataFrame, keys: list[str]) -> DataFrame:
    """Numeric columns other than time, step and epoch as ``(metric, value)`` rows."""
    skip = {"timestamp", "step", "epoch", *keys}
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in numeric])
    return wide.unpivot(keys, numeric, "metric", "value")


def smooth(df: DataFrame, by: list[str], order: list[str], value: str = "value", min_rows: int = 200_000) -> DataFrame:
    """Add ``step`` and ``smooth``, the rolling mean over the last min(20, n // 3) records.

    Metrics with at most ten records are not smoothed. The window is at most 20 rows wide, so large
    metrics are cut into blocks that borrow the rows just before them.
    """
    indexed = ordered_index(df, by, order, min_rows)
    rows, own = with_lookback(indexed, WIDEST - 1, max(min_rows, WIDEST))
    frame = Window.partitionBy(*by, "_block").orderBy("_idx").rowsBetween(-(WIDEST - 1), 0)
    framed = rows.withColumn("_near", F.collect_list(value).over(frame)).filter(own)
    width = F.least(F.lit(WIDEST), F.floor(F.col("_n") / SHARE), F.size("_near").cast("long")).cast("int")
    latest = F.slice("_near", F.size("_near") - width + 1, width)
    mean = F.aggregate(latest, F.lit(0.0), lambda a, x: a + x) / width
    return framed.withColumns(
        {"step": F.col("_idx"), "smooth": F.when(F.col("_n") > FEWEST, mean)}
    ).drop("_near", "_idx", "_n", "_block")


def latest(df: DataFrame, by: list[str], order: list[str], value: str = "value") -> DataFrame:
    """Last value and record count of every metric; aggregated before the shuffle."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_records"), F.max_by(value, F.struct(*order)).alias("latest")
    )


def throughput(
    df: DataFrame, by: list[str], order: list[str], seconds: str, tokens: str, total_steps: int, min_rows: int = 200_000
) -> DataFrame:
    """Tokens per second since the previous step, and whole minutes left at the pace so far.

    ``seconds`` is the record's time; the first record of a run starts its clock.
    """
    indexed = ordered_index(df, by, order, min_rows)
    start = df.groupBy(*by).agg(F.min(seconds).alias("_start"), F.count(F.lit(1)).alias("_rows"))
    rows, own = with_lookback(indexed, 1, max(min_rows, 2))
    frame = Window.partitionBy(*by, "_block").orderBy("_idx")
    timed = rows.withColumn("_gap", F.col(seconds) - F.lag(seconds).over(frame)).filter(own)
    timed = attach(timed, start, by, ["_idx"], "_rows", min_rows)
    spent = F.col(seconds) - F.col("_start")
    left = F.floor(spent / F.greatest(F.col("_idx") - 1, F.lit(1)) * (total_steps - F.col("_idx")) / 60)
    return timed.withColumns(
        {
            "step": F.col("_idx"),
            "tokens_per_s": F.when(F.col("_gap") > 0, F.col(tokens) / F.col("_gap")),
            "minutes_left": F.greatest(left, F.lit(0)),
        }
    ).drop("_idx", "_n", "_block", "_gap", "_start", "_rows")
