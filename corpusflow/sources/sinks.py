"""Sinks for run metrics and encoded examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_metrics(df: DataFrame, path: str) -> None:
    """Append metrics in long form, so a new metric adds rows and never changes the file layout."""
    df.select("run_id", "ts", "step", "metric", "value").write.mode("append").partitionBy("metric").parquet(path)


def write_examples(df: DataFrame, path: str, world_size: int = 1) -> None:
    """Write planned examples, one folder per epoch and rank, in batch order within each file.

    Files are cut along ``idx`` ranges, so every rank reads many files and none grows with the data.
    Only the epochs and ranks that ``df`` holds are replaced; others at ``path`` stay.
    """
    ranked = df.withColumn("rank", (F.col("idx") % world_size).cast("int"))
    if "epoch" not in df.columns:
        ranked = ranked.withColumn("epoch", F.lit(0))
    (
        ranked.repartitionByRange("epoch", "rank", "idx")
        .sortWithinPartitions("epoch", "rank", "idx")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("epoch", "rank")
        .parquet(path)
    )
