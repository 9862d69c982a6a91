"""Reproducible order, batches, ranks and replication of training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.functions.text import hex_long, shuffle_key
from corpusflow.session import cut_lineage

# Rows are spread over 256 * 256 hash buckets. Only the bucket counts are broadcast: a fixed size.
_FAN = 256


def shuffle(df: DataFrame, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """Seeded permutation that depends on the keys only, not on how the table is split."""
    return df.withColumn("_s", shuffle_key(F.col(key), seed)).orderBy("_s", key).drop("_s")


def with_positions(df: DataFrame, name: str = "idx") -> DataFrame:
    """Add each row's place (from 0) in the order that ``df`` has.

    Rows count within their partition, and the partitions' sizes, one row each, are summed up and broadcast. The
    rows are stored first, so that a partition read anew holds the same ones.
    """
    placed = cut_lineage(df.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    # A row for each partition.
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    place = F.col("_before") + F.col("_id").bitwiseAND((1 << 33) - 1)
    return joined.withColumn(name, place).drop("_id", "_part", "_before")


def _bucket_offsets(buckets: DataFrame) -> DataFrame:
    """Rows before each bucket, from counts per bucket, without sorting the buckets in one task."""
    outer = F.floor(F.col("_b") / _FAN)
    inner = Window.partitionBy("_hi").orderBy("_b")
    counts = buckets.groupBy("_b").agg(F.count(F.lit(1)).alias("_c")).withColumn("_hi", outer)
    local = counts.withColumn("_before", F.sum("_c").over(inner) - F.col("_c"))
    totals = counts.groupBy("_hi").agg(F.sum("_c").alias("_t"))
    later = (
        totals.filter(F.col("_hi") < _FAN - 1)
        .select("_t", F.explode(F.sequence(F.col("_hi") + 1, F.lit(_FAN - 1).cast("long"))).alias("_hi"))
        .groupBy("_hi")
        .agg(F.sum("_t").alias("_outer"))
    )
    return local.join(later, "_hi", "left").select(
        F.col("_b"), (F.col("_before") + F.coalesce(F.col("_outer"), F.lit(0))).alias("_offset")
    )


def plan_batches(
    df: DataFrame, seed: int = 42, epoch: int = 0, batch_size: int = 32, key: str = "doc_id"
) -> DataFrame:
    """Add ``idx``, the place of each row in the epoch's permutation, and its ``batch_id``.

    The permutation sorts by a hash, so hash buckets are balanced by construction and each is
    numbered by itself, then shifted by the sizes of the buckets before it. ``key`` must be unique.
    """
    keyed = df.withColumn("_s", shuffle_key(F.col(key), seed, epoch)).withColumn(
        "_b", hex_long(F.substring("_s", 1, 4))
    )
    offsets = F.broadcast(_bucket_offsets(keyed.select("_b")))
    inside = Window.partitionBy("_b").orderBy("_s", key)
    place = F.row_number().over(inside) - 1 + F.col("_offset")
    numbered = keyed.join(offsets, "_b").withColumn("idx", place.cast("long"))
    return numbered.withColumn("batch_id", F.floor(F.col("idx") / batch_size)).drop("_s", "_b", "_offset")


def skip_batches(df: DataFrame, done: int) -> DataFrame:
    """Leave out the batches an interrupted epoch has finished."""
    return df.filter(F.col("batch_id") >= done)


def remaining_batches(rows: Column, batch_size: int, done: Column | int) -> Column:
    return F.greatest(F.ceil(rows / batch_size) - done, F.lit(0))


def rescale_step(step: Column, saved_world: int, world: int) -> Column:
    """Steps done, restated for another number of workers."""
    return F.floor(step * saved_world / world)


def shard(df: DataFrame, world_size: int) -> DataFrame:
    """Add the ``rank`` that reads each row."""
    return df.withColumn("rank", (F.col("idx") % world_size).cast("int"))


def expand_generations(df: DataFrame, n: int) -> DataFrame:
    """Repeat every prompt ``n`` times, numbered by ``generation``."""
    return df.withColumn("generation", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
