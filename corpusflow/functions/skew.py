"""Group statistics and ordered positions that stay balanced when one key holds most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.session import cut_lineage

# Rows of one group that one task may have to handle. It does not grow with the data.
ROW_BUDGET = 1_000_000


def _key(names: list[str]) -> Column:
    """The group as one struct: it is never null itself and null fields compare equal, so plain
    equality joins it, and the partitioning of a window on it serves a following join."""
    return F.struct(*names) if names else F.struct(F.lit(0).alias("all"))


def attach(
    df: DataFrame,
    table: DataFrame,
    keys: list[str],
    spread_by: list[str],
    weight: str,
    min_rows: int = ROW_BUDGET,
    how: str = "left",
) -> DataFrame:
    """Join a one-row-per-key ``table`` onto ``df``, where ``table[weight]`` counts the rows of ``df``.

    Keys holding more than ``min_rows`` rows are cut into as many copies as make each smaller than that;
    a row picks its copy by a hash of ``spread_by``, so reruns of a task choose the same one. The list of
    such keys has a row for ``min_rows`` rows of data at most; Spark broadcasts it if it is small.
    """
    copies = F.greatest(F.lit(1), F.ceil(F.col(weight) / F.lit(min_rows))).cast("int")
    sized = table.withColumns({"_key": _key(keys), "_copies": copies}).drop(*keys)
    hot = sized.filter(F.col("_copies") > 1).select("_key", "_copies")
    pick = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_copies")), F.lit(0)).cast("int")
    salted = df.withColumn("_key", _key(keys)).join(hot, "_key", "left").withColumn("_salt", pick).drop("_copies")
    spread = sized.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_copies")
    return salted.join(spread, ["_key", "_salt"], how).drop("_key", "_salt")


def group_stats(
    df: DataFrame,
    keys: list[str],
    aggregates: dict[str, Column],
    spread_by: list[str],
    min_rows: int = ROW_BUDGET,
) -> DataFrame:
    """Attach per-group aggregates to every row: partial aggregation, then a balanced join.

    A window would move every row of a group into one task; here only one row per group moves.
    """
    stats = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in aggregates.items()]
    )
    return attach(df, stats, keys, spread_by, "_rows", min_rows).drop("_rows")


def ordered_index(
    df: DataFrame,
    by: list[str],
    order: list[str],
    min_rows: int = ROW_BUDGET,
    pieces: int | None = None,
    running: dict[str, Column] | None = None,
) -> DataFrame:
    """Add ``_idx`` (1-based position within ``by`` along ``order``) and ``_n`` (group size).

    ``running`` adds inclusive running sums of the given columns. ``order`` must tell rows apart.

    If no group has more than ``min_rows`` rows, each is numbered in one window. Otherwise all rows are
    range-partitioned by group and the whole of ``order`` into pieces well below that (or into
    ``pieces``), whatever the size of a group or the number of its ties; pieces are numbered by
    themselves and shifted by the sizes of the earlier ones.
    """
    keyed = df.withColumn("_key", _key(by))
    running = running or {}
    sizes = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    most, total = sizes.agg(F.max("_n"), F.sum("_n")).first()
    if (most or 0) <= min_rows:
        along, whole = Window.partitionBy("_key").orderBy(*order), Window.partitionBy("_key")
        added = {"_idx": F.row_number().over(along).cast("long"), "_n": F.count(F.lit(1)).over(whole)}
        return keyed.withColumns(added | {n: F.sum(c).over(along) for n, c in running.items()}).drop("_key")
    parts = pieces or -(-2 * total // min_rows)
    # Stored, since another evaluation of the range partitioning might cut elsewhere.
    ranged = keyed.repartitionByRange(parts, "_key", *order).withColumn("_piece", F.spark_partition_id())
    pieced = cut_lineage(ranged)
    sums = {f"_sum_{n}": c for n, c in running.items()}
    counts = pieced.groupBy("_key", "_piece").agg(
        F.count(F.lit(1)).alias("_c"), *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    along = Window.partitionBy("_key").orderBy("_piece")
    whole = Window.partitionBy("_key")
    offsets = counts.select(
        "_key",
        "_piece",
        (F.sum("_c").over(along) - F.col("_c")).alias("_before"),
        F.sum("_c").over(whole).alias("_n"),
        *[(F.sum(n).over(along) - F.col(n)).alias(n) for n in sums],
    )
    inside = Window.partitionBy("_key", "_piece").orderBy(*order)
    numbered = pieced.withColumns(
        {"_row": F.row_number().over(inside)} | {n: F.sum(c).over(inside) for n, c in running.items()}
    )
    shifted = {"_idx": F.col("_before") + F.col("_row")} | {n: F.col(n) + F.col(f"_sum_{n}") for n in running}
    joined = numbered.join(offsets, ["_key", "_piece"]).withColumns(shifted)
    return joined.drop("_before", "_row", "_piece", "_key", *sums)


def with_lookback(df: DataFrame, lookback: int, block_rows: int = 200_000) -> tuple[DataFrame, Column]:
    """Cut indexed groups into blocks of ``block_rows``, each preceded by ``lookback`` earlier rows.

    Returns the rows, carrying ``_block``, and the condition that tells a block's own rows from the
    borrowed ones. A frame of up to ``lookback`` preceding rows is exact within ``_block``.
    """
    if lookback >= block_rows:
        raise ValueError("lookback must be smaller than block_rows")
    home = F.floor((F.col("_idx") - 1) / block_rows)
    near_end = (F.col("_idx") - 1) % block_rows >= block_rows - lookback
    rows = df.withColumn(
        "_block", F.explode(F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    return rows, F.col("_block") == home
