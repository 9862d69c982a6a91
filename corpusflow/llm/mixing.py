"""Mixing sources to target weights by Pfair scheduling, with DataFrame operations only.

A source with ``parts`` of the ``cycle`` slots is due its k-th block (from 0) no earlier than slot
``floor(k * cycle / parts)`` and before slot ``ceil((k + 1) * cycle / parts)``. Of the blocks that are
released, each slot takes the one with the earliest deadline. As the parts add up to the cycle, all
deadlines are met, so after any number of slots each source is less than one block away from its share.
The schedule repeats after one cycle, so it is worked out for one only, in one row. The cycle grows with
the number of sources. Sources with the same parts have the same windows and take turns, so a slot chooses
among the different parts, not among all sources.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.llm.tables import fresh, stored

# Rows of a source that are numbered in one group, and groups whose sizes are summed in one.
GROUP_ROWS = 1_000
SUPER_GROUPS = 4_096
# Slots of the shortest cycle, and sources for each so many slots. As each source gets one slot before the
# others go by weight, at most 1 in 50 slots is dealt out evenly.
CYCLE = 1_000
CYCLE_SOURCES = 20
# Slots of the longest cycle whose tables are broadcast by a hint; for longer ones Spark chooses the join.
BROADCAST_SLOTS = 100_000
# Slots whose picks are collected in one array before it is put aside, as each addition copies it.
PICKED = 500


def tempered_parts(df: DataFrame, source_col: str = "source", cycle: int | None = None, power: float = 0.5) -> DataFrame:
    """``source, rows, parts``: target weights in proportion to the sources' rows to a power.

    Parts are whole slots of a cycle and add up to it: every source gets one, and the others go by
    largest remainder (ties: more rows, then name). By default the cycle has ``CYCLE`` slots for each
    ``CYCLE_SOURCES`` sources; a given one must have a slot for each source.
    """
    sizes = df.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("rows"))
    everything = Window.partitionBy()  # one row for each source
    n = F.count(F.lit(1)).over(everything)
    slots = F.ceil(n / CYCLE_SOURCES) * CYCLE if cycle is None else F.lit(cycle)
    share = F.pow("rows", F.lit(power)) / F.sum(F.pow("rows", F.lit(power))).over(everything)
    exact = sizes.select("source", "rows", (slots - n).alias("spare"), F.round(share * (slots - n), 9).alias("exact"))
    floored = exact.withColumn("whole", F.floor("exact"))
    left = F.col("spare") - F.sum("whole").over(everything)
    ranked = Window.orderBy((F.col("exact") - F.col("whole")).desc(), F.col("rows").desc(), F.col("source"))
    parts = 1 + F.col("whole") + (F.row_number().over(ranked) <= left).cast("int")
    return floored.select("source", "rows", parts.cast("int").alias("parts"))


def pattern(parts: DataFrame, cycle: int) -> DataFrame:
    """``source, parts, within, in_cycle, released, due`` of each block of one cycle of ``parts(source, parts)``.

    Of equal deadlines, the source that comes first by name goes first.
    """
    names = parts.filter("parts > 0").select("source", "parts", F.row_number().over(Window.orderBy("source")).alias("i"))
    kinds = names.groupBy("parts").agg(F.array_sort(F.collect_list("i")).alias("members"))
    listed = kinds.groupBy().agg(F.array_sort(F.collect_list(F.struct("parts", "members"))).alias("kinds"))
    listed = listed.filter(F.size("kinds") > 0)
    whole = F.lit(cycle).cast("long")

    def given(state: Column, k: Column, j: Column) -> Column:
        return k + F.when(j == state["kind"], 1).otherwise(0)

    def slot(state: Column, t: Column) -> Column:
        def candidate(k: Column, j: Column) -> Column:
            kind, done = F.get("kinds", j), given(state, k, j)
            members, of = kind["members"], kind["parts"]
            turn = F.floor(done / F.size(members))
            i = F.get(members, (done % F.size(members)).cast("int"))
            free = F.floor(turn * whole / of) <= t
            return F.when(free, F.struct(F.ceil((turn + 1) * whole / of).alias("due"), i.alias("i"), j.alias("kind")))

        best = F.array_min(F.transform(state["n"], candidate))
        nothing = F.struct(F.lit(None).cast("long").alias("due"), F.lit(-1).alias("i"), F.lit(-1).alias("kind"))
        bound = F.transform(F.array(F.coalesce(best, nothing)), lambda x: F.struct(
            F.transform(state["n"], lambda k, j: given(state, k, j)).alias("n"),
            x["kind"].alias("kind"),
            F.concat(state["taken"], F.array(x["i"])).alias("taken"),
        ))
        return F.get(bound, F.lit(0))

    def state(n: Column, kind: Column) -> Column:
        return F.struct(n.alias("n"), kind.alias("kind"), F.array().cast("array<int>").alias("taken"))

    def stretch(outer: Column, first: Column) -> Column:
        slots = F.sequence(first, F.least(first + PICKED, F.lit(cycle)) - 1)
        bound = F.transform(F.array(F.aggregate(slots, state(outer["n"], outer["kind"]), slot)), lambda s: F.struct(
            s["n"].alias("n"), s["kind"].alias("kind"), F.concat(outer["picks"], F.array(s["taken"])).alias("picks")
        ))
        return F.get(bound, F.lit(0))

    start = F.struct(
        F.transform("kinds", lambda _: F.lit(0)).alias("n"), F.lit(-1).alias("kind"), F.array().cast("array<array<int>>").alias("picks")
    )
    run = F.aggregate(F.sequence(F.lit(0), F.lit(cycle - 1), F.lit(PICKED)), start, stretch, lambda s: F.flatten(s["picks"]))
    slots = listed.select(F.posexplode(run).alias("in_cycle", "i")).filter("i >= 0")
    named = slots.join(names, "i").select("source", "parts", "in_cycle")
    order = Window.partitionBy("source").orderBy("in_cycle")
    numbered = named.withColumn("within", F.row_number().over(order) - 1)
    return numbered.select(
        "source",
        "parts",
        "within",
        "in_cycle",
        F.floor(F.col("within") * whole / F.col("parts")).alias("released"),
        F.ceil((F.col("within") + 1) * whole / F.col("parts")).alias("due"),
    )


def positioned(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with one more column, and its name: the 0-based number of each row in the order it was written in.

    A write numbers its files as it does its partitions, so that is the order of the files' numbers and, within a
    file, of its rows, however Spark deals files to tasks. What is not read straight from Parquet files is written
    first, one partition after the other.
    """
    position, path, row = fresh(df, "mix_position", "mix_path", "mix_row")

    def located(table: DataFrame) -> DataFrame:
        read = table.metadataColumn("_metadata")
        return table.withColumns({path: read["file_path"], row: read["row_index"]})

    try:
        rows = located(df)
    except AnalysisException:
        rows = located(stored(df, "mix-written"))
    sizes = rows.groupBy(path).agg((F.max(row) + 1).alias("n"))  # one row for each file
    # A name is part-<partition>-<id of the write>-c<file of the partition>.
    of = [F.regexp_extract(path, p, 1) for p in ("^(.*/)", "/part-([0-9]+)[^/]*$", "-c([0-9]+)[^/]*$")]
    running = Window.orderBy(of[0], of[1].try_cast("long"), of[2].try_cast("long"), path)
    before = stored(sizes.select(path, (F.sum("n").over(running) - F.col("n")).alias(position)), "mix-files")
    rows = rows.join(F.broadcast(before), path).withColumn(position, F.col(position) + F.col(row))
    return rows.drop(path, row), position


def numbered(
    df: DataFrame, sizes: DataFrame, id_col: str, source_col: str, seed: int, place: str, few: bool, order_col: str | None = None
) -> DataFrame:
    """``df`` with its 0-based place within its source, in the order of a hash of id and seed, or of ``order_col``.

    Rows are dealt by ranges of the hash into groups of about ``GROUP_ROWS`` rows, however large the
    source; a row's place is its number in its group plus the sizes of the groups before. ``few`` says
    that there are few sources, so their sizes are broadcast. Groups by ``order_col`` are ``GROUP_ROWS`` numbers wide.
    """
    key, share, group, before = fresh(df, "mix_key", "mix_hash", "mix_group", "mix_before")
    keyed = df.withColumn(key, F.struct(F.col(source_col).alias("source")))
    if order_col is None:
        hashed = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")))
        groups = F.ceil(F.col("rows") / GROUP_ROWS)
        many = sizes.select(F.struct("source").alias(key), groups.alias(before))
        if few:
            many = F.broadcast(many)
        dealt = (
            keyed.withColumn(share, hashed)
            .join(many, key)  # one row for each source
            .withColumn(group, F.floor(F.conv(F.substring(share, 1, 8), 16, 10).cast("long") * F.col(before) / 2**32))
            .drop(before)
        )
        ties = [F.col(id_col), F.xxhash64(*[F.col(c) for c in df.columns])]
    else:
        dealt = keyed.withColumns({share: F.col(order_col), group: F.floor(F.col(order_col) / GROUP_ROWS)})
        ties = []
    counts = stored(dealt.groupBy(key, group).agg(F.count(F.lit(1)).alias("n")), "mix-groups")
    sums = counts.groupBy(key, F.floor(F.col(group) / SUPER_GROUPS).alias("super")).agg(F.sum("n").alias("all"))
    running = Window.partitionBy(key).orderBy("super")
    sums = sums.withColumn("ahead", F.sum("all").over(running) - F.col("all")).drop("all")
    inside = Window.partitionBy(key, "super").orderBy(group)
    offsets = counts.withColumn("super", F.floor(F.col(group) / SUPER_GROUPS)).withColumn("own", F.sum("n").over(inside) - F.col("n"))
    offsets = stored(offsets.join(sums, [key, "super"]).select(key, group, (F.col("own") + F.col("ahead")).alias(before)), "mix-offsets")
    order = Window.partitionBy(key, group).orderBy(share, *ties)
    ranked = dealt.withColumn(place, F.row_number().over(order) - 1)
    return ranked.join(offsets, [key, group]).withColumn(place, F.col(place) + F.col(before)).drop(key, group, share, before)


def with_slots(
    df: DataFrame, parts: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", block_rows: int = 8, cycle: int | None = None, seed: int = 0,
    order_col: str | None = None,
) -> DataFrame:
    """``df`` with ``block, slot, released, due`` and ``place``: the mixture is the order of ``slot, place``.

    Within a source, documents follow a hash of their ids, or ``order_col`` (different numbers, none null), and each
    ``block_rows`` of them are a block.
    ``parts(source, rows, parts)`` are the targets (by default :func:`tempered_parts`); ``parts`` must add
    up to ``cycle``, which by default is their sum. Any number of sources is scheduled. Every row gets exactly one slot: nothing is repeated or dropped. A source that runs
    out leaves its later slots empty, so the others keep their proportions among themselves. A source
    that is missing from ``parts`` or has none comes after all others (null ``slot``). A null source is a
    source, a null id sorts first within its hash, and repeated rows take places one after the other. An
    empty table gives an empty result. Existing columns of the five names are replaced.
    """
    df = df.drop("block", "slot", "released", "due", "place")
    targets = stored(tempered_parts(df, source_col, cycle) if parts is None else parts, "mix-parts")
    total = targets.filter("parts > 0").agg(F.count(F.lit(1)).alias("n"), F.sum("parts").alias("slots")).first()
    if cycle is None:
        cycle = total["slots"] or CYCLE
    elif total["n"] > cycle:
        raise ValueError(f"more than {cycle} sources: use a longer cycle")
    few = cycle <= BROADCAST_SLOTS
    small = F.broadcast if few else lambda d: d
    sizes = targets.select("source", "rows")
    if parts is not None:
        known = df.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("rows"))
        sizes = stored(known, "mix-sizes")
    plan = stored(pattern(targets, cycle), "mix-pattern")  # one row for each slot
    key, within, turn = fresh(df, "mix_key", "mix_within", "mix_turn")
    rows = numbered(df, sizes, id_col, source_col, seed, "place", few and parts is None, order_col).withColumns(
        {"block": F.floor(F.col("place") / block_rows), key: F.struct(F.col(source_col).alias("source"))}
    )
    each = small(targets.filter("parts > 0").select(F.struct("source").alias(key), F.col("parts").alias(turn)))
    rows = rows.join(each, key, "left").withColumns(
        {within: (F.col("block") % F.col(turn)).cast("int"), turn: F.floor(F.col("block") / F.col(turn)) * cycle}
    )
    slots = plan.select(F.struct("source").alias(key), F.col("within").alias(within), "in_cycle", "released", "due")
    placed = rows.join(small(slots), [key, within], "left")
    return placed.select(
        *df.columns,
        "block",
        (F.col(turn) + F.col("in_cycle")).alias("slot"),
        (F.col(turn) + F.col("released")).alias("released"),
        (F.col(turn) + F.col("due")).alias("due"),
        "place",
    )


def scheduled(df: DataFrame, **options) -> tuple[DataFrame, str, str, str]:
    """``df`` with three more columns, and their names: block, slot and place of :func:`with_slots`. All
    columns of ``df`` stay, also those of the same names."""
    block, slot, place = fresh(df, "mix_block", "mix_slot", "mix_place")
    kept = {c: f"mix_kept_{i}" for i, c in enumerate(df.columns) if c.lower() in ("block", "slot", "released", "due", "place")}
    rows = with_slots(df.withColumnsRenamed(kept), **options)
    rows = rows.withColumnsRenamed({"block": block, "slot": slot, "place": place}).drop("released", "due")
    return rows.withColumnsRenamed({v: k for k, v in kept.items()}), block, slot, place


def mixed_order(df: DataFrame, partitions: int, **options) -> DataFrame:
    """``df`` in the order of the mixture, range-partitioned, so that written files follow it.

    Readers don't keep the order across files; a later stage gets it back with :func:`positioned`.
    """
    rows, _, slot, place = scheduled(df, **options)
    by = (F.col(slot).asc_nulls_last(), F.col(place))
    return rows.repartitionByRange(partitions, *by).sortWithinPartitions(*by).select(*df.columns)
