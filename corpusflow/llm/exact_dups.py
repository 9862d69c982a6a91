"""Exact duplicates: frequent digests are settled map-side, all others by an ordinary shuffle."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.tables import fresh, shuffle_partitions, stored, whole_text

# A digest is heavy above this share of all rows, or above an average shuffle partition if that is less.
HEAVY_SHARE = 1 / 1000


def misra_gries(batches: Iterable[list], counters: int) -> tuple[Counter, int]:
    """Frequent items of a stream of batches in at most ``counters`` counters.

    Returns lower bounds of the counts and the most by which any of them, or of the items that are
    missing, can be too low. That is at most (rows seen) / (``counters`` + 1).
    """
    held: Counter = Counter()
    short = 0
    for batch in batches:
        held.update(batch)
        if len(held) > counters:
            cut = sorted(held.values(), reverse=True)[counters]
            held = Counter({k: n - cut for k, n in held.items() if n > cut})
            short += cut
    return held, short


def heavy_digests(digests: DataFrame, share: float) -> DataFrame:
    """Candidates for digests that hold at least ``share`` of the rows of ``digests(digest)``.

    Every such digest is among them, and there are fewer than 4 / (3 ``share``) rows: with 4 / share
    counters, the lower bounds add up to at most all rows, and each bound is above 3/4 of the share.
    """
    counters = int(4 / share)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, short = misra_gries((b.column(0).to_pylist() for b in batches), counters)
        if held or short:
            keys = [*held, None]
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array([*held.values(), short], pa.int64())], ["digest", "n"])

    sums = digests.mapInArrow(summarise, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    sums = stored(sums, "heavy-sums")
    rows = digests.count()
    short = sums.filter("digest is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("short")).first()["short"]
    return sums.filter(F.col("digest").isNotNull() & (F.col("n") + short >= F.lit(share * rows))).select("digest")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """One row per row of ``df``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their UTF-8 bytes are; null counts as empty. Of a group, the row with the
    largest (``keep="max"``) or smallest id stays. Rows that repeat both id and text are one document
    listed several times: each counts in ``group_size`` and they share the verdict. A null id loses to
    any other; a group of null ids only keeps them. An empty table gives an empty result. Other columns
    of ``df`` are ignored, whatever their names.

    Digests are computed once and stored. Misra-Gries summaries of the partitions name the candidates
    for heavy digests; their exact counts and winners are verified in one aggregation and broadcast (at
    most ``1 / share`` rows), so rows of heavy groups never move. All other digests are counted with
    partial aggregation and joined back.
    """
    if keep not in ("max", "min"):
        raise ValueError("keep is 'max' or 'min'")
    best = F.max("doc_id") if keep == "max" else F.min("doc_id")
    rows = stored(df.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(whole_text(text_col), 256)).alias("digest")), "digests")
    share = min(HEAVY_SHARE, 1 / shuffle_partitions(df.sparkSession))
    candidates = heavy_digests(rows.select("digest"), share)
    verified = (
        rows.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    winners = stored(verified, "heavy-winners")
    tagged = rows.join(F.broadcast(winners), "digest", "left")
    light = rows.join(F.broadcast(winners), "digest", "left_anti")
    groups = light.groupBy("digest").agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    resolved = tagged.filter("group_size is not null").unionByName(light.join(groups, "digest").select(*tagged.columns))
    return resolved.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """``df`` with one row of each distinct text, that of the document which :func:`exact_duplicates` keeps.

    All columns stay as they are. Of rows that repeat both id and text, the one with the smallest other
    columns stays; these few are told apart by partial aggregation, so a row repeated very often moves once per
    task. Nulls, empty texts and empty tables are as there.
    """
    ident, digest, whole = fresh(df, "judged_id", "judged_digest", "whole_row")
    judged = exact_duplicates(df, id_col, text_col, keep).groupBy("doc_id", "text_sha256", "kept").agg(F.count(F.lit(1)).alias("n"))
    odd = stored(judged.filter("not kept or n > 1").select(F.col("doc_id").alias(ident), F.col("text_sha256").alias(digest), "kept"), "exact-dropped")

    def same(some: DataFrame) -> Column:
        return df[id_col].eqNullSafe(some[ident]) & (F.sha2(whole_text(text_col), 256) == some[digest])

    single = df.join(odd, same(odd), "left_anti")
    repeated = odd.filter("kept").drop("kept")
    if repeated.isEmpty():
        return single
    groups = df.join(repeated, same(repeated)).groupBy(ident, digest).agg(F.min(F.struct(*df.columns)).alias(whole))
    return single.unionByName(groups.select(f"{whole}.*"))
