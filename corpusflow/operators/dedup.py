"""Exact and near duplicate removal.

Near duplicates are found on distinct 64-bit fingerprints. Candidates come from an equi-join on
agreeing blocks of bits; keys shared by too many fingerprints are not paired with each other but
searched by flipping bits, whose cost per fingerprint is a constant. Both ways are exact.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions.text import bind, tokens
from corpusflow.operators.graph import first_kept
from corpusflow.operators.schema_ops import view_of
from corpusflow.session import cut_lineage

# Tokens whose hashes a Python worker remembers; more only saves time.
_REMEMBERED = 300_000


def simhash64(df: DataFrame, text_key: str = "text", id_key: str = "doc_id") -> DataFrame:
    """``id_key`` and the signed 64-bit ``fingerprint`` of the white-space tokens of each text.

    Bit b is set when more than half of the token hashes have it set. A row's fingerprint depends on
    its text alone and is made where the row is read: nothing is shuffled, and ids may repeat.
    """
    hashes: dict[str, bytes] = {}

    @F.arrow_udf("long")
    def prints(lists: pa.Array) -> pa.Array:
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(hashes) + len(words) > _REMEMBERED:
            hashes.clear()
        for word in words:
            if word not in hashes:
                hashes[word] = hashlib.md5(word.encode()).digest()[8:]
        table = np.frombuffer(b"".join(map(hashes.__getitem__, words)), np.uint8).reshape(-1, 8)
        indices = coded.indices.to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        out, at = np.zeros((len(sizes), 8), np.uint8), 0
        for row, size in enumerate(sizes):
            ones = np.zeros(64, np.int64)
            for start in range(at, at + size, 65_536):
                part = indices[start : min(start + 65_536, at + size)]
                ones += np.unpackbits(table[part], axis=1).sum(axis=0, dtype=np.int64)
            out[row] = np.packbits(ones * 2 > size)
            at += size
        return pa.array(out.reshape(-1).view(">i8").astype(np.int64))

    pieces = tokens(F.coalesce(view_of(df, text_key), F.lit("")))
    return df.select(id_key, prints(pieces).alias("fingerprint"))


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _block_keys(fingerprint: Column, agree: int, threshold: int) -> list[Column]:
    """One key per way to pick ``agree`` of ``threshold + agree`` blocks of the 64 bits.

    Two fingerprints within ``threshold`` bits differ in at most ``threshold`` blocks, so they share
    at least one of these keys.
    """
    blocks = threshold + agree
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    keys = []
    for index, picked in enumerate(combinations(range(blocks), agree)):
        mask = 0
        for b in picked:
            mask |= ((1 << (edges[b + 1] - edges[b])) - 1) << edges[b]
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(index).alias("t"), fingerprint.bitwiseAND(F.lit(signed)).alias("v")))
    return keys


def _flips(bits: int) -> Column:
    """Every mask of at most ``bits`` set bits, built by an expression."""
    none = F.array(F.lit(0).cast("long"))
    single = F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    )

    def widen(step, flips):
        masks = none
        for _ in range(step):
            masks = F.array_distinct(
                F.flatten(F.transform(masks, lambda m: F.transform(flips, lambda s: m.bitwiseOR(s))))
            )
        return masks

    return bind(F.concat(none, single), lambda flips: widen(bits, flips))


def _agreeing_blocks(rows: int, threshold: int) -> int:
    """Fewest agreeing blocks whose keys leave about one fingerprint per key by chance."""
    for agree in range(1, 6):
        if rows / 2.0 ** (64 * agree / (threshold + agree)) <= 1:
            return agree
    return 6


def near_fingerprints(
    prints: DataFrame, threshold: int = 3, crowded: int = 256, agree: int | None = None
) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints within ``threshold`` bits.

    ``prints`` has one column ``fingerprint`` with distinct values. Keys shared by more than
    ``crowded`` fingerprints are resolved by bit flips instead of pairing their members.
    """
    if threshold == 0:
        return prints.select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b")).limit(0)
    if agree is None:
        agree = _agreeing_blocks(prints.count(), threshold)
    keyed = prints.select(
        "fingerprint", F.explode(F.array(*_block_keys(F.col("fingerprint"), agree, threshold))).alias("k")
    ).select("fingerprint", F.col("k.t").alias("t"), F.col("k.v").alias("v"))
    sizes = keyed.groupBy("t", "v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    paired_keys = sizes.filter(F.col("n") <= crowded).select("t", "v")
    crowded_keys = sizes.filter(F.col("n") > crowded).select("t", "v")

    # Spark's size estimates know nothing of the rows that an explode adds, so none of these may be broadcast.
    small = keyed.join(paired_keys.hint("merge"), ["t", "v"], "left_semi")
    left = small.withColumnRenamed("fingerprint", "a")
    right = small.withColumnRenamed("fingerprint", "b")
    paired = left.join(right.hint("merge"), ["t", "v"]).filter((F.col("a") < F.col("b")) & (_distance("a", "b") <= threshold))

    # Dealt out by number, else few members go to one task, which makes some 2,000 rows of each.
    dealt = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = keyed.join(crowded_keys, ["t", "v"], "left_semi").select("fingerprint").repartition(dealt, "fingerprint").distinct()
    near, far = threshold // 2, threshold - threshold // 2

    def around(name, bits):
        fingerprint = F.col("fingerprint")
        flipped = F.transform(_flips(bits), lambda m: fingerprint.bitwiseXOR(m))
        return members.select(fingerprint.alias(name), F.explode(flipped).alias("m"))

    one, other = around("a", near), around("b", far)
    met = one.join(other.hint("merge"), "m").filter((F.col("a") != F.col("b")) & (_distance("a", "b") <= threshold))
    met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return paired.select("a", "b").unionByName(met).distinct()


def near_dup_pairs(
    df: DataFrame, threshold: int = 3, text_key: str = "text", order_key: str = "doc_id", **how
) -> DataFrame:
    """Pairs of near fingerprints as ``(earlier, later, distance)`` of their first rows."""
    firsts = _first_rows(df, text_key, order_key)
    return _ranked_edges(firsts, threshold, order_key, **how)


def _first_rows(df: DataFrame, text_key: str, order_key: str) -> DataFrame:
    prints = simhash64(df, text_key, order_key)
    return cut_lineage(prints.groupBy("fingerprint").agg(F.min(order_key).alias(order_key)))


def _ranked_edges(firsts: DataFrame, threshold: int, order_key: str, **how) -> DataFrame:
    pairs = near_fingerprints(firsts.select("fingerprint"), threshold, **how)
    a = firsts.select(F.col("fingerprint").alias("a"), F.col(order_key).alias("_ra"))
    b = firsts.select(F.col("fingerprint").alias("b"), F.col(order_key).alias("_rb"))
    return pairs.join(a, "a").join(b, "b").select(
        F.least("_ra", "_rb").alias("earlier"),
        F.greatest("_ra", "_rb").alias("later"),
        _distance("a", "b").alias("distance"),
    )


def near_duplicate_keys(
    df: DataFrame, threshold: int = 3, text_key: str = "text", order_key: str = "doc_id", **how
) -> DataFrame:
    """``order_key`` of the rows that :func:`deduplicate` drops: usually a small share of all rows."""
    prints = cut_lineage(simhash64(df, text_key, order_key))
    firsts = cut_lineage(prints.groupBy("fingerprint").agg(F.min(order_key).alias(order_key)))
    removed = first_kept(_ranked_edges(firsts, threshold, order_key, **how).select("earlier", "later"))
    kept = firsts.select(order_key).join(removed.withColumnRenamed("rank", order_key), order_key, "left_anti")
    return prints.select(order_key).join(kept, order_key, "left_anti")


def deduplicate(
    df: DataFrame, threshold: int = 3, text_key: str = "text", order_key: str = "doc_id", **how
) -> DataFrame:
    """Scan in ``order_key`` order; drop a row within ``threshold`` bits of any row kept before it.

    ``order_key`` must be unique. Equal fingerprints share all their neighbours, so only the first
    row of each takes part in the scan.
    """
    return df.join(near_duplicate_keys(df, threshold, text_key, order_key, **how), order_key, "left_anti")


def deduplicate_exact(df: DataFrame, text_key: str = "text", order_key: str = "doc_id") -> DataFrame:
    """Keep the first row of every distinct text; only keys travel in the grouping."""
    view = F.coalesce(view_of(df, text_key), F.lit(""))
    firsts = df.select(F.sha2(view, 256).alias("_t"), order_key).groupBy("_t").agg(F.min(order_key).alias(order_key))
    return df.join(firsts.select(order_key), order_key, "left_semi")
