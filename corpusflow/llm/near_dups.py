"""Near duplicates by b-bit MinHash: banded candidates, estimates from packed low bits, exact checks."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions.memory import tidy
from corpusflow.functions.portions import row_portions
from corpusflow.llm.graph import components
from corpusflow.llm.tables import fresh, stored, whole_text

# Words whose hashes a Python worker remembers; more only saves time.
REMEMBERED = 500_000
# Shingles hashed at a time, so that a very long text needs no more memory than a short one.
STRIDE = 8_192
# Candidates of one bucket that meet in one task when it has to be searched pair by pair.
BLOCK_ROWS = 2_000
# Texts of one group that meet in one task when their sets have to be compared pair by pair.
TEXT_ROWS = 500
MIX1, MIX2, MIX3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class MinHash:
    """Parameters. With 24 bands of 4 minima, a pair at similarity 0.8 is missed with probability 3e-6."""

    shingle: int = 5
    percent: int = 80
    bands: int = 24
    rows: int = 4
    bits: int = 4
    seed: int = 1

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    @property
    def longs(self) -> int:
        return self.minima * self.bits // 64

    @property
    def chance(self) -> float:
        """How often the low bits of different minima agree."""
        return 2.0**-self.bits

    @property
    def most_different(self) -> int:
        """Differing low bits up to which a pair is checked: 4.5 standard deviations from the threshold."""
        agree = self.chance + (1 - self.chance) * self.percent / 100
        spread = 4.5 * math.sqrt(agree * (1 - agree) / self.minima)
        return math.ceil(self.minima * (1 - agree + spread))

    def factors(self) -> np.ndarray:
        return np.random.default_rng(self.seed).integers(1, 2**63, self.minima, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX2
    x = (x ^ (x >> np.uint64(27))) * MIX3
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = xxhash.xxh3_64_intdigest(word)
        if len(word) < 100:
            self[word] = n
        return n


def shingle_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words (all words if there are fewer).

    Words are what ASCII white space separates, with A-Z lower-cased.
    """
    words = text.encode().lower().split() if text else []
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = max(1, min(size, len(h)))
    rolled = h[: max(0, len(h) - size + 1)]
    for i in range(1, size):
        rolled = mixed(rolled * MIX1 + h[i : len(h) - size + 1 + i])
    return np.unique(rolled)


def minima(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), STRIDE):
        part = factors[:, None] * shingles[None, at : at + STRIDE]
        np.minimum(low, (part ^ (part >> np.uint64(29))).min(axis=1), out=low)
    return low


def packed_low_bits(low: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` of each of the minima, packed into 64-bit words."""
    per = 64 // bits
    low_bits = (mixed(low) & np.uint64(2**bits - 1)).reshape(-1, per)
    return np.bitwise_or.reduce(low_bits << (np.arange(per, dtype=np.uint64) * np.uint64(bits)), axis=1)


def band_keys(low: np.ndarray, p: MinHash) -> np.ndarray:
    key = np.arange(1, p.bands + 1, dtype=np.uint64) * MIX1
    for column in low.reshape(p.bands, p.rows).T:
        key = mixed(key * MIX1 + column)
    return key


def version_of(text_col: str) -> Column:
    return F.xxhash64(whole_text(text_col))


def signatures(df: DataFrame, id_col: str, text_col: str, p: MinHash) -> DataFrame:
    """``doc_id, version, n_shingles, set_key, bands, bits`` of each row; the last two are null for empty
    sets. ``version`` is a hash of the text, which tells apart rows that share an id."""
    schema = "doc_id long, version long, n_shingles long, set_key binary, bands array<long>, bits array<long>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, factors = WordHashes(), p.factors()
        for batch in (rows for b in batches for rows in row_portions(b, 2)):
            sizes, keys, bands, bits = [], [], [], []
            for text in batch.column(2).to_pylist():
                shingles = shingle_set(text, p.shingle, hashes)
                low = minima(shingles, factors) if len(shingles) else None
                sizes.append(len(shingles))
                keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                bands.append(None if low is None else band_keys(low, p).view(np.int64))
                bits.append(None if low is None else packed_low_bits(low, p.bits).view(np.int64))
            longs = pa.list_(pa.int64())
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, longs), pa.array(bits, longs)]
            yield pa.record_batch(columns, ["doc_id", "version", "n_shingles", "set_key", "bands", "bits"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), version_of(text_col).alias("version"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(sign), schema)


def different_bits(a: Column, b: Column, p: MinHash) -> Column:
    """Minima whose low bits differ: the bits of each group are or-ed into its lowest, and counted."""
    ones = sum(1 << i for i in range(0, 64, p.bits))
    ones -= (ones >> 63) << 64

    def count(i: int) -> Column:
        x = a[i].bitwiseXOR(b[i])
        folded = x
        for shift in range(1, p.bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, shift))
        return F.bit_count(folded.bitwiseAND(F.lit(ones)))

    return sum((count(i) for i in range(1, p.longs)), count(0))


def estimate(a: Column, b: Column, p: MinHash) -> Column:
    """Similarity of two sets from their packed low bits, corrected for chance agreement."""
    agree = 1 - different_bits(a, b, p) / F.lit(float(p.minima))
    return (agree - p.chance) / (1 - p.chance)


def promising(pairs: DataFrame, nodes: DataFrame, p: MinHash) -> DataFrame:
    """Pairs ``a < b`` whose estimate leaves the threshold possible."""
    side = lambda n: nodes.select(F.col("node").alias(n), F.col("bits").alias(f"bits_{n}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.filter(different_bits(F.col("bits_a"), F.col("bits_b"), p) <= p.most_different).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, p: MinHash) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last_text, last_set = None, None
        for batch in (rows for whole in batches for rows in row_portions(whole, 2, 3)):
            a, b, text_a, text_b = (c.to_pylist() for c in batch.columns)
            linked = []
            for left, right in zip(text_a, text_b):
                if left != last_text:
                    last_text, last_set = left, shingle_set(left, p.shingle, hashes)
                other = shingle_set(right, p.shingle, hashes)
                shared = len(np.intersect1d(last_set, other, assume_unique=True))
                linked.append(100 * shared >= p.percent * (len(last_set) + len(other) - shared))
            mask = pa.array(linked, pa.bool_())
            yield pa.record_batch([pa.array(a, pa.int64()).filter(mask), pa.array(b, pa.int64()).filter(mask)], ["a", "b"])

    side = lambda n: texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(tidy(compare), "a long, b long")


def texts_of(df: DataFrame, id_col: str, text_col: str, wanted: DataFrame, p: MinHash) -> DataFrame:
    """``node, text`` for ``wanted(doc_id, set_key, node)``. An id may be repeated with other texts, so
    the set is made again and compared. Rows without an id have nothing to join by but their sets, which
    are made first; of those with one set, one text is taken."""

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in (rows for b in batches for rows in row_portions(b, 1)):
            keep = [
                hashlib.blake2b(shingle_set(text, p.shingle, hashes).tobytes(), digest_size=16).digest() == key
                for text, key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["node", "text"])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in (rows for b in batches for rows in row_portions(b, 0)):
            texts = batch.column(0).to_pylist()
            keys = [hashlib.blake2b(shingle_set(text, p.shingle, hashes).tobytes(), digest_size=16).digest() for text in texts]
            yield pa.record_batch([pa.array(keys, pa.binary()), batch.column(0)], ["set_key", "text"])

    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    named = docs.join(wanted, "doc_id").select("node", "text", "set_key").mapInArrow(tidy(same), "node long, text string")
    nameless = wanted.filter("doc_id is null").select("set_key", "node")
    if nameless.isEmpty():
        return named
    keys = docs.filter("doc_id is null").select("text").mapInArrow(tidy(keyed), "set_key binary, text string")
    return named.unionByName(keys.join(nameless, "set_key").groupBy("node").agg(F.min("text").alias("text")))


def cross_pairs(members: DataFrame, nodes: DataFrame, p: MinHash) -> DataFrame:
    """Promising pairs of different components within the buckets of ``members(key, node, root)``.

    The largest component of a bucket is dealt out over blocks of about ``BLOCK_ROWS`` rows with all
    others; rows of smaller components visit every block. A task holds one block at a time.
    """
    sizes = stored(members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")), "bucket-sizes")
    mixed_keys = (
        sizes.groupBy("key")
        .agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("total"), F.max(F.struct("n", "root"))["root"].alias("main"))
        .filter("parts > 1")
        .select("key", "main", F.ceil(F.col("total") / BLOCK_ROWS).alias("blocks"))
    )
    mixed_keys = stored(mixed_keys, "mixed-buckets")
    rows = members.join(mixed_keys, "key").join(nodes.select("node", "bits"), "node")
    at_home = rows.withColumns({"block": F.pmod(F.xxhash64("node"), F.col("blocks")), "visits": F.lit(0)})
    visits = rows.filter("root <> main").withColumns({"block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "visits": F.lit(1)})
    dealt = at_home.unionByName(visits).select("key", "block", "visits", "node", "root", "bits")
    most, folds = p.most_different, range(1, p.bits)
    ones = np.uint64(sum(1 << i for i in range(0, 64, p.bits)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, homes = None, []
        for batch in batches:
            key, block, visits, node, root = (batch.column(i).to_numpy() for i in range(5))
            bits = batch.column(5).flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(block) != 0) | (np.diff(visits) != 0)) + 1
            found_a, found_b = [], []
            for i, j in zip([0, *cuts], [*cuts, len(node)]):
                if i == j:
                    continue
                if (key[i], block[i]) != here:
                    here, homes = (key[i], block[i]), []
                if not visits[i]:
                    homes.append((node[i:j], root[i:j], bits[i:j]))
                    continue
                homes = [tuple(np.concatenate(c) for c in zip(*homes))] if homes else []
                for other_node, other_root, other_bits in homes:
                    step = max(1, 500_000 // len(other_node))
                    for k in range(i, j, step):
                        q = slice(k, min(k + step, j))
                        x = bits[q, None, :] ^ other_bits[None, :, :]
                        y = x.copy()
                        for s in folds:
                            y |= x >> np.uint64(s)
                        close = np.bitwise_count(y & ones).sum(axis=2) <= most
                        close &= root[q, None] != other_root[None, :]
                        left, right = np.nonzero(close)
                        found_a.append(node[q][left])
                        found_b.append(other_node[right])
            if found_a:
                a, b = np.concatenate(found_a), np.concatenate(found_b)
                pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    ordered = dealt.repartition(F.col("key"), F.col("block")).sortWithinPartitions("key", "block", "visits")
    return ordered.mapInArrow(tidy(search), "a long, b long").distinct()


class BlockIndex:
    """The sets of one block, laid out by shingle, so a visiting set meets all of them at once."""

    def __init__(self, sets: list[np.ndarray]):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        shingles = np.concatenate(sets)
        order = np.argsort(shingles, kind="stable")
        self.sizes = np.array([len(s) for s in sets])
        self.owner = owner[order]
        self.keys, first = np.unique(shingles[order], return_index=True)
        self.ends = np.append(first, len(shingles))

    def shared(self, shingles: np.ndarray) -> np.ndarray:
        """How many shingles each set has in common with the visitor."""
        at = np.searchsorted(self.keys, shingles)
        at = at[(at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == shingles)]
        spans = [self.owner[a:b] for a, b in zip(self.ends[at].tolist(), self.ends[at + 1].tolist())]
        return np.bincount(np.concatenate(spans), minlength=len(self.sizes)) if spans else np.zeros(len(self.sizes), np.int64)


def links_within(grouped: DataFrame, texts: DataFrame, p: MinHash) -> DataFrame:
    """Links between different components inside the groups of ``grouped(node, group, root)``.

    A group is connected by promising pairs. Its rows are dealt over blocks of about ``TEXT_ROWS``, and
    the rows outside its largest component visit every block with their texts. The full sets are
    compared in the task, so only links leave it: one for each visitor and component of a block.
    """
    sizes = stored(grouped.groupBy("group", "root").agg(F.count(F.lit(1)).alias("n")), "group-sizes")
    split = (
        sizes.groupBy("group")
        .agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("total"), F.max(F.struct("n", "root"))["root"].alias("main"))
        .filter("parts > 1")
        .select("group", "main", F.ceil(F.col("total") / TEXT_ROWS).alias("blocks"))
    )
    rows = stored(grouped.join(stored(split, "split-groups"), "group"), "split-members").join(texts, "node")
    at_home = rows.withColumns({"block": F.pmod(F.xxhash64("node"), F.col("blocks")), "visits": F.lit(0)})
    visits = rows.filter("root <> main").withColumns({"block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "visits": F.lit(1)})
    dealt = at_home.unionByName(visits).select("group", "block", "visits", "node", "root", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        here, index = None, None
        nodes: list[int] = []
        roots: list[int] = []
        sets: list[np.ndarray] = []
        for batch in (rows for b in batches for rows in row_portions(b, 5)):
            found: dict[tuple[int, int], int] = {}
            for group, block, visiting, node, root, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (group, block) != here:
                    here, index = (group, block), None
                    nodes, roots, sets = [], [], []
                own = shingle_set(text, p.shingle, hashes)
                if not visiting:
                    nodes.append(node)
                    roots.append(root)
                    sets.append(own)
                    continue
                if not sets:
                    continue
                index = index or BlockIndex(sets)
                shared = index.shared(own)
                for i in np.flatnonzero(100 * shared >= p.percent * (len(own) + index.sizes - shared)).tolist():
                    if roots[i] != root:
                        found.setdefault((node, roots[i]), nodes[i])
            a = [node for node, _ in found]
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(list(found.values()), pa.int64())], ["a", "b"])

    ordered = dealt.repartition(F.col("group"), F.col("block")).sortWithinPartitions("group", "block", "visits")
    return ordered.mapInArrow(tidy(compare), "a long, b long")


def judged_rows(df: DataFrame, id_col: str, text_col: str, p: MinHash) -> DataFrame:
    """What :func:`near_duplicates` returns, with the ``version`` of each row's text."""
    rows = stored(signatures(df, id_col, text_col, p).withColumn("row_no", F.monotonically_increasing_id()), "signatures")
    # A row with an id stands for its set if there is one, as texts are found by id.
    first_row = F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), F.col("row_no"))), F.min("row_no"))
    groups = stored(rows.filter("n_shingles > 0").groupBy("set_key").agg(first_row.alias("node")), "shingle-sets")
    nodes = stored(
        rows.drop("set_key").join(groups, rows["row_no"] == groups["node"]).select("node", "doc_id", "set_key", "bands", "bits"), "nodes"
    )
    banded = nodes.select("node", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    buckets = stored(buckets, "buckets")
    members = stored(banded.join(buckets, "key"), "bucket-members")
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("doc_id", "set_key", "node")
    texts = stored(texts_of(df, id_col, text_col, wanted, p), "candidate-texts")
    stars = members.select(F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("node").alias("b")), F.struct(F.col("node").alias("a"), F.col("high").alias("b")))).alias("s"))
    first = stored(promising(stars.select("s.*").filter("a < b").distinct(), nodes, p), "star-pairs")
    links = stored(confirmed(first, texts, p), "star-links")
    roots = stored(components(links), "star-roots")
    groups_of = stored(components(first), "star-groups")
    labelled = members.select("key", "node").join(groups_of, "node", "left").withColumn("root", F.coalesce("root", "node"))
    second = stored(cross_pairs(stored(labelled, "labelled"), nodes, p), "cross-pairs")
    grouped = groups_of.withColumnRenamed("root", "group").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    inside = links_within(stored(grouped, "grouped"), texts, p)
    roots = components(links.unionByName(confirmed(second, texts, p)).unionByName(inside))
    named = groups.join(roots, "node").select("set_key", "root")
    named = stored(named, "set-roots")
    lowest = rows.join(named, "set_key").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = named.join(lowest, "root").select("set_key", "component_id")
    alone = groups.join(named, "set_key", "left_anti")
    copies = rows.join(alone, "set_key").groupBy("set_key").agg(F.min("doc_id").alias("component_id"))
    table = stored(linked.unionByName(copies), "components")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return (
        rows.select("doc_id", "version", "n_shingles", "set_key")
        .join(table, "set_key", "left")
        .select("doc_id", "version", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: MinHash = MinHash()) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked when ``100 * |intersection| >= percent * |union|`` of their shingle sets
    (hashed to 64 bits); ``component_id`` is the smallest id that links lead to, and ``kept`` tells
    whether it is the row's own. A text with fewer words than a shingle is one shingle; a null or empty
    text, or one of white space, has none and is linked with nothing. Repeated rows, and different texts
    under one id, take part as they are. A row with a null id can link others but gets a null component
    and is kept. An empty table gives an empty result. Other columns are ignored, whatever their names.

    Equal sets become one node. Nodes that agree in all minima of a band meet in a bucket. Round one
    compares each with the bucket's smallest and largest node only, which links most of a group of copies
    by a number of pairs in proportion to its size. The packed low bits leave the promising pairs, and the
    full sets decide. Promising pairs also make groups, wider than components. Round two searches what
    round one left out, block by block: in buckets, promising pairs of different groups, of which there
    are few; inside a group, the rows outside its largest component, whose sets are compared in the task.
    So no link between components stays unseen beyond what banding and estimate miss (below 1e-5 at the
    threshold), and no group is ever expanded into all its pairs or collected.
    """
    return judged_rows(df, id_col, text_col, p).drop("version")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: MinHash = MinHash()) -> DataFrame:
    """``df`` without the rows that :func:`near_duplicates` does not keep; all columns stay as they are.
    Of different texts under one id, only those go that are not kept themselves."""
    ident, version = fresh(df, "dropped_id", "dropped_version")
    found = judged_rows(df, id_col, text_col, p).filter(~F.col("kept"))
    dropped = stored(found.select(F.col("doc_id").alias(ident), F.col("version").alias(version)).distinct(), "near-dropped")
    same = (df[id_col] == dropped[ident]) & (version_of(text_col) == dropped[version])
    return df.join(dropped, same, "left_anti")
