"""Prefix trie of conversations, with subtree totals by time-forward processing.

A node stands for a distinct sequence of first turns. It is known by the sum of its turns' hashes (each
88 bits of place, role and text), so a parent's key is the node's own minus the last turn's, and keys are
running sums, which need no conversation in one task.

Subtree totals are passed from children to parents in reverse level order: within a shard, nodes come out
of an external sort, deepest first, and send their totals to their parents through a priority queue that
spills. A shard is a subtree of bounded size. The nodes above these subtrees get the sums of their
shard roots' totals, and are cut again, into bands of depth, each below one band root: the bands' totals
are passed on among the band roots in the same way, and then down into the bands.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
import tempfile
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions.skew import attach, ordered_index
from corpusflow.llm.tables import stored

# Messages that a queue holds in memory.
QUEUE_ROWS = 200_000
# Levels of a band of nodes above the bounded subtrees.
BAND = 64
# Nodes of a bounded subtree, at least; it grows with the square root of all turns.
LEAST_SHARD = 64
# Conversations whose numbers are joined to one string at a time.
ENDS_CHUNK = 10_000
KEY = "decimal(38,0)"

Message = tuple[int, object, int, int]  # level (deepest first, so negative), node, leaves, tokens


class SpillingQueue:
    """Messages in order of their receivers. Those beyond ``limit`` wait on disk, in sorted runs."""

    def __init__(self, limit: int):
        self.limit = limit
        self.heap: list[Message] = []
        self.runs: list[tuple[Message, int, Iterator[Message]]] = []

    @staticmethod
    def read(run) -> Iterator[Message]:
        run.seek(0)
        with run:
            while True:
                try:
                    yield pickle.load(run)
                except EOFError:
                    return

    def push(self, message: Message) -> None:
        if len(self.heap) >= self.limit:
            self.spill()
        heapq.heappush(self.heap, message)

    def spill(self) -> None:
        """Write all messages in memory, those to one receiver as one."""
        run = tempfile.TemporaryFile()
        for (level, node), same in groupby(sorted(self.heap), lambda m: m[:2]):
            parts = list(same)
            pickle.dump((level, node, sum(m[2] for m in parts), sum(m[3] for m in parts)), run)
        self.heap = []
        self.follow(self.read(run), len(self.runs))

    def follow(self, run: Iterator[Message], number: int) -> None:
        if (first := next(run, None)) is not None:
            heapq.heappush(self.runs, (first, number, run))

    def take(self, level: int, node: object) -> tuple[int, int]:
        """The sums of all messages to a node, which must be the next receiver or come before it."""
        leaves = tokens = 0
        while self.heap and self.heap[0][:2] == (level, node):
            message = heapq.heappop(self.heap)
            leaves, tokens = leaves + message[2], tokens + message[3]
        while self.runs and self.runs[0][0][:2] == (level, node):
            message, number, run = heapq.heappop(self.runs)
            leaves, tokens = leaves + message[2], tokens + message[3]
            self.follow(run, number)
        return leaves, tokens


TOTALS = pa.schema([("path", pa.decimal128(38, 0)), ("leaves", pa.int64()), ("tokens", pa.int64())])


def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of nodes that come by shard, level (deepest first) and path; a shard is named by its root."""
    shard, queue = None, SpillingQueue(QUEUE_ROWS)
    for batch in batches:
        out: list[tuple] = []
        for of, level, path, parent, leaves, tokens in zip(*(c.to_pylist() for c in batch.columns)):
            if of != shard:
                shard, queue = of, SpillingQueue(QUEUE_ROWS)
            more = queue.take(-level, path)
            leaves, tokens = leaves + more[0], tokens + more[1]
            out.append((path, leaves, tokens))
            if path != shard:
                queue.push((1 - level, parent, leaves, tokens))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), TOTALS)] if out else [[], [], []], schema=TOTALS)


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """``path, leaves, tokens`` summed over each node's subtree within its shard.

    ``nodes(shard, level, path, parent, leaves, tokens)``, where ``shard`` is the path of the shard's root.
    """
    columns = ("shard", "level", "path", "parent", "leaves", "tokens")
    ordered = nodes.select(*columns).repartition("shard").sortWithinPartitions("shard", F.desc("level"), "path")
    return ordered.mapInArrow(forward, f"path {KEY}, leaves long, tokens long")


def with_messages(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    """``nodes`` with the sums of ``messages(to, more_leaves, more_tokens)`` added to their own values."""
    sums = messages.groupBy("to").agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_tokens").alias("more_tokens"))
    none = F.lit(0).cast("long")
    added = {c: F.col(c) + F.coalesce(f"more_{c}", none) for c in ("leaves", "tokens")}
    return nodes.join(sums.withColumnRenamed("to", "path"), "path", "left").withColumns(added).drop("more_leaves", "more_tokens")


def top_totals(nodes: DataFrame, members: DataFrame, step: int = 1) -> DataFrame:
    """``path, leaves, tokens`` summed over each subtree, for a tree of any depth that is not wide.

    ``nodes(path, parent, depth, conv_id, leaves, tokens)``: depths are multiples of ``step``, and ``parent``
    is the node ``step`` turns above. A band of ``BAND`` levels below one node is a shard; what the band
    roots' subtrees hold is worked out among the band roots alone, a tree with ``BAND`` times fewer levels.
    """
    levels = nodes.withColumn("level", F.expr(f"depth div {step}"))
    width = step * BAND
    if levels.agg(F.max("depth")).first()[0] < width:
        return subtree_totals(levels.withColumn("shard", F.lit(0).cast(KEY)))
    above = members.select("conv_id", F.col("depth").alias("top"), F.col("path").alias("shard"))
    banded = stored(levels.withColumn("top", F.col("depth") - F.col("depth") % width).join(above, ["conv_id", "top"]), "bands")
    roots = banded.filter("path = shard").select("path", F.col("parent").alias("to"), "conv_id", "depth")
    higher = members.select("conv_id", (F.col("depth") + width).alias("depth"), F.col("path").alias("parent"))
    whole = roots.drop("to").join(subtree_totals(banded), "path").join(higher, ["conv_id", "depth"], "left")
    over = stored(top_totals(stored(whole, "band-roots"), members, width), "band-totals")
    renamed = over.select("path", F.col("leaves").alias("more_leaves"), F.col("tokens").alias("more_tokens"))
    messages = roots.filter(F.col("to").isNotNull()).join(renamed, "path").select("to", "more_leaves", "more_tokens")
    return subtree_totals(with_messages(banded, messages))


def joined_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks, joined by commas; they come by node and order."""
    path, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        for of, chunk in zip(batch["path"].to_pylist(), batch["chunk"].to_pylist()):
            if of != path:
                if path is not None:
                    done.append((path, digest.hexdigest()))
                path, digest = of, hashlib.sha256(chunk.encode())
            else:
                digest.update(b"," + chunk.encode())
        yield ends_batch(done)
    if path is not None:
        yield ends_batch([(path, digest.hexdigest())])


def ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("path", pa.decimal128(38, 0)), ("ends_sha256", pa.string())])
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def ends_digests(members: DataFrame) -> DataFrame:
    """``path, ends_sha256`` of nodes at which conversations end: their numbers, ascending, joined by commas.

    Numbers are joined in chunks wherever they are, so the one task that digests a node's gets few strings.
    """
    ends = ordered_index(members.filter("depth = n_turns").select("path", "conv_id"), ["path"], ["conv_id"])
    numbers = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = ends.groupBy("path", F.expr(f"(_idx - 1) div {ENDS_CHUNK}").alias("at")).agg(F.array_join(numbers, ",").alias("chunk"))
    ordered = chunks.repartition("path").sortWithinPartitions("path", "at").select("path", "chunk")
    return ordered.mapInArrow(joined_ends, f"path {KEY}, ends_sha256 string")


def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """``conv_id, depth, n_turns, role, text``: turns in order, from 1; nulls of role and text are empty.

    A null turn comes first; equal turns are in the order of role and text, and repeated rows are turns of
    their own. Turns without a conversation belong to none, and are left out.
    """
    empty = F.lit("")
    plain = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    placed = ordered_index(plain, ["conv_id"], ["turn", "role", "text"])
    return placed.select("conv_id", F.col("_idx").alias("depth"), F.col("_n").alias("n_turns"), "role", "text")


def rebuilt(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like others: their numbers, and their turns ``conv_id, depth, role, text``.

    The first h turns of conversation c are those of c - c % ``every`` (if that exists), where h is the CRC-32 of
    c's digits modulo ``most``; c's own turns after its first h follow, if there are any.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % most).alias("h")
    sizes = turns.groupBy("conv_id").agg(F.max("n_turns").alias("n"))
    convs = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h)
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    none = F.lit(0).cast("long")
    convs = stored(convs.join(bases, "base", "left").withColumn("shared", F.least("h", F.coalesce("n_base", none))), "conversations")
    plan = convs.select("conv_id", "n", "h", "shared")
    own = attach(turns, plan, ["conv_id"], ["depth"], "n").filter(F.col("depth") > F.col("h"))
    own = own.select("conv_id", (F.col("depth") - F.col("h") + F.col("shared")).alias("depth"), "role", "text")
    heads = turns.filter(F.col("depth") < most).select(F.col("conv_id").alias("base"), "depth", "role", "text")
    lent = heads.join(convs.select("conv_id", "base", "h"), "base").filter(F.col("depth") <= F.col("h"))
    return convs.select("conv_id"), own.unionByName(lent.select("conv_id", "depth", "role", "text"))


def turn_hash(depth: Column, role: Column, text: Column) -> Column:
    """88 bits of a turn and its place, as a decimal that can be summed over 10^11 turns."""
    half = [F.xxhash64(F.lit(seed), depth, role, text).bitwiseAND((1 << 44) - 1).cast("decimal(14,0)") for seed in (1, 2)]
    return (half[0] * F.lit(1 << 44).cast("decimal(14,0)") + half[1]).cast("decimal(27,0)")


def conversation_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations ``convs(conv_id)`` with turns ``turns(conv_id, depth, role, text)``.

    ``depth`` counts a conversation's turns from 1, without gaps; conversations without turns are members
    of the root only. Returns one row per node: ``conv_id``, its smallest member; ``depth``; ``parent_conv_id``, the
    parent's ``conv_id`` (root: null); ``n_convs``, members; ``n_children``; ``n_leaves``, childless nodes of its
    subtree, itself included; ``saved_tokens``, over its subtree, the bytes of a node's last text times its
    members but one; ``ends_sha256``, digest of the members that end there. No conversations give no nodes.

    Conversations and nodes of any size are fine: members are counted by partial aggregation, running sums
    and joins to parents split large groups, and a shard's task holds a bounded part of the tree.
    """
    hashed = turns.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        turn_hash(F.col("depth").cast("long"), F.col("role"), F.col("text")).alias("own"),
        F.octet_length("text").cast("long").alias("bytes"),
    )
    summed = ordered_index(stored(hashed, "turn-hashes"), ["conv_id"], ["depth"], running={"path": F.col("own")})
    below = summed.select(
        "conv_id",
        "depth",
        F.col("path").cast(KEY).alias("path"),
        (F.col("path") - F.col("own")).cast(KEY).alias("parent"),
        "bytes",
        F.col("_n").alias("n_turns"),
    )
    sizes = hashed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    none = F.lit(0).cast("long")
    roots = convs.select("conv_id").distinct().join(sizes, "conv_id", "left").select(
        "conv_id",
        none.alias("depth"),
        F.lit(0).cast(KEY).alias("path"),
        F.lit(None).cast(KEY).alias("parent"),
        none.alias("bytes"),
        F.coalesce("n_turns", none).alias("n_turns"),
    )
    members = stored(below.unionByName(roots), "members")
    # As many nodes as a subtree can have at most.
    weight = (F.sum(F.col("n_turns") - F.col("depth")) + 1).alias("weight")
    nodes = stored(
        members.groupBy("path").agg(
            F.first("depth").alias("depth"),
            F.first("parent").alias("parent"),
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            F.first("bytes").alias("bytes"),
            weight,
        ),
        "nodes",
    )
    n_rows = nodes.agg(F.sum("n_convs")).first()[0] or 0
    bound = max(LEAST_SHARD, math.isqrt(n_rows))
    children = nodes.groupBy(F.col("parent").alias("path")).agg(F.count(F.lit(1)).alias("n_children"))
    known = nodes.join(children, "path", "left").withColumn("n_children", F.coalesce("n_children", none))
    parents = known.filter("n_children > 0").select(
        F.col("path").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
        F.col("weight").alias("parent_weight"),
        F.col("n_children").alias("siblings"),
    )
    linked = attach(known, parents, ["parent"], ["path"], "siblings").drop("siblings")
    valued = stored(
        linked.withColumns(
            {
                "leaves": (F.col("n_children") == 0).cast("long"),
                "tokens": (F.col("n_convs") - 1) * F.col("bytes"),
                "light": F.col("weight") <= bound,
            }
        ),
        "linked-nodes",
    )
    # A light node's shard is the first light node on the way to it, the same for all its members.
    weights = valued.select("path", "light", F.col("n_convs").alias("rows"))
    lit = attach(members.select("conv_id", "depth", "path"), weights, ["path"], ["conv_id"], "rows").filter("light")
    shards = lit.groupBy("conv_id").agg(F.min_by("path", "depth").alias("shard"))
    light = valued.filter("light").join(shards, "conv_id").withColumn("level", F.col("depth"))
    light_totals = stored(subtree_totals(light), "light-totals")
    top = valued.filter(~F.col("light"))
    totals = light_totals
    if not top.isEmpty():
        roots_of_light = valued.filter(F.col("light") & (F.col("parent_weight") > bound)).select("path", F.col("parent").alias("to"))
        sent = light_totals.select("path", F.col("leaves").alias("more_leaves"), F.col("tokens").alias("more_tokens"))
        heavy = with_messages(top, roots_of_light.join(sent, "path").drop("path"))
        wanted = ("path", "parent", "depth", "conv_id", "leaves", "tokens")
        heavy = stored(heavy.select(*wanted), "top-nodes")
        totals = totals.unionByName(top_totals(heavy, members.select("conv_id", "depth", "path")))
    return (
        valued.drop("leaves", "tokens")
        .join(totals, "path")
        .join(ends_digests(members), "path", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("tokens").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
