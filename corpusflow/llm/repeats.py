"""Repeated passages: a radix sort of suffixes, limited to the threshold's depth, over many tasks.

A suffix need be ordered by its first ``length`` bytes only: suffixes that are still in one group after
the last digit are exactly the repeated windows of that length. Digits are taken most significant first,
and a group of one drops out before the next.

The first digit is not the first bytes of the window but those at its anchor: the place, of all its
``width``-byte grams, whose hash is lowest. Equal windows have equal anchors at equal offsets, and
neighbouring windows mostly share one, so the first pass moves one row for about 35 bytes of text instead
of one for each byte. Its survivors, the anchors whose gram occurs twice, go on with the bytes of all
their windows to the second pass. There a group that fits a task is sorted through the remaining digits.
A larger one is cut by offset into halves, each with the bytes that all its windows share as a longer
digit, down to single windows if need be; those are settled as a stream. So a passage shared by any
number of documents never has to fit a task, and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.tables import stored, whole_text

# Bytes of text handled at a time within a task, and distinct contexts of one group sorted in a task.
PORTION = 1 << 20
GROUP_ROWS = 2_000
NO_ID = -(2**63)
A1, A2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
BYTE_HASHES = np.random.default_rng(4).integers(0, 2**64, 256, dtype=np.uint64)

CONTEXT = "key long, doc long, version long, start int, n int, anchor int, level int, bytes binary"
NAMES = ["key", "doc", "version", "start", "n", "anchor", "level", "bytes"]
TYPES = [pa.int64()] * 3 + [pa.int32()] * 4 + [pa.binary()]
Context = tuple[int, int, int, int, int, int, int, bytes | None]


@dataclass(frozen=True)
class Windows:
    """Windows of ``length`` bytes; groups of up to ``group_rows`` different contexts are sorted in one task."""

    length: int = 100
    group_rows: int = GROUP_ROWS

    @property
    def width(self) -> int:
        """Bytes of a gram: the largest power of two up to a third of the window."""
        return 1 << ((self.length // 3).bit_length() - 1)

    @property
    def places(self) -> int:
        return self.length - self.width + 1

    @property
    def levels(self) -> int:
        """Halvings after which a row is a single window."""
        return (self.places - 1).bit_length()


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of the ``width`` bytes from each position on, by doubling; ``width`` is a power of two."""
    h, n = BYTE_HASHES[data], 1
    while n < width:
        h = h[:-n] * A1 + h[n:]
        h ^= h >> np.uint64(29)
        h *= A2
        n *= 2
    return h


def anchor_offsets(h: np.ndarray, places: int) -> np.ndarray:
    """For each window start, how far on the first of the lowest of its ``places`` gram hashes is."""
    bits = max(1, (places - 1).bit_length())
    low = h >> np.uint64(bits) << np.uint64(bits)
    n = 1
    while 2 * n <= places:
        low = np.minimum(low[:-n], low[n:] + np.uint64(n))
        n *= 2
    if rest := places - n:
        low = np.minimum(low[:-rest], low[rest:] + np.uint64(rest))
    return (low & np.uint64((1 << bits) - 1)).astype(np.int64)


def anchors(texts: list[bytes], w: Windows) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Yields ``(i, from, first, last, at, hash)`` arrays: for each anchor of ``texts[i]``, the first and
    last window start that has it, its place and gram hash. Long texts come in several overlapping parts,
    short ones are hashed together."""
    at = 0
    while at < len(texts):
        group, size = [], 0
        while at < len(texts) and (not group or size + len(texts[at]) <= PORTION):
            group.append(at)
            size += len(texts[at])
            at += 1
        parts = [(i, s) for i in group for s in range(0, max(1, len(texts[i]) - w.length + 1), PORTION)]
        for batch in [parts] if size <= PORTION else [[p] for p in parts]:
            pieces = [texts[i][s : s + PORTION + w.length - 1] for i, s in batch]
            joined = b"".join(pieces)
            if len(joined) < w.length:
                continue
            h = gram_hashes(np.frombuffer(joined, np.uint8), w.width)
            place = anchor_offsets(h, w.places)
            place += np.arange(len(place))
            base = 0
            for (i, s), piece in zip(batch, pieces):
                n = len(piece) - w.length + 1
                if n > 0:
                    own = place[base : base + n]
                    cut = np.flatnonzero(np.diff(own)) + 1
                    first = np.concatenate([[0], cut])
                    last = np.concatenate([cut, [n]]) - 1
                    chosen = own[first]
                    yield i, s, first, last, chosen - base, h[chosen]
                base += len(piece)


def portions(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``PORTION`` bytes of text, or a single longer one."""
    sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    at = 0
    ends = np.cumsum(sizes)
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + PORTION, "right")))
        yield batch.slice(at, end - at)
        at = end


def first_digits(docs: DataFrame, w: Windows) -> DataFrame:
    """``key, doc, pos, known`` of the anchors of ``docs(doc, text)``.

    Of equal keys within a portion only the first stays under its key; the others are known to be
    repeated and get a key of their own, so a frequent one does not gather in one task.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 1):
                ids = part.column(0).to_numpy()
                texts = part.column(1).cast(pa.binary()).to_pylist()
                keys, docs, spots = [], [], []
                for i, s, _, _, at, h in anchors(texts, w):
                    keys.append(h)
                    docs.append(np.full(len(h), ids[i]))
                    spots.append(at + s)
                if not keys:
                    continue
                key, doc, pos = np.concatenate(keys).view(np.int64), np.concatenate(docs), np.concatenate(spots)
                order = np.argsort(key, kind="stable")
                again = np.zeros(len(key), bool)
                equal = key[order][1:] == key[order][:-1]
                again[order[1:]] = equal
                known = again.copy()
                known[order[:-1]] |= equal
                own = ((doc.view(np.uint64) * A1 + pos.astype(np.uint64)) * A2).view(np.int64)
                columns = [pa.array(np.where(again, own, key)), pa.array(doc), pa.array(pos.astype(np.int32)), pa.array(known)]
                yield pa.record_batch(columns, ["key", "doc", "pos", "known"])

    return docs.mapInArrow(extract, "key long, doc long, pos int, known boolean")


def repeated_anchors(digits: DataFrame) -> DataFrame:
    """``doc, pos`` of the anchors whose key occurs twice."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, until it is known whether the next has its key
        for batch in batches:
            key, doc, pos, known = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(key):
                continue
            if held is not None:
                key, doc, pos, known = (np.concatenate([[x], y]) for x, y in zip(held, (key, doc, pos, known)))
            known = known.astype(bool)
            equal = key[1:] == key[:-1]
            known[1:] |= equal
            known[:-1] |= equal
            held = (key[-1], doc[-1], pos[-1], known[-1])
            yield pa.record_batch([pa.array(doc[:-1][known[:-1]]), pa.array(pos[:-1][known[:-1]].astype(np.int32))], ["doc", "pos"])
        if held is not None and held[3]:
            yield pa.record_batch([pa.array([held[1]], pa.int64()), pa.array([held[2]], pa.int32())], ["doc", "pos"])

    return digits.repartition("key").sortWithinPartitions("key").mapInArrow(select, "doc long, pos int")


def as_batch(rows: list[Context]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(NAMES)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, TYPES)], NAMES)


def settled(row: Context, start: int, n: int) -> Context:
    """A row that says: the ``n`` windows from ``start`` on are repeated. It has no bytes."""
    own = (row[1] * 0x9E3779B97F4A7C15 + start * 0xD6E8FEB86659FD93) % 2**64 - 2**63  # spreads them evenly
    return (own, row[1], row[2], start, n, 0, -1, None)


def place(row: Context) -> tuple[int, int, int]:
    return row[1:4]


def contexts(docs: DataFrame, w: Windows) -> DataFrame:
    """The windows of the anchors in ``docs(doc, version, text, spots)``: one row for each anchor.

    Of rows with the same bytes in a portion, only the earliest goes on; the others are settled.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2):
                doc, version = part.column(0).to_pylist(), part.column(1).to_pylist()
                texts = part.column(2).cast(pa.binary()).to_pylist()
                spots = [s.values.to_numpy() for s in part.column(3)]
                held: dict[tuple, Context] = {}
                done: list[Context] = []
                for i, s, first, last, at, h in anchors(texts, w):
                    wanted = np.flatnonzero(np.isin(at + s, spots[i]))
                    text, d, v = texts[i], doc[i], version[i]
                    for f, z, a, k in zip((first[wanted] + s).tolist(), (last[wanted] + s).tolist(), (at[wanted] + s).tolist(), h[wanted].view(np.int64).tolist()):
                        row = (k, d, v, f, z - f + 1, a - f, 0, text[f : z + w.length])
                        keep_earlier(held, row, done)
                yield as_batch([*held.values(), *done])

    return docs.mapInArrow(extract, CONTEXT)


def keep_earlier(held: dict[tuple, Context], row: Context, done: list[Context]) -> None:
    """Hold one row for the same bytes and anchor: the earliest. The other one is settled whole."""
    same = (row[0], row[5], row[7])
    other = held.setdefault(same, row)
    if other is not row:
        if place(row) < place(other):
            held[same], row = row, other
        if place(row) != place(held[same]):
            done.append(settled(row, row[3], row[4]))


def halves(row: Context, w: Windows) -> list[Context]:
    """The row cut along the next level's grid of offsets, each part under a hash of what its windows share."""
    _, doc, version, start, n, anchor, level, data = row
    grid = -(-w.places // (1 << (level + 1)))
    out = []
    i = 0
    while i < n:
        cell = (anchor - i) // grid
        end = min(n, anchor - cell * grid + 1)  # the last window of the cell has the cell's least offset
        shared = data[anchor - cell * grid : anchor - (cell * grid + grid - 1) + w.length]
        key = xxhash.xxh3_64_intdigest(shared, cell << 8 | (level + 1))
        key -= (key >> 63) << 64
        out.append((key, doc, version, start + i, end - i, anchor - i, level + 1, data[i : end - 1 + w.length]))
        i = end
    return out


def sort_groups(groups: list[list[Context]], w: Windows) -> list[Context]:
    """Most-significant-digit passes over the windows of whole groups; settles all but the first of equals."""
    rows = [r for g in groups for r in g]
    data = np.frombuffer(b"".join(r[7] for r in rows), np.uint8)
    sizes = np.array([len(r[7]) for r in rows])
    base = np.cumsum(sizes) - sizes
    n = np.array([r[4] for r in rows])
    total = int(n.sum())
    row = np.repeat(np.arange(len(rows)), n)
    i = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    group = np.repeat(np.repeat(np.arange(len(groups)), [len(g) for g in groups]), n)
    offset = np.repeat(np.array([r[5] for r in rows]), n) - i
    at = base[row] + i
    h = gram_hashes(data, w.width)
    group = (group * w.length + offset).astype(np.uint64)
    alive = np.arange(total)
    depths = [*range(0, w.length - w.width, w.width), w.length - w.width]
    for depth in depths:
        digit = (h[at[alive] + depth] + group) * A1
        digit = (digit ^ (digit >> np.uint64(31)) ^ group) * A2
        order = np.argsort(digit)
        digit = digit[order]
        new = np.concatenate([[True], digit[1:] != digit[:-1]])
        number = np.cumsum(new) - 1
        many = np.bincount(number)[number] > 1
        alive, group = alive[order[many]], number[many].astype(np.uint64)
        if not len(alive):
            return []
    by_place = sorted(range(len(rows)), key=lambda k: place(rows[k]))
    rank = np.empty(len(rows), np.int64)
    rank[by_place] = np.arange(len(rows))
    order = np.lexsort((rank[row[alive]], group))
    first = np.concatenate([[True], group[order][1:] != group[order][:-1]])
    late = np.sort(alive[order[~first]])
    if not len(late):
        return []
    cut = np.flatnonzero((np.diff(late) != 1) | (np.diff(row[late]) != 0)) + 1
    out = []
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(late)]):
        r = rows[row[late[a]]]
        out.append(settled(r, r[3] + int(i[late[a]]), b - a))
    return out


def resolve(rows: DataFrame, w: Windows) -> DataFrame:
    """Settles groups of equal keys; rows of groups too large for a task come back cut for the next level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, over = None, {}, False
        groups: list[list[Context]] = []
        waiting = 0
        out: list[Context] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[7] is None:
                    out.append(row)
                    continue
                if row[0] != key:
                    if not over and len(held) > 1:
                        groups.append(list(held.values()))
                        waiting += len(held)
                    elif over:
                        for one in held.values():
                            out += halves(one, w)
                    key, held, over = row[0], {}, False
                keep_earlier(held, row, out)
                # On the last level all windows under one key are equal, and at most one row is held.
                if len(held) > w.group_rows and row[6] < w.levels:
                    over = True
                    for one in held.values():
                        out += halves(one, w)
                    held = {}
            if waiting >= w.group_rows:
                out += sort_groups(groups, w)
                groups, waiting = [], 0
            if out:
                yield as_batch(out)
                out = []
        if over:
            for one in held.values():
                out += halves(one, w)
        elif len(held) > 1:
            groups.append(list(held.values()))
        if groups:
            out += sort_groups(groups, w)
        if out:
            yield as_batch(out)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, CONTEXT)


def remove(docs: DataFrame, w: Windows) -> DataFrame:
    """Cuts the windows in ``late`` out of ``docs(doc, version, text, late)``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2):
                spans, kept = [], []
                for text, late in zip(part.column(2).cast(pa.binary()).to_pylist(), part.column(3)):
                    flat = late.values.flatten()
                    start, n = (f.to_numpy() for f in flat)
                    change = np.zeros(len(text) + 1, np.int32)
                    np.add.at(change, start, 1)
                    np.add.at(change, start + n - 1 + w.length, -1)
                    gone = np.cumsum(change[:-1]) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                    kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                columns = [part.column(0), part.column(1), pa.array(spans, kind), pa.array(kept, pa.binary())]
                yield pa.record_batch(columns, ["doc", "version", "spans", "kept"])

    return docs.mapInArrow(cut, "doc long, version long, spans array<struct<start:int,end:int>>, kept binary")


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``doc_id, version, spans, kept`` of the documents from which something is removed.

    Texts are UTF-8 bytes, null is empty. Removed is each byte covered by a string of ``length`` bytes
    that also starts earlier: in a document with a smaller id, or in the same one before. Overlapping
    occurrences count, and all strings are judged on the input. ``spans`` are the maximal removed runs as
    byte offsets, ``kept`` the other bytes in order. ``version`` is ``xxhash64`` of the text: rows that
    repeat an id with another text are further documents, in the order of that hash, and rows that repeat
    both are one document. A null id comes before all others (and is returned as null). Texts shorter
    than ``length``, empty texts and empty tables have nothing removed. Other columns are ignored.
    """
    w = Windows(length, group_rows)
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), whole_text(text_col).alias("text"))
    found = repeated_anchors(first_digits(docs.filter(F.octet_length("text") >= length), w))
    spots = stored(found.groupBy("doc").agg(F.collect_list("pos").alias("spots")), "repeated-anchors")
    work = docs.join(spots, "doc").select("doc", F.xxhash64("text").alias("version"), "text", "spots").dropDuplicates(["doc", "version"])
    work = stored(work, "repeat-candidates")
    level = stored(resolve(contexts(work, w), w), "repeat-level-0")
    late = level.filter("bytes is null")
    depth = 0
    while not (rest := level.filter("bytes is not null")).isEmpty():
        depth += 1
        level = stored(resolve(rest, w), f"repeat-level-{depth}")
        late = late.unionByName(level.filter("bytes is null"))
    late = late.groupBy("doc", "version").agg(F.collect_list(F.struct("start", "n")).alias("late"))
    changed = work.drop("spots").join(late, ["doc", "version"])
    return remove(changed, w).select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "version", "spans", "kept")
