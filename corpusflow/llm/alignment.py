"""Alignment of two tokenizations of a text, and how often pairs of their tokens meet in the corpus.

Both tokenizations cover the same bytes. Where a token of either ends at the same byte, the text is cut
into groups. Most groups hold one token of each side for long stretches, so the end arrays are compared
along a diagonal: from ``ends_a[i] == ends_b[j]`` on, slices of doubling length at the shift ``j - i`` are
compared as wholes, then halving ones find where the stretch ends. The irregular group that follows is
walked token by token up to the next common end, which gives the shift of the next stretch.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.pieces import LETTERS, PIECES
from corpusflow.llm.tables import fresh, stored, whole_text
from corpusflow.llm.token_counts import byte_letters

# Both tokenizers cut before a space that follows something other than white space.
chunks_of = re.compile(r"(?<=\S)(?= )").split
# Within a chunk they also cut before a line feed that follows such, and between a letter and a mark.
words_of = re.compile(rf"(?<=\S)(?=\n)|(?<=[{LETTERS}])(?=[.,;:!?])").split
# Chunks, and words, whose alignments a worker remembers. More only saves time.
REMEMBERED = 400_000
# Chunks of a text that are looked up at a time.
PORTION = 50_000
# Pairs of ids whose counts are broadcast; the others are joined by a shuffle.
BROADCAST_PAIRS = 1_000_000

# From and to which token of either side, and whether it is one group with several tokens on a side.
Run = tuple[int, int, int, int, bool]


def stretch(x: list[int], y: list[int], i: int, j: int) -> int:
    """How many ends from ``i`` and ``j`` on are equal one by one, by exponential probing.

    Both arrays have the same last end, so neither runs out before the other on equal ends.
    """
    n, step = 0, 1
    while i + n < len(x) and x[i + n : i + n + step] == y[j + n : j + n + step]:
        n += step
        step *= 2
    while step > 1:
        step //= 2
        if i + n < len(x) and x[i + n : i + n + step] == y[j + n : j + n + step]:
            n += step
    return min(n, len(x) - i)


def align(x: list[int], y: list[int]) -> tuple[list[Run], list[int], list[int]]:
    """Runs of two arrays of ends, and the indices of all overlapping pairs.

    A run is a stretch of groups of one token each, or one irregular group.
    """
    runs: list[Run] = []
    left: list[int] = []
    right: list[int] = []
    i = j = 0
    while i < len(x):
        if n := stretch(x, y, i, j):
            runs.append((i, i + n, j, j + n, False))
            left += range(i, i + n)
            right += range(j, j + n)
            i += n
            j += n
            if i == len(x):
                break
        first_i, first_j = i, j
        end_x, end_y = x[i], y[j]
        while end_x != end_y:
            left.append(i)
            right.append(j)
            if end_x < end_y:
                i += 1
                end_x = x[i]
            else:
                j += 1
                end_y = y[j]
        left.append(i)
        right.append(j)
        i += 1
        j += 1
        runs.append((first_i, i, first_j, j, True))
    return runs, left, right


# A chunk's groups as they are written, its links as packed id pairs, and its tokens on side A.
Aligned = tuple[bytes, bytes, int]


def side_a(path: str, model: dict, entries: dict[int, bytes]) -> Callable[[str], list[int]]:
    """The encoder of a byte-level vocabulary: the faster library's if ids are in the order of the merges."""
    made = (model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"])
    if sum(len(e) == 1 for e in entries.values()) == 256 and all(i < j for i, j in pairwise(chain((255,), made))):
        import tiktoken

        ranks = {data: i for i, data in entries.items()}
        return tiktoken.Encoding("side-a", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return lambda text: whole.encode(text, add_special_tokens=False).ids


class Chunks:
    """Alignments of the chunks met so far; ``None`` where the tokenizers don't cover a chunk's bytes."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor

        self.known: dict[str, Aligned | None] = {}
        self.words: dict[str, Aligned | None] = {}
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        with open(path_a, encoding="utf-8") as f:
            model = json.load(f)["model"]
        of_a = {i: bytes(map(letters.get, e)) for e, i in model["vocab"].items() if all(c in letters for c in e)}
        self.encode_a = side_a(path_a, model, of_a)
        of_b = {i: self.piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())}
        if any(re.search(rf"\S[ \n]|[{LETTERS}][.,;:!?]", p.decode()) for p in of_b.values() if len(p) > 1 and p != b"<unk>"):
            raise ValueError("the second vocabulary has entries that go on after a word")
        self.bytes_a, self.bytes_b = of_a.__getitem__, of_b.__getitem__
        self.size_a, self.size_b = self.sizes(of_a), self.sizes(of_b)
        self.str_a = [f"{i}|" for i in range(len(self.size_a))].__getitem__
        self.str_b = [f"{i};" for i in range(len(self.size_b))].__getitem__
        self.space = [self.b.piece_to_id("▁")]

    @staticmethod
    def piece_bytes(piece: str) -> bytes:
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    @staticmethod
    def sizes(entries: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(max(entries) + 1, np.int64)
        for i, data in entries.items():
            out[i] = len(data)
        return out

    def encode(self, data: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides for text that begins with a space; ``None`` if a side changes the text."""
        a = self.encode_a(data)
        b = self.b.encode(data[1:]) or self.space  # this side adds the first space itself
        if b"".join(map(self.bytes_a, a)) == data.encode() == b"".join(map(self.bytes_b, b)):
            return np.array(a, np.int64), np.array(b, np.int64)
        return None

    def ends(self, a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
        return np.cumsum(self.size_a[a]).tolist(), np.cumsum(self.size_b[b]).tolist()

    def learn(self, new: set[str]) -> None:
        """Put together the alignments of chunks from those of their words, and of marks behind these."""
        words = {c: words_of(c) for c in new}
        wanted = set(chain.from_iterable(words.values()))
        if len(self.words) > REMEMBERED:
            self.words = {}
        self.learn_words(wanted.difference(self.words))
        for chunk, parts in words.items():
            found = list(map(self.words.__getitem__, parts))
            if None in found:
                self.known[chunk] = None
            elif len(found) == 1:
                self.known[chunk] = found[0]
            else:
                written, links, n_a = zip(*found)
                self.known[chunk] = b";".join(written), b"".join(links), sum(n_a)

    def learn_words(self, new: set[str]) -> None:
        """Align words that are not remembered.

        Both tokenizers cut where one word meets the next, so words that don't end with white space are put
        one after the other, marks behind a letter, and aligned as one text. The others, and if a tokenizer changes
        some word, all, are aligned one by one.
        """
        plain = [w for w in new if not w[-1].isspace()]
        if plain and not self.learn_text(plain):
            plain = []
        for word in new.difference(plain):
            if not self.learn_text([word]):
                self.words[word] = None

    def learn_text(self, parts: list[str]) -> bool:
        """Align the text made of ``parts``, and remember each one's share; whether that was possible."""
        before = ["" if p[0].isspace() else "\na" for p in parts]
        if parts[0][0] != " ":
            before[0] = " a"
        if (ids := self.encode("".join(chain.from_iterable(zip(before, parts))))) is None:
            return False
        a, b = ids
        x, y = self.ends(a, b)
        runs, left, right = align(x, y)
        links = (a[left] << 32 | b[right]).tobytes()
        of_a, of_b = list(map(self.str_a, a.tolist())), list(map(self.str_b, b.tolist()))
        written: list[str] = []
        for i, to_i, j, to_j, one in runs:
            if one:
                # One string for each token, so that a token's place tells its string's.
                written += [f"{s[:-1]}," for s in of_a[i : to_i - 1]]
                written.append(of_a[to_i - 1])
                written += [f"{s[:-1]}," for s in of_b[j : to_j - 1]]
                written.append(of_b[to_j - 1])
            else:
                written += chain.from_iterable(zip(of_a[i:to_i], of_b[j:to_j]))
        # Where each part begins and ends in the text, on either side, and among the links.
        size = np.array([len(p.encode()) for p in parts])
        to = np.cumsum(size + [len(f) for f in before])
        cuts = np.array([to - size, to])
        in_a, in_b = (np.searchsorted(ends, cuts, "right") for ends in (x, y))
        in_links = np.searchsorted(left, in_a, "left")
        spans = np.stack([in_a[0], in_a[1], *(in_a + in_b), *(8 * in_links)], axis=1).tolist()
        for part, (i, to_i, w, to_w, k, to_k) in zip(parts, spans):
            self.words[part] = "".join(written[w:to_w])[:-1].encode(), links[k:to_k], to_i - i
        return True

    def of(self, text: str) -> list[Aligned] | None:
        """Alignments of a text's chunks, in order; ``None`` if a tokenizer changes the text."""
        parts = chunks_of(" " + text)
        out: list[Aligned] = []
        for at in range(0, len(parts), PORTION):
            portion = parts[at : at + PORTION]
            if len(self.known) > REMEMBERED:
                self.known = {}
            if new := set(portion).difference(self.known):
                self.learn(new)
            out += map(self.known.__getitem__, portion)
        return None if None in out else out

    def summary(self, text: str | None) -> tuple[int, int, int, str, np.ndarray, np.ndarray]:
        """Tokens of either side, groups, their digest, and the distinct linked id pairs with their links."""
        found = self.of(text) if text else None
        if found is None:
            return 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64)
        each_written, each_links, each_n = zip(*found)
        written, links = b";".join(each_written), np.frombuffer(b"".join(each_links), np.int64)
        n_a, n_groups = sum(each_n), written.count(b"|")
        pairs, times = np.unique(links, return_counts=True)
        # Within a group, links are one fewer than tokens.
        return n_a, len(links) + n_groups - n_a, n_groups, hashlib.sha256(written).hexdigest(), pairs, times

    def spans(self, text: str | None) -> list[dict]:
        """The groups of a text: its first byte and the byte after, and its tokens' places on either side."""
        out, at, at_a, at_b = [], 0, 0, 0
        for written, _, _ in (self.of(text) if text else None) or ():
            for group in written.split(b";"):
                a, b = (np.array(side.split(b","), np.int64) for side in group.split(b"|"))
                to, to_a, to_b = at + int(self.size_a[a].sum()), at_a + len(a), at_b + len(b)
                out.append({"start": at, "end": to, "from_a": at_a, "to_a": to_a, "from_b": at_b, "to_b": to_b})
                at, at_a, at_b = to, to_a, to_b
        return out


@lru_cache(maxsize=2)
def chunks(path_a: str, path_b: str) -> Chunks:
    """One memory for each two vocabularies and Python worker."""
    return Chunks(path_a, path_b)


PAIR = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("links", pa.int32())])
SUMMARY = "struct<n_a:long,n_b:long,n_groups:long,groups_sha256:string,pairs:array<struct<a:int,b:int,links:int>>>"


def summary(text: Column, path_a: str, path_b: str) -> Column:
    """What :func:`with_alignment` needs to know of a text, in one pass over it."""

    @F.arrow_udf(SUMMARY)
    def summarise(texts: pa.Array) -> pa.Array:
        one = chunks(path_a, path_b).summary
        rows = [one(t.as_py()) for t in texts]
        ends = np.cumsum([0, *(len(r[4]) for r in rows)])
        codes = np.concatenate([r[4] for r in rows]) if rows else np.empty(0, np.int64)
        times = np.concatenate([r[5] for r in rows]) if rows else np.empty(0, np.int64)
        fields = [pa.array(v.astype(np.int32)) for v in (codes >> 32, codes & 0xFFFFFFFF, times)]
        pairs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(PAIR)))
        numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
        digests = pa.array([r[3] for r in rows], pa.string())
        return pa.StructArray.from_arrays([*numbers, digests, pairs], ["n_a", "n_b", "n_groups", "groups_sha256", "pairs"])

    return summarise(text)


def with_groups(df: DataFrame, path_a: str, path_b: str, text_col: str = "text", groups_col: str = "groups") -> DataFrame:
    """``df`` with the groups of each text, in order, in ``groups_col`` (replaced if it exists).

    A group is a struct of ``start, end`` (bytes of the text with the space before it) and ``from_a, to_a,
    from_b, to_b`` (its tokens' places). Nulls, empty texts and texts that either side changes have none.
    """
    kind = "array<struct<start:long,end:long,from_a:long,to_a:long,from_b:long,to_b:long>>"

    @F.arrow_udf(kind)
    def groups(texts: pa.Array) -> pa.Array:
        one = chunks(path_a, path_b).spans
        fields = [(name, pa.int64()) for name in ("start", "end", "from_a", "to_a", "from_b", "to_b")]
        return pa.array([one(t.as_py()) for t in texts], pa.list_(pa.struct(fields)))

    return df.withColumn(groups_col, groups(whole_text(text_col)))


def pair_counts(linked: DataFrame) -> DataFrame:
    """``a, b, count, best`` of a table with a row for each document and distinct linked pair ``a, b``.

    ``count`` is in how many documents the pair is linked; ``best`` whether no pair of the same ``a`` has more.
    """
    counts = stored(linked.groupBy("a", "b").agg(F.count(F.lit(1)).alias("count")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def frequent_from(counts: DataFrame, at_most: int) -> int:
    """The lowest power of two such that at most ``at_most`` pairs have that count or more."""
    power = F.length(F.bin("count")) - 1
    levels = sorted(counts.groupBy(power.alias("power")).count().collect(), reverse=True)  # 64 rows at most
    lowest, held = 64, 0
    for level in levels:
        held += level["count"]
        if held > at_most:
            break
        lowest = level["power"]
    return 1 << min(lowest, 62)


def with_alignment(df: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """Every column of ``df`` but the text, and the alignment of each text's two tokenizations.

    Side A is the byte-level vocabulary in JSON at ``path_a``, given a space and the text; side B the
    piece model at ``path_b``, which adds the space itself. Both files must be readable on every executor.
    Special strings are plain text. Added (and replaced, if they exist):

    ``n_a, n_b``: tokens. ``n_groups``: groups between common ends. ``n_links``: pairs of tokens whose
    bytes overlap. ``count_sum``: the sum, over links, of the number of rows in which the same two ids
    are linked. ``n_best``: links whose ids have the highest such number of their A id, ties included.
    ``groups_sha256``: digest of ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and texts that either side would change, have zeros and an empty digest. Rows
    are neither merged nor dropped: repeated rows count as rows of their own. Long texts are aligned in
    portions that end at a common byte; an empty table gives an empty one.

    One pass over the texts writes each row's distinct pairs below the checkpoint folder. Counts of the
    most frequent pairs (``BROADCAST_PAIRS`` at most) are broadcast; the others, which are rare, are shuffled.
    """
    added = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    rest = df.drop(*added).drop(text_col)
    row, made, pairs, n_best, count_sum, n_links = fresh(rest, "row", "made", "pairs", "n_best", "count_sum", "n_links")
    rows = df.withColumn(made, summary(whole_text(text_col), path_a, path_b)).select(
        *rest.columns, F.col(made), F.monotonically_increasing_id().alias(row)
    )
    summed = stored(rows, "alignment")
    linked = summed.select(F.col(row).alias("row"), F.inline(F.col(made)["pairs"]))
    counts = stored(pair_counts(linked), "pairs")
    least = frequent_from(counts, BROADCAST_PAIRS)
    frequent, rare = counts.filter(F.col("count") >= least), counts.filter(F.col("count") < least)
    met = linked.join(F.broadcast(frequent), ["a", "b"])
    if not rare.isEmpty():
        others = linked.join(F.broadcast(frequent.select("a", "b")), ["a", "b"], "left_anti")
        met = met.unionByName(others.join(rare, ["a", "b"]))
    sums = met.groupBy(F.col("row").alias(row)).agg(
        F.sum("links").alias(n_links),
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias(n_best),
        F.sum(F.col("links") * F.col("count")).alias(count_sum),
    )
    none = F.lit(0).cast("long")
    return summed.join(sums, row, "left").select(
        *rest.columns,
        *[F.col(made)[c].alias(c) for c in ("n_a", "n_b", "n_groups")],
        F.coalesce(n_links, none).alias("n_links"),
        F.coalesce(n_best, none).alias("n_best"),
        F.coalesce(count_sum, none).alias("count_sum"),
        F.col(made)["groups_sha256"].alias("groups_sha256"),
    )
