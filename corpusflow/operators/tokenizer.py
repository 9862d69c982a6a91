"""Byte-level BPE: word counts, merge training, encoding and decoding as Spark jobs.

Training keeps one row per distinct word. A word is a string of symbols, one private-use character
per token id, so counting pairs and applying merges are plain string functions of Spark.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from corpusflow.functions.portions import portions
from corpusflow.operators.schema_ops import view_of
from corpusflow.session import cut_lineage

# Special tokens, in id order. The first group is skipped when decoding for display.
SPECIAL = (
    "<|endoftext|>", "<|im_start|>", "<|im_end|>",
    "<|object_ref_start|>", "<|object_ref_end|>", "<|box_start|>", "<|box_end|>",
    "<|quad_start|>", "<|quad_end|>",
    "<|vision_start|>", "<|vision_end|>", "<|vision_pad|>", "<|image_pad|>", "<|video_pad|>",
    "<|audio_start|>", "<|audio_end|>", "<|audio_pad|>",
    "<tts_pad>", "<tts_text_bos>", "<tts_text_eod>", "<tts_text_bos_single>",
)
ADDITIONAL = ("<tool_call>", "</tool_call>", "<tool_response>", "</tool_response>", "<think>", "</think>")
N_SPECIAL = 36
BUFFERS = tuple(f"<|buffer{i}|>" for i in range(1, N_SPECIAL - len(SPECIAL) - len(ADDITIONAL) + 1))
ALL_SPECIAL = SPECIAL + ADDITIONAL + BUFFERS
PAD, BOS, EOS = 0, 1, 2
VOCAB_SIZE = 6400

# Fixed value: byte-level word pattern (contractions, letters, digits, marks, white space).
_S = r"\p{Z}\t-\r\x{85}"
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^\p{{L}}\p{{N}}{_S}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
_SPECIALS = "|".join(re.escape(t) for t in ALL_SPECIAL)
_CUTS = rf"(?<=>)(?<={_SPECIALS})|(?=<)(?={_SPECIALS})"


def _byte_ids() -> list[int]:
    """Token id of every byte: bytes that print as themselves first, then the others, both in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    order = shown + [b for b in range(256) if b not in set(shown)]
    ids = [0] * 256
    for place, byte in enumerate(order):
        ids[byte] = N_SPECIAL + place
    return ids


BYTE_IDS = _byte_ids()
_SYMBOLS = 0xF0000  # first private-use character; symbol order is id order


@dataclass
class BpeModel:
    """Merges in training order: ``(left id, right id, merged id)``, and the bytes of every id."""

    merges: list[tuple[int, int, int]] = field(default_factory=list)
    tokens: list[bytes] = field(default_factory=list)

    def __post_init__(self):
        if not self.tokens:
            of_id = {i: bytes([b]) for b, i in enumerate(BYTE_IDS)}
            self.tokens = [t.encode() for t in ALL_SPECIAL] + [of_id[N_SPECIAL + i] for i in range(256)]

    def ranks(self) -> dict[tuple[int, int], tuple[int, int]]:
        return {(a, b): (rank, c) for rank, (a, b, c) in enumerate(self.merges)}

    def ids_of(self, pieces: list[str]) -> list[int]:
        """Ids of a few pieces on the driver, such as the span markers."""
        special, ranks = {t: i for i, t in enumerate(ALL_SPECIAL)}, self.ranks()
        return [i for p in pieces for i in ([special[p]] if p in special else _merge(p, ranks))]

    def merges_table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (rank, a, b, c, self.tokens[a].hex(), self.tokens[b].hex(), self.tokens[c].hex())
            for rank, (a, b, c) in enumerate(self.merges)
        ]
        schema = "rank int, left_id int, right_id int, merged_id int, left_hex string, right_hex string, merged_hex string"
        return spark.createDataFrame(rows, schema)


def special_tokens(spark: SparkSession) -> DataFrame:
    rows = [(i, t, t in SPECIAL) for i, t in enumerate(ALL_SPECIAL)]
    return spark.createDataFrame(rows, "token_id int, token string, special boolean")


def pieces(text: Column) -> Column:
    """Words of plain text."""
    return F.regexp_extract_all(text, F.lit(f"({WORD_PATTERN})"), F.lit(1))


def pieces_with_specials(text: Column) -> Column:
    """Words of text that may contain special tokens, which stay whole and bound the words around."""
    segments = F.filter(F.split(text, _CUTS), lambda s: s != "")
    cut = F.flatten(
        F.transform(
            segments, lambda s: F.when(s.isin(*ALL_SPECIAL), F.array(s)).otherwise(pieces(s))
        )
    )
    return F.when(F.contains(text, F.lit("<")), cut).otherwise(pieces(text))


def word_counts(df: DataFrame, text_key: str = "text") -> DataFrame:
    """Occurrences of every distinct word; the one step of training that reads the corpus."""
    words = df.select(F.explode(pieces(view_of(df, text_key))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _symbol(token_id: int) -> str:
    return chr(_SYMBOLS + token_id)


def _choose(ranked: list[tuple[str, int]], complete: bool, known: dict[bytes, int], tokens: list[bytes], room: int):
    """Leading pairs whose merges cannot influence each other's turn.

    ``ranked`` lists pairs by falling count, ties by rising ids. A merge can only create pairs that
    are at most as frequent as a pair touching its symbols. So the chosen pairs that are more
    frequent than the first one touching a chosen symbol are exactly the next merges of
    one-at-a-time training. Pairs of twice the same symbol, and merges that spell a token already
    there, are taken alone.
    """
    chosen: list[tuple[int, int, int, bytes]] = []
    used: set[int] = set()
    spelled: set[bytes] = set()
    bar = 0 if complete else ranked[-1][1]
    full = False
    for pair, n in ranked:
        a, b = (ord(c) - _SYMBOLS for c in pair)
        if used & {a, b}:
            bar = n
            break
        joined = tokens[a] + tokens[b]
        alone = a == b or joined in known or joined in spelled
        full = full or len(chosen) == room or bool(alone and chosen)
        if full:
            continue
        chosen.append((a, b, n, joined))
        used |= {a, b}
        spelled.add(joined)
        full = alone
    return [c for i, c in enumerate(chosen) if i == 0 or c[2] > bar]


def _pairs(state: DataFrame) -> DataFrame:
    """``p, n``: the neighbouring symbols in the words of ``state(s, n)``, added up within each partition.

    A symbol is four bytes of UTF-8 and a pair eight, so pairs are counted as numbers, and a partition gives one row
    per distinct pair.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            octets = batch.column(0).cast(pa.large_binary())
            ends = np.frombuffer(octets.buffers()[1], np.int64)[octets.offset : octets.offset + len(octets) + 1]
            symbols = np.frombuffer(octets.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(">u4").astype(np.uint64)
            sizes = np.diff(ends) // 4
            inside = np.ones(len(symbols), bool)
            inside[np.cumsum(sizes) - 1] = False  # the last symbol of a word opens no pair
            opening = np.flatnonzero(inside)
            keys, which = np.unique(symbols[opening] << np.uint64(32) | symbols[opening + 1], return_inverse=True)
            weights = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), sizes)[opening]
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, which, weights)
            for key, n in zip(keys.tolist(), sums.tolist()):
                found[key] = found.get(key, 0) + n
        pairs = [key.to_bytes(8, "big").decode() for key in found]
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.string()), pa.array(list(found.values()), pa.int64())], ["p", "n"])

    return state.select("s", "n").mapInArrow(counted, "p string, n long")


def train_bpe(
    counts: DataFrame, vocab_size: int = VOCAB_SIZE, top: int = 256, batch: int = 64, checkpoint_every: int = 16
) -> BpeModel:
    """Learn merges from ``counts(word, n)``; equal to one-at-a-time training.

    Each round brings only the ``top`` most frequent pairs to the driver and applies the merges that
    are certain to come next. Words that have become one symbol leave the table.
    """
    model = BpeModel()
    known = {t: i for i, t in enumerate(model.tokens)}
    symbols = F.array(*[F.lit(_symbol(i)) for i in BYTE_IDS])
    octets = F.hex(F.encode("word", "UTF-8"))
    state = counts.select(
        F.array_join(
            F.transform(
                F.sequence(F.lit(0), (F.length(octets) / 2).cast("int") - 1),
                lambda i: F.get(symbols, F.conv(F.substring(octets, (i * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")),
            ),
            "",
        ).alias("s"),
        "n",
    ).filter(F.length("s") > 1)
    state = cut_lineage(state)
    rounds, cached = 0, []
    while len(model.tokens) < vocab_size:
        ranked = [
            (r["p"], r["n"])
            for r in _pairs(state).groupBy("p").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "p").limit(top).collect()
        ]
        if not ranked:
            break
        room = min(batch, vocab_size - len(model.tokens))
        merged = F.col("s")
        for a, b, _, joined in _choose(ranked, len(ranked) < top, known, model.tokens, room):
            c = known.setdefault(joined, len(model.tokens))
            if c == len(model.tokens):
                model.tokens.append(joined)
            model.merges.append((a, b, c))
            merged = F.replace(merged, F.lit(_symbol(a) + _symbol(b)), F.lit(_symbol(c)))
        following = state.select(merged.alias("s"), "n").filter(F.length("s") > 1)
        rounds += 1
        if rounds % checkpoint_every == 0:
            following = cut_lineage(following)
        else:
            following = following.persist()
            cached.append(following)
        state = following
        # The round before last has served its purpose; the last one still feeds the next.
        while len(cached) > 2:
            cached.pop(0).unpersist()
    for frame in cached:
        frame.unpersist()
    return model


def _merge(word: str, ranks: dict) -> list[int]:
    """Merge the adjacent pair of lowest rank, leftmost first, with a heap over linked positions."""
    ids = [BYTE_IDS[b] for b in word.encode()]
    size = len(ids)
    after, before = [*range(1, size + 1)], [*range(-1, size - 1)]
    heap = [(*ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
    heapq.heapify(heap)

    def offer(i: int, j: int) -> None:
        pair = (ids[i], ids[j])
        if pair in ranks:
            heapq.heappush(heap, (*ranks[pair], i, pair))

    while heap:
        _, made, i, pair = heapq.heappop(heap)
        j = after[i]
        if j >= size or (ids[i], ids[j]) != pair:
            continue  # one of the two has been merged meanwhile
        ids[i], ids[j] = made, -1
        after[i] = after[j]
        if after[i] < size:
            before[after[i]] = i
            offer(i, after[i])
        if before[i] >= 0:
            offer(before[i], i)
    return [i for i in ids if i >= 0]


def encode(text: Column, model: BpeModel) -> Column:
    """Token ids of each text, special tokens split out first.

    Words are cut in the JVM. Python merges each distinct word of a portion of a batch once and remembers
    frequent ones for the following batches, so nothing is shuffled.
    """
    return encode_pieces(pieces_with_specials(text), model)


def encode_pieces(words: Column, model: BpeModel) -> Column:
    ranks, special = model.ranks(), {t: i for i, t in enumerate(ALL_SPECIAL)}
    memo: dict[str, list[int]] = {}

    def of_portion(lists: pa.Array) -> pa.Array:
        coded = lists.flatten().dictionary_encode()
        distinct = []
        for word in coded.dictionary.to_pylist():
            ids = memo.get(word)
            if ids is None:
                ids = [special[word]] if word in special else _merge(word, ranks)
                if len(memo) < 200_000:
                    memo[word] = ids
            distinct.append(ids)
        per_word = pa.array(distinct, pa.list_(pa.int32())).take(coded.indices)
        lengths = pc.fill_null(pc.list_value_length(per_word), 0)
        upto = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(lengths.cast(pa.int64()))])
        sizes = pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int64())
        ends = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(sizes)])
        offsets = upto.take(ends).cast(pa.int32())
        return pa.ListArray.from_arrays(offsets, per_word.flatten(), mask=lists.is_null())

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def look_up(lists: pa.Array) -> pa.Array:
        return pa.concat_arrays([of_portion(part) for part in portions(lists)])

    return look_up(words)


def count_tokens(model: BpeModel):
    """Token counter for the length filter and the statistics."""
    return lambda text: F.size(encode(text, model))


def decode(ids: Column, model: BpeModel, skip_special: bool = False) -> Column:
    """Text of token ids; the vocabulary is a constant of the plan, bytes are joined before decoding."""
    skipped = set(SPECIAL) if skip_special else set()
    table = ",".join("" if t.decode("utf-8", "replace") in skipped else t.hex() for t in model.tokens)
    vocabulary = F.split(F.lit(table), ",")
    octets = F.array_join(F.transform(ids, lambda i: F.get(vocabulary, i)), "")
    return F.make_valid_utf8(F.unhex(octets).cast("string"))
