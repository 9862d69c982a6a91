"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

How the transducer works. A sequence of tokens is what the merges make of a text exactly if each two
adjacent tokens are what the merges make of their concatenation: the first merge across a border in the
whole text would also be the first one across it in the pair. So a nondeterministic machine can read
bytes along the vocabulary's trie, end a token at any node that is one if it may follow the token
before, and start anew at the root. After each prefix exactly one of its runs has just ended a token
(that is the prefix's own encoding); the others are inside one. A deterministic state is the set of
these runs, each known by its last token and its node; a transition gives the token that ends with its
byte. States and transitions are made when they are first needed. The token that ended at a place tells
where the one before it ended, so the encoding is read backwards from the end. Of a long piece, what all
runs of a state agree on is given out as it goes, which is behind by a bounded number of bytes.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions.fence import fence
from corpusflow.functions.memory import give_back, kept
from corpusflow.functions.portions import text_portions
from corpusflow.llm.pieces import cut
from corpusflow.llm.tables import fresh, whole_text

# What a Python worker holds at most before it starts anew; more only saves time.
MAX_STATES = 250_000
MAX_PAIRS = 200_000
MAX_PIECES = 150_000
# Bytes of a piece after which what is certain is given out.
PORTION = 4_096
# Token ids that the decoder takes at a time.
DECODE_CHUNK = 65_536
ROOT = 0
NEVER = 1 << 62

# The runs of a state: the last token and the node of each, the ones inside a token first. The token that
# the last run has just ended (-1: none) comes at the end; its node is the root.
Runs = tuple[int, ...]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


def merge_by_rank(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The defining procedure: merge the adjacent parts of lowest rank, leftmost first, while any can be.

    Quadratic, but only ever applied to two tokens side by side.
    """
    rank = ranks.get
    parts = [data[i : i + 1] for i in range(len(data))]
    pairs = [rank(data[i : i + 2], NEVER) for i in range(len(data) - 1)]
    while pairs and (lowest := min(pairs)) < NEVER:
        i = pairs.index(lowest)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
        if i < len(pairs):
            pairs[i] = rank(parts[i] + parts[i + 1], NEVER)
    return [ranks[p] for p in parts]


class Transducer:
    """Encodes one piece of text (a match of the pattern) at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: data for data, rank in ranks.items()}
        self.size = array("i", [len(self.token.get(i, b"")) for i in range(max(self.token) + 1)])
        self.children: dict[int, int] = {}  # node * 256 + byte -> node
        self.ended = array("i", [-1])  # for each node, the token that ends there
        self.depth = array("i", [0])
        self.inner = bytearray(1)  # for each node, whether longer tokens go on from it
        for data, rank in ranks.items():
            node = ROOT
            for byte in data:
                self.inner[node] = 1
                key = node << 8 | byte
                if key not in self.children:
                    self.children[key] = len(self.ended)
                    self.depth.append(self.depth[node] + 1)
                    self.ended.append(-1)
                    self.inner.append(0)
                node = self.children[key]
            self.ended[node] = rank
        self.follows: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        """Start anew, with the start state (number 0) only."""
        self.runs: list[Runs] = [(-1,)]
        self.numbers: dict[Runs, int] = {(-1,): 0}
        self.moves = Moves(self)

    def number(self, runs: Runs) -> int:
        """The state of some runs."""
        found = self.numbers.get(runs)
        if found is None:
            found = self.numbers[runs] = len(self.runs)
            self.runs.append(runs)
        return found

    def may_follow(self, last: int, token: int) -> bool:
        """Whether the merges leave ``last`` (-1: nothing) and ``token`` as they are, side by side."""
        if len(self.follows) >= MAX_PAIRS:
            self.follows.clear()
        before, after = self.token.get(last, b""), self.token[token]
        if last >= 0 and before + after in self.ranks:
            known = False  # the two would be merged
        else:
            known = merge_by_rank(before + after, self.ranks) == ([last, token] if last >= 0 else [token])
        self.follows[last << 32 | token] = known
        return known

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """A transition: the next state times 256, and the token that ends with the byte."""
        runs = self.runs[state]
        after: list[int] = []
        ended = -1
        child_of, token_at, inner, known = self.children.get, self.ended, self.inner, self.follows.get
        for at in range(0, len(runs), 2):
            last = runs[at]
            child = child_of((runs[at + 1] if at + 1 < len(runs) else ROOT) << 8 | byte)
            if child is None:
                continue
            if inner[child]:
                after += (last, child)
            token = token_at[child]
            if ended < 0 <= token:
                fits = known(last << 32 | token)
                if self.may_follow(last, token) if fits is None else fits:
                    ended = token
        if ended < 0:
            raise ValueError("the vocabulary lacks a byte")
        after.append(ended)
        return self.number(tuple(after)) << 8, ended

    def trace(self, ended: list[int], at: int) -> list[int]:
        """The tokens of the first ``at`` bytes, from the tokens that end after each byte."""
        out, size = [], self.size
        while at > 0:
            token = ended[at - 1]
            out.append(token)
            at -= size[token]
        out.reverse()
        return out

    def agreed(self, ended: list[int], state: int) -> int:
        """Up to where the encodings that are still possible are the same."""
        runs = self.runs[state]
        starts = {len(ended), *(len(ended) - self.depth[node] for node in runs[1::2])}
        while len(starts) > 1:
            last = max(starts)
            starts.remove(last)
            starts.add(last - self.size[ended[last - 1]])
        return starts.pop()

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        state, out, ended = 0, [], []  # the state's number times 256
        for begin in range(0, len(piece), PORTION):
            if len(self.runs) >= MAX_STATES:
                runs = self.runs[state >> 8]
                self.forget()
                state = self.number(runs) << 8
            if ended:
                certain = self.agreed(ended, state >> 8)
                out += self.trace(ended, certain)
                del ended[:certain]
            moves, append = self.moves, ended.append
            for byte in piece[begin : begin + PORTION]:
                state, token = moves[state | byte]
                append(token)
        return out + self.trace(ended, len(ended))


class Moves(dict):
    """Transitions by state * 256 + byte, made when they are first taken."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, key: int) -> tuple[int, int]:
        self[key] = move = self.transducer.step(key >> 8, key & 255)
        return move


class PieceIds(dict):
    """Packed ids of the pieces met so far; a missing one goes through the transducer."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MAX_PIECES:
            self.old = dict(self)
            self.clear()
        packed = self.old.get(piece)
        if packed is None:
            packed = array("i", self.transducer.encode(piece.encode())).tobytes()
        if len(piece) < 100:
            self[piece] = packed
        return packed


class Encoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.pieces = PieceIds(Transducer(ranks))

    def packed(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers, one after the other."""
        return b"".join(map(self.pieces.__getitem__, cut(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


class Utf8Stream:
    """Incremental UTF-8: takes bytes in any portions and gives out the characters completed so far.

    The state is the unfinished character at the end, at most three bytes. Bytes that cannot be part of
    a character become U+FFFD.
    """

    def __init__(self) -> None:
        self.open = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end may still become a character."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:
                size = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4 if byte < 0xF5 else 0
                return back if back < size else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.open + data
        cut = len(data) - self.unfinished(data)
        self.open = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


class TokenBytes:
    """The bytes of all tokens, one after the other, so that those of many ids are taken at once."""

    def __init__(self, ranks: dict[bytes, int]):
        token = {rank: data for data, rank in ranks.items()}
        sizes = np.array([len(token.get(i, b"")) for i in range(max(token) + 1)])
        self.known = np.array([i in token for i in range(max(token) + 1)])
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.sizes = sizes
        self.data = np.frombuffer(b"".join(token.get(i, b"") for i in range(max(token) + 1)), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id outside the vocabulary")
        sizes = self.sizes[ids]
        upto = np.cumsum(sizes)
        total = int(upto[-1]) if len(ids) else 0
        return self.data[np.repeat(self.begins[ids] - upto + sizes, sizes) + np.arange(total)].tobytes()


def decode_stream(portions: Iterable[np.ndarray], token: TokenBytes) -> Iterator[str]:
    """Text of a stream of token ids, in portions, each cut at a whole character."""
    stream = Utf8Stream()
    for ids in portions:
        yield stream.feed(token.join(ids))
    yield stream.finish()


@kept
def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker. Its tables are many small objects without
    cycles to collect, so the collector is told to look for some less often."""
    made = Encoder(read_ranks(path))
    gc.freeze()
    gc.set_threshold(100_000, 100, 100)
    return made


@kept
def vocabulary_bytes(path: str) -> TokenBytes:
    return TokenBytes(read_ranks(path))


def packed_ids(packed: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, packed)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def decoded(ids: np.ndarray, token: TokenBytes) -> str:
    return "".join(decode_stream((ids[i : i + DECODE_CHUNK] for i in range(0, len(ids), DECODE_CHUNK)), token))


def encode_text(text: Column, ranks_path: str) -> Column:
    """Token ids of a text column as an array of integers; null texts have none (an empty array)."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        pack = encoder(ranks_path).packed
        packed = [pack(t) if t else b"" for part in text_portions(texts) for t in part.to_pylist()]
        give_back()
        return packed_ids(packed)

    return encode(text)


def decode_ids(ids: Column, ranks_path: str) -> Column:
    """Text of an array of token ids; null for a null array. Ids outside the vocabulary are an error."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        token = vocabulary_bytes(ranks_path)
        return pa.array(
            [decoded(one.values.to_numpy(zero_copy_only=False), token) if one.is_valid else None for one in lists], pa.string()
        )

    return decode(ids)


def round_trip(text: Column, ranks_path: str) -> Column:
    """A struct of the ``ids`` of a text and of what they are ``decoded`` to, in one call to Python."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(texts: pa.Array) -> pa.Array:
        pack, token = encoder(ranks_path).packed, vocabulary_bytes(ranks_path)
        packed, back = [], [pa.array([], pa.string())]
        for part in text_portions(texts):
            some = [pack(t) if t else b"" for t in part.to_pylist()]
            packed += some
            back.append(pa.array([decoded(np.frombuffer(p, np.int32), token) for p in some], pa.string()))
        ids = packed_ids(packed)
        del packed
        give_back()
        return pa.StructArray.from_arrays([ids, pa.concat_arrays(back)], ["ids", "decoded"])

    return both(text)


def with_token_ids(df: DataFrame, ranks_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the token ids of each whole text in ``ids_col`` (replaced if it exists).

    ``ranks_path`` is a file of base64 tokens and ranks, readable on every executor. Null and empty texts
    have an empty array. There are no special tokens: their strings are ordinary text. Nothing is
    shuffled; rows keep their other columns, and repeated rows are encoded alike. The ids are made once,
    even if what follows hands them to Python again.
    """
    return fence(df, {ids_col: encode_text(whole_text(text_col), ranks_path)})


def with_decoded_text(df: DataFrame, ranks_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids_col`` in ``text_col`` (replaced if it exists).

    A null array has no text, an empty one the empty text; ids outside the vocabulary are an error. Long arrays
    are decoded in portions. Nothing is shuffled, and repeated rows are decoded alike.
    """
    return df.withColumn(text_col, decode_ids(F.col(ids_col), ranks_path))


def with_round_trip(df: DataFrame, ranks_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """:func:`with_token_ids` and :func:`with_decoded_text` in one call to Python: texts are encoded once, and the
    ids are decoded before they leave. Rows and other columns, nulls, empty and long texts are as there."""
    (both,) = fresh(df, "round_trip")
    made = fence(df, {both: round_trip(whole_text(text_col), ranks_path)}, list(df.columns))
    return made.withColumns({ids_col: F.col(both)["ids"], decoded_col: F.col(both)["decoded"]}).drop(both)
