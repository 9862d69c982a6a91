"""Token counts of a byte-level BPE vocabulary by merging with a heap over a linked list of symbols."""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.pieces import cut
from corpusflow.llm.tables import whole_text

# Pieces whose counts a Python worker remembers. More only saves time.
REMEMBERED = 400_000


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabulary files, by rule:
    printable Latin-1 characters stand for themselves, the rest for the characters from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class MergeTable:
    """Merges of adjacent symbols with their ranks. Symbols below 256 are bytes."""

    def __init__(self, vocabulary: dict):
        model, letters = vocabulary["model"], byte_letters()
        symbols = {c: b for c, b in letters.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if left in symbols and right in symbols:
                made = symbols.setdefault(left + right, 256 + rank)
                self.merges.setdefault((symbols[left], symbols[right]), (rank, made))
        self.specials = sorted((t["content"] for t in vocabulary.get("added_tokens", ())), key=len, reverse=True)

    def count(self, piece: bytes) -> int:
        """Initial symbols minus merges; a merge of n symbols takes O(n log n) steps."""
        symbols = list(piece)
        size = len(symbols)
        if size < 2:
            return size
        merges = self.merges
        heap = []
        for at in range(size - 1):
            found = merges.get((symbols[at], symbols[at + 1]))
            if found:
                heap.append((found[0], at, symbols[at], symbols[at + 1], found[1]))
        heapq.heapify(heap)
        after = [*range(1, size), -1]
        before = [*range(-1, size - 1)]
        merged = 0
        while heap:
            _, at, left, right, made = heapq.heappop(heap)
            other = after[at]
            if symbols[at] != left or other < 0 or symbols[other] != right:
                continue  # one of the two has been merged meanwhile
            merged += 1
            symbols[at], symbols[other] = made, -1
            beyond = after[at] = after[other]
            if beyond >= 0:
                before[beyond] = at
                if found := merges.get((made, symbols[beyond])):
                    heapq.heappush(heap, (found[0], at, made, symbols[beyond], found[1]))
            front = before[at]
            if front >= 0 and (found := merges.get((symbols[front], made))):
                heapq.heappush(heap, (found[0], front, symbols[front], made, found[1]))
        return size - merged


class PieceCounts(dict):
    """Counts of the pieces met so far; a missing one is merged."""

    def __init__(self, table: MergeTable):
        super().__init__()
        self.table = table

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self.table.count(piece.encode())
        if len(piece) < 100:
            self[piece] = n
        return n


class Counter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            table = MergeTable(json.load(f))
        self.counts = PieceCounts(table)
        self.special = re.compile("|".join(map(re.escape, table.specials))) if table.specials else None

    def ordinary(self, text: str) -> int:
        return sum(map(self.counts.__getitem__, cut(text)))

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.ordinary(text)
        parts = self.special.split(text)
        return sum(map(self.ordinary, parts)) + len(parts) - 1


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter for each vocabulary and Python worker."""
    return Counter(path)


def token_count(text: Column, vocabulary: str) -> Column:
    """Tokens of a text column as a long."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        one = counter(vocabulary).count
        return pd.Series([one(t) for t in texts], dtype="int64")

    return count(text)


def with_token_counts(df: DataFrame, vocabulary: str, text_col: str = "text", limit: int = 512) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``vocabulary`` is the path of a byte-level BPE vocabulary in JSON, readable on every executor.
    Special strings of the vocabulary count as one token each and split the text. Null and empty texts
    have 0 bytes and 0 tokens. Columns of ``df`` with these three names are replaced; rows are neither
    merged nor dropped, so repeated rows each get their count.

    Each piece of a text is merged with a heap over a linked list, and only its number of symbols minus
    merges is kept; a worker remembers the counts of the pieces that it has met. Nothing is shuffled.
    """
    text = whole_text(text_col)
    out = df.withColumns({"n_tokens": token_count(text, vocabulary), "n_bytes": F.octet_length(text).cast("long")})
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
