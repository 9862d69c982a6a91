"""Document fingerprints by consistent weighted sampling.

A document is a set of weighted terms: its words, each weighing the letters it stands for (count times
length). For each of ``SAMPLES`` independent draws, every term gets gamma variates that depend on the
term and the draw only, and the term with the smallest resulting value is the sample, together with the
step of its weight that was drawn. Two documents draw the same sample with a probability that equals
their generalised Jaccard similarity: the sum of the smaller weights over the sum of the larger ones.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.llm.tables import shuffle_partitions, stored, whole_text

SAMPLES = 64
# Terms of a document handled at a time, and weighted terms that a Python worker remembers.
STRIDE = 4_096
REMEMBERED = 80_000
GOLD, M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def draws(terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For hashed terms and their weights: the value (logarithm) and the sample's code, for each draw."""
    stream = np.arange(1, 5 * SAMPLES + 1, dtype=np.uint64) * GOLD
    u = (mixed(terms[:, None] + stream) >> np.uint64(11)).astype(np.float64)
    u = ((u + 0.5) * 2.0**-53).reshape(len(terms), 5, SAMPLES)
    r = -np.log(u[:, 0] * u[:, 1])  # gamma(2, 1)
    c = -np.log(u[:, 2] * u[:, 3])
    beta = u[:, 4]
    step = np.floor(np.log(weights)[:, None] / r + beta)
    value = np.log(c) - r * (step - beta) - r
    code = mixed(terms[:, None] * M2 + step.astype(np.int64).view(np.uint64))
    return value.astype(np.float32), (code >> np.uint64(48)).astype(np.uint16)


class Sampler:
    """Fingerprints texts; remembers the draws of weighted terms it has met."""

    def __init__(self) -> None:
        self.row: dict[tuple[str, int], int] = {}
        self.value = np.empty((REMEMBERED, SAMPLES), np.float32)
        self.code = np.empty((REMEMBERED, SAMPLES), np.uint16)

    def rows(self, terms: list[tuple[str, int]]) -> np.ndarray:
        if len(self.row) + len(terms) > REMEMBERED:
            self.row.clear()
        missing = [t for t in terms if t not in self.row]
        if missing:
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w, _ in missing], np.uint64)
            at = len(self.row)
            weights = np.array([n * len(w) for w, n in missing], np.float64)
            self.value[at : at + len(missing)], self.code[at : at + len(missing)] = draws(hashes, weights)
            self.row.update(zip(missing, range(at, at + len(missing))))
        return np.fromiter(map(self.row.__getitem__, terms), np.int64, len(terms))

    def fingerprint(self, text: str) -> np.ndarray:
        """The codes of the samples; zeros for a text without words."""
        terms = list(Counter(text.lower().split()).items())
        best, codes = np.full(SAMPLES, np.inf, np.float32), np.zeros(SAMPLES, np.uint16)
        draw = np.arange(SAMPLES)
        for at in range(0, len(terms), STRIDE):
            rows = self.rows(terms[at : at + STRIDE])
            value = self.value[rows]
            lowest = value.argmin(axis=0)
            found = value[lowest, draw]
            better = found < best
            best = np.where(better, found, best)
            codes = np.where(better, self.code[rows[lowest], draw], codes)
        return codes


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def as_hex(codes: np.ndarray) -> str:
    return codes.astype(">u2").tobytes().hex()


def edited(text: str, after: str) -> str:
    """The last half of the text replaced by the first as many characters of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


PRINT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def compared(sampler: Sampler, doc_id: int | None, text: str, own: np.ndarray, after: str, following: np.ndarray) -> tuple:
    changed = edited(text, after)
    other = sampler.fingerprint(changed)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return doc_id, len(text), digest, as_hex(own), as_hex(other), likeness(own, other), likeness(own, following)


def with_neighbours(docs: DataFrame) -> DataFrame:
    """Compares each row of range-partitioned, sorted ``docs(doc_id, text)`` with the next one.

    The last row of each partition is given out with its text (``ends = 2``), and so is the first
    (``ends = 1``), since they are neighbours across partitions.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, part = Sampler(), TaskContext.get().partitionId()
        last = None
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sampler.fingerprint(text)
                if last is None:
                    out.append((part, 1, text, doc_id, *[None] * 6))
                else:
                    out.append((part, 0, None, *compared(sampler, *last, text, own)))
                last = (doc_id, text, own)
            if out:
                yield as_batch(out)
        if last is not None:
            yield as_batch([(part, 2, last[1], last[0], *[None] * 6)])

    return docs.mapInArrow(walk, f"part int, ends int, text string, {PRINT}")


def as_batch(rows: list[tuple], names: tuple = ("part", "ends", "text"), types: tuple = (pa.int32(), pa.int32(), pa.string())) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), [*types, *TYPES])], [*names, *NAMES])


def compare_ends(pairs: DataFrame) -> DataFrame:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            rows = [
                compared(sampler, doc_id, text, sampler.fingerprint(text), after, sampler.fingerprint(after))
                for doc_id, text, after in zip(*(c.to_pylist() for c in batch.columns))
            ]
            if rows:
                yield as_batch(rows, (), ())

    return pairs.mapInArrow(walk, PRINT)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df`` with its fingerprint, that of its edited text, and their likeness.

    Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    Words are lower-cased and cut at white space. The edited text has its last half replaced by the
    first as many characters of the next document in descending order of ids (null ids last; rows that
    repeat an id in descending order of their texts); the first document follows the last. A single row
    is its own neighbour, and an empty table gives an empty result. Null is an empty text; texts without
    words share one fingerprint, of zeros. Other columns are ignored.

    One range shuffle brings neighbours together; partitions are read as streams. Only the first and
    last row of each partition take a second step, whose size follows the number of partitions.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    order = (F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    ranged = docs.repartitionByRange(shuffle_partitions(df.sparkSession), F.col("doc_id").desc_nulls_last())
    walked = stored(with_neighbours(ranged.sortWithinPartitions(*order)), "fingerprints")
    heads = walked.filter("ends = 1").select(F.col("part").alias("next_part"), F.col("text").alias("after"))
    # One number for each partition, not for each document: a window over them all is small.
    everywhere = Window.orderBy("next_part")
    first = F.min("next_part").over(Window.partitionBy())
    ring = heads.select(F.col("next_part").alias("part"), F.coalesce(F.lead("next_part").over(everywhere), first).alias("next_part"))
    tails = walked.filter("ends = 2").select("part", "doc_id", "text")
    pairs = tails.join(ring, "part").join(heads, "next_part").select("doc_id", "text", "after")
    return walked.filter("ends = 0").select(*NAMES).unionByName(compare_ends(pairs))
