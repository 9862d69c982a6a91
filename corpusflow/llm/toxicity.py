"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is a logistic function of hashed features of its words: the word itself and its
inner strings of four letters. A document is toxic if one of its sentences is (noisy-or), and only
document labels are needed to train. The same sentence scores then tell where the offence is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions.memory import give_back, other_work, tidy
from corpusflow.functions.portions import row_portions, text_portions
from corpusflow.llm.tables import fresh, stored, whole_text

BUCKETS = 1 << 17
GRAM = 4
# Words whose scores a Python worker remembers; more only saves time.
REMEMBERED = 300_000
# A run of letters, or the end of a sentence.
PARTS = re.compile(r"[^\W\d_]+|[.!?\n]")
ENDS = frozenset(".!?\n")
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Training:
    """How the model is fitted. At most ``sample`` labelled documents of either label are used, those
    with the lowest hashes of their ids; classes are weighted back to their shares among all labels."""

    sample: int = 3_000
    rounds: int = 120
    rate: float = 0.25
    decay: float = 1e-4
    threshold: float = 0.3


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of words, and where each word's features begin."""
    padded = [f"^{w}$" for w in words]
    sizes = np.array([len(w) for w in padded])
    code = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # Strings of GRAM letters from each position on; those that cross into the next word are left out.
    h = np.zeros(len(code), np.uint64)
    for i in range(GRAM):
        h = (h + np.roll(code, -i)) * M1
        h ^= h >> np.uint64(29)
    inside = np.arange(len(code)) + GRAM <= np.repeat(ends, sizes)
    # The whole word: a sum of mixed letters and places.
    place = (np.arange(len(code)) - np.repeat(starts, sizes) + 1).astype(np.uint64)
    mixed = (code * M2 + place) * M1
    whole = np.add.reduceat((mixed ^ (mixed >> np.uint64(31))) * M2, starts)
    counts = np.add.reduceat(inside.astype(np.int64), starts) + 1
    begin = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int64)
    out[begin] = (whole * M1 >> np.uint64(47)).astype(np.int64)
    rest = np.ones(len(out), bool)
    rest[begin] = False
    out[rest] = (h[inside] * M2 >> np.uint64(47)).astype(np.int64)
    return out, begin


class WordScores(dict):
    """Scores of the words met so far: the sums of their features' weights. Ends of sentences are NaN."""

    def __init__(self, weights: np.ndarray):
        super().__init__(dict.fromkeys(ENDS, float("nan")))
        self.weights = weights

    def learn(self, words: set[str]) -> None:
        missing = [w for w in words if w not in self]
        if not missing:
            return
        if len(self) >= REMEMBERED:
            self.clear()
            self.update(dict.fromkeys(ENDS, float("nan")))
            missing = [w for w in words if w not in ENDS]
        features, begin = word_features(missing)
        self.update(zip(missing, np.add.reduceat(self.weights[features], begin).tolist()))


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def sentence_scores(values: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """Logits of the sentences in a sequence of word scores with NaN at the ends, and their first places."""
    values = values.copy()
    values[1:][values[1:] == values[:-1]] = 0.0  # a word repeated in a row counts once
    ends = np.isnan(values)
    sentence = np.cumsum(ends) - ends
    words = ~ends
    n = int(sentence[-1]) + 1 if len(values) else 0
    sums = np.bincount(sentence[words], values[words], n)
    sizes = np.bincount(sentence[words], minlength=n)
    return sums[sizes > 0] + bias, np.flatnonzero(sizes > 0)


def fit(bags: list[np.ndarray], words: list[str], labels: np.ndarray, weight: np.ndarray, t: Training) -> tuple[np.ndarray, float]:
    """Weights and bias from documents given as word numbers, with -1 at the ends of sentences.

    With p the sentences' probabilities, a document is clean with probability prod(1 - p), whose
    logarithm is the negative sum of softplus(logit); the gradient follows from that. Adam steps over
    the whole sample.
    """
    features, begin = word_features(words)
    counts = np.diff(np.append(begin, len(features)))
    flat = np.concatenate(bags)
    doc_of = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    ends = flat < 0
    starts_doc = np.concatenate([[True], doc_of[1:] != doc_of[:-1]])
    sentence = np.cumsum(np.concatenate([[False], ends[:-1]]) | starts_doc) - 1
    keep = ~ends
    flat, sentence, doc_of = flat[keep], sentence[keep], doc_of[keep]
    used, sentence = np.unique(sentence, return_inverse=True)
    n_sentences = len(used)
    doc = np.zeros(n_sentences, np.int64)
    doc[sentence] = doc_of
    first = np.flatnonzero(np.concatenate([[True], sentence[1:] != sentence[:-1]]))
    weights, bias = np.zeros(BUCKETS), -5.0
    m, v, mb, vb = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0
    for step in range(1, t.rounds + 1):
        word = np.add.reduceat(weights[features], begin)
        z = np.clip(np.add.reduceat(word[flat], first) + bias, -40, 40)
        p = 1 / (1 + np.exp(-z))
        total = np.bincount(doc, softplus(z), len(bags))
        # Large where a toxic document is taken for clean, and then offset by the smallness of p.
        pull = np.where(labels > 0, -1 / np.expm1(np.clip(total, 1e-20, 500)), 1.0) * weight
        g = pull[doc] * p / len(bags)
        by_word = np.bincount(flat, np.repeat(g, np.diff(np.append(first, len(flat)))), len(words))
        grad = np.bincount(features, np.repeat(by_word, counts), BUCKETS) + t.decay * weights
        grad_b = g.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        mb, vb = 0.9 * mb + 0.1 * grad_b, 0.99 * vb + 0.01 * grad_b**2
        scale = t.rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weights -= scale * m / (np.sqrt(v) + 1e-8)
        bias -= scale * mb / (np.sqrt(vb) + 1e-8)
    return weights, float(bias)


def fit_rows(batches: Iterator[pa.RecordBatch], t: Training) -> tuple[np.ndarray, float]:
    """Fit from batches of ``text, label, weight``."""
    numbers: dict[str, int] = {}
    bags, labels, weight = [], [], []
    for batch in (rows for b in batches for rows in row_portions(b, 0)):
        for text, label, w in zip(*(c.to_pylist() for c in batch.columns)):
            parts = PARTS.findall(text.lower())
            bag = np.array([-1 if p in ENDS else numbers.setdefault(p, len(numbers)) for p in parts], np.int64)
            bag = bag[np.concatenate([[True], (bag[1:] != bag[:-1]) | (bag[1:] < 0)])] if len(bag) else bag
            if (bag >= 0).any():
                bags.append(bag)
                labels.append(label)
                weight.append(w)
    if not bags or min(labels) == max(labels):
        return np.zeros(BUCKETS), -5.0
    return fit(bags, list(numbers), np.array(labels), np.array(weight), t)


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def no_model() -> tuple[bytes, float]:
    """Weights and bias by which every document scores near 0."""
    return np.zeros(BUCKETS, np.float32).tobytes(), -20.0


def train(docs: DataFrame, labels: DataFrame, t: Training = Training(), id_col: str = "doc_id", text_col: str = "text") -> tuple[bytes, float]:
    """Packed weights (32-bit) and bias, learnt from ``labels(doc_id, toxic)`` that are not held out.

    Rows with a null label are left out, and a document labelled twice is toxic if one label says so.
    With labels of one kind only, or none, or none of documents in ``docs`` (which may be empty), all documents
    score near 0. The sample is bounded by ``t`` and fitted in one task; the result, of fixed size, is stored
    before it is used.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect() if r["label"] in (0, 1)}
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = [
        known.filter(F.col("label") == k).orderBy(*order).limit(t.sample).withColumn("weight", F.lit(max(1.0, n / t.sample)))
        for k, n in sizes.items()
    ]
    if len(chosen) < 2:
        return no_model()
    sample = stored(chosen[0].unionByName(chosen[1]), "toxicity-sample")  # at most 2 * t.sample rows
    texts = docs.select(docs[id_col].alias("doc_id"), whole_text(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = texts.repartition(1).sortWithinPartitions("doc_id", "text").select("text", "label", "weight")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = fit_rows(batches, t)
        yield pa.record_batch([pa.array([weights.astype(np.float32).tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"])

    model = stored(rows.mapInArrow(tidy(learn), "weights binary, bias double"), "toxicity-model").first()
    # Without a labelled document in the table there is no task to fit anything.
    return (bytes(model["weights"]), model["bias"]) if model else no_model()


def scored(text: Column, model: tuple[bytes, float], threshold: float) -> Column:
    """Struct of ``score`` and of ``sentences``: the offending ones, as character spans with scores."""
    packed, bias = model
    cell: list[WordScores] = []

    @F.arrow_udf("struct<score:double,sentences:array<struct<start:int,end:int,score:double>>>")
    def score(texts: pa.Array) -> pa.Array:
        if not cell:
            other_work()
            cell.append(WordScores(np.frombuffer(packed, np.float32).astype(np.float64)))
        words = cell[0]
        scores, spans = [], []
        for text in (t for part in text_portions(texts) for t in part.to_pylist()):
            lowered = (text or "").lower()
            parts = PARTS.findall(lowered)
            words.learn(set(parts))
            values = np.fromiter(map(words.__getitem__, parts), np.float64, len(parts))
            z, numbers = sentence_scores(values, bias)
            s = softplus(z)
            scores.append(float(-np.expm1(-s.sum())))
            bad = np.flatnonzero(-np.expm1(-s) >= threshold)
            if len(bad):
                # Lower-casing may change lengths, so places are those of the text as it is.
                cuts = [0, *(m.end() for m in re.finditer(r"[.!?\n]", text)), len(text)]
                spans.append([{"start": cuts[numbers[i]], "end": cuts[numbers[i] + 1], "score": float(-np.expm1(-s[i]))} for i in bad])
            else:
                spans.append([])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        give_back()
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(spans, kind)], ["score", "sentences"])

    return score(text)


def with_toxicity(df: DataFrame, model: tuple[bytes, float], text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``df`` with ``score`` (0 to 1), ``sentences`` (spans that reach ``threshold`` by themselves) and
    ``predicted`` (1 if ``score`` does). Columns of these names are replaced.

    The score depends on the text alone. Null and empty texts, and texts without a letter, have no
    sentence and score 0. Rows are scored one by one, without a shuffle; repeated rows score alike. An empty
    table stays empty.
    """
    (both,) = fresh(df, "toxicity")
    out = df.withColumn(both, scored(whole_text(text_col), model, threshold))
    out = out.withColumns({"score": F.col(both)["score"], "sentences": F.col(both)["sentences"]}).drop(both)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(df: DataFrame, model: tuple[bytes, float], text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``df`` without the rows that score ``threshold`` or more; all columns stay as they are."""
    return df.filter(scored(whole_text(text_col), model, threshold)["score"] < threshold)
