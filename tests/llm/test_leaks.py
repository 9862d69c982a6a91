"""Benchmark decontamination against brute force."""

import random
import re

import pytest

from corpusflow.llm import leaks

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, n_words string, version long, doc string, key string"


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, window):
    runs = []
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        runs += [(item, w[i : i + n]) for i in range(len(w) - n + 1) if n]
    out = []
    for doc, text in docs:
        w = words(text)
        hits = {(i, i + len(r), item) for item, r in runs for i in range(len(w) - len(r) + 1) if w[i : i + len(r)] == r}
        hit = {j for i, k, _ in hits for j in range(i, k)}
        ids = sorted({str(item) for _, _, item in hits if item is not None})
        out.append((doc, len(w), len(hit), sorted({(i, k) for i, k, _ in hits}), ids, bool(hits)))
    return sorted(out, key=str)


def frames(spark, docs, items):
    left = spark.createDataFrame([(i, t, "x", 3, "y", "z") for i, t in docs], DOCS).repartition(3)
    return left, spark.createDataFrame(items, "item_id long, text string").repartition(2)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, [tuple(h) for h in r.hits], r["items"], r.contaminated) for r in df.collect()), key=str)


def sample(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "É", "é", "a1", "x'y", "naïve", "ΑΒ", "z"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(rng.randrange(n)))
    items = [(i, text(9)) for i in range(12)] + [(3, "the of z"), (None, "a1 z a1"), (90, None), (91, ""), (92, "?!"), (93, "the")]
    docs = [(i, text(40)) for i in range(60)] + [(None, "the the of"), (None, None), (5, ""), (5, "a1 Z a1"), (5, "a1 Z a1"), (None, "the the of")]
    return docs, items


@pytest.mark.parametrize("window,shingle,rows", [(4, 2, 10**6), (4, 3, 0), (1, 1, 10**6), (3, 5, 10**6)])
def test_leaks_equal_brute_force(spark, monkeypatch, window, shingle, rows):
    monkeypatch.setattr(leaks, "BROADCAST_ROWS", rows)
    docs, items = sample(window)
    out = leaks.with_leaks(*frames(spark, docs, items), window=window, shingle=shingle)
    assert out.columns == ["doc_id", "version", "doc", "key", "n_words", "n_hit", "hits", "items", "contaminated"]
    assert got(out) == brute(docs, items, window)


def test_windows_across_long_text(spark):
    rng = random.Random(2)
    item = " ".join(rng.choice("abcdef") + str(rng.randrange(9)) for _ in range(30))
    long = " ".join(["w"] * 30_000 + item.split()[5:20] + ["w"] * 20_000)
    docs, items = [(1, long), (2, item.upper()), (3, " ".join(item.split()[:9]))], [(7, item)]
    assert got(leaks.with_leaks(*frames(spark, docs, items))) == brute(docs, items, 10)


def test_drop_leaked(spark):
    docs, items = sample(4)
    left, right = frames(spark, docs, items)
    kept = leaks.drop_leaked(left, right, window=4, shingle=2)
    assert kept.columns == left.columns
    clean = sorted([r[0] for r in brute(docs, items, 4) if not r[5]], key=str)
    assert sorted([r.doc_id for r in kept.collect()], key=str) == clean
    half = leaks.drop_leaked(left, right, most=0.5, window=4, shingle=2)
    assert half.count() == sum(r[2] <= 0.5 * r[1] for r in brute(docs, items, 4))


def test_empty_tables(spark):
    docs, items = sample(5)
    assert got(leaks.with_leaks(*frames(spark, docs, []))) == brute(docs, [], 10)
    assert got(leaks.with_leaks(*frames(spark, [], items))) == []
