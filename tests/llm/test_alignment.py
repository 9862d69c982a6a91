"""Alignment of two tokenizations against the public libraries and all pairs of tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from corpusflow.llm import alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = "ab cdéñß  \n\n\t 　▁ﬁ①Ǻé​中文😀<0x41>.,'s1 2३ﷺ \r\x00²"


@pytest.fixture(scope="module")
def brute():
    """Tokens, groups and links of a text, from whole-text encodings and all pairs of tokens."""
    side_a, side_b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    side_a.encode_special_tokens = True
    letters = alignment.byte_letters()

    def spans(sizes):
        ends = [sum(sizes[: k + 1]) for k in range(len(sizes))]
        return list(zip([0, *ends], ends))

    def of(text):
        if not text:
            return None
        data = (" " + text).encode()
        a, b = side_a.encode(" " + text, add_special_tokens=False).ids, side_b.encode(text)
        bytes_a = [bytes(letters[c] for c in side_a.id_to_token(i)) for i in a]
        bytes_b = [alignment.Chunks.piece_bytes(side_b.id_to_piece(i)) for i in b]
        if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            return None
        at_a, at_b = spans(list(map(len, bytes_a))), spans(list(map(len, bytes_b)))
        ends = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups = []
        for start, end in zip([0, *ends], ends):
            sides = ([str(i) for i, (f, t) in zip(ids, at) if start <= f and t <= end] for ids, at in ((a, at_a), (b, at_b)))
            groups.append("|".join(map(",".join, sides)))
        links = [(x, y) for x, (f, t) in zip(a, at_a) for y, (g, u) in zip(b, at_b) if max(f, g) < min(t, u)]
        return len(a), len(b), groups, links, ends

    return of


def expected(rows, of):
    found = [(i, of(t)) for i, t in rows]
    counts = Counter(pair for _, one in found if one for pair in set(one[3]))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for i, one in found:
        if one is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links, _ = one
        best = sum(counts[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((i, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return sorted(out, key=str)


def texts(n, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice(ODD) for _ in range(rng.randrange(1, 9))) for _ in range(30)]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 12)))) for i in range(n)]


@pytest.mark.parametrize("broadcast", [0, 20, 10**6])
def test_alignment_equals_all_pairs(spark, monkeypatch, brute, broadcast):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", broadcast)
    rows = [*texts(60), (None, None), (None, "one two"), (None, "one two"), (60, ""), (61, " "), (62, "▁"), (62, "<|endoftext|> a"), (62, "<|endoftext|> a")]
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, n_a string, row long").repartition(3)
    got = alignment.with_alignment(df, A, B)
    assert got.columns == ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.drop("row").collect()), key=str) == expected(rows, brute)


def test_groups_are_spans_of_bytes(spark, brute):
    rows = [(i, t) for i, t in texts(20, 6) if t]
    df = alignment.with_groups(spark.createDataFrame(rows, "doc_id long, text string"), A, B)
    for row in df.collect():
        one = brute(row.text)
        assert [g.end for g in row.groups] == (one[4] if one else [])
        if one:
            assert (row.groups[-1].to_a, row.groups[-1].to_b) == one[:2]
            assert all(p.end == q.start and p.to_a == q.from_a and p.to_b == q.from_b for p, q in zip(row.groups, row.groups[1:]))


def test_long_text_and_forgetting(spark, monkeypatch, brute):
    monkeypatch.setattr(alignment, "PORTION", 50)
    monkeypatch.setattr(alignment, "REMEMBERED", 40)
    one = alignment.Chunks(A, B)
    long = " ".join(t for _, t in texts(120, 8) if "▁" not in t)
    n_a, n_b, groups, links, _ = brute(long)
    for _ in range(2):
        got = one.summary(long)
        assert got[:4] == (n_a, n_b, len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest())
        assert int(got[5].sum()) == len(links)


def test_align_skips_long_stretches():
    rng = random.Random(9)
    for _ in range(300):
        total = rng.randrange(1, 200)
        x, y = (sorted({*rng.sample(range(1, total + 1), rng.randrange(0, total)), total}) for _ in "ab")
        if rng.random() < 0.5:
            y = sorted({*x, *y[:2], total})
        runs, left, right = alignment.align(x, y)
        starts = lambda ends: [0, *ends[:-1]]
        pairs = [(i, j) for i, (f, t) in enumerate(zip(starts(x), x)) for j, (g, u) in enumerate(zip(starts(y), y)) if max(f, g) < min(t, u)]
        assert sorted(zip(left, right)) == pairs
        ends = [e for i, to_i, _, _, one in runs for e in ([x[to_i - 1]] if one else x[i:to_i])]
        assert ends == sorted(set(x) & set(y))


def test_empty_table(spark):
    assert alignment.with_alignment(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
