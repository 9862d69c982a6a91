"""Duplicate operators against brute force, and on odd tables."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusflow.llm import exact_dups, near_dups, repeats, weighted_prints
from corpusflow.llm.graph import components

SCHEMA = "doc_id long, text string, kept string, text_sha256 string, node long, digest long"
LONG = "word " * 40_000
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "one"), (6, "ONE"), (None, "one"), (None, None), (7, LONG), (8, LONG + "end"), (9, "ñandú über")]


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], SCHEMA).repartition(partitions)


def by_id(df, *columns):
    return sorted(((r.doc_id, *(r[c] for c in columns)) for r in df.collect()), key=str)


def test_misra_gries_bounds():
    rng = random.Random(1)
    stream = [rng.choice("aaaabbc") if rng.random() < 0.5 else str(rng.randrange(500)) for _ in range(5000)]
    held, short = exact_dups.misra_gries([stream[i : i + 300] for i in range(0, 5000, 300)], 20)
    true = Counter(stream)
    assert len(held) <= 20 and short <= 5000 / 21
    assert all(true[k] - short <= n <= true[k] for k, n in held.items())
    assert all(n <= short for k, n in true.items() if k not in held)


@pytest.mark.parametrize("share", [1 / 1000, 0.2])
def test_exact_duplicates(spark, monkeypatch, share):
    monkeypatch.setattr(exact_dups, "HEAVY_SHARE", share)
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot"] * 6 + [f"t{rng.randrange(40)}", ""])) for i in range(400)]
    got = by_id(exact_dups.exact_duplicates(frame(spark, rows)), "keep_id", "group_size", "kept", "text_sha256")
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    assert got == sorted(((i, max(groups[t]), len(groups[t]), i == max(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows), key=str)


def test_exact_duplicates_on_odd_rows(spark):
    got = by_id(exact_dups.exact_duplicates(frame(spark, ODD)), "keep_id", "group_size", "kept")
    assert (4, 5, 4, False) in got and (5, 5, 4, True) in got and (None, 5, 4, False) in got and (2, 2, 3, True) in got and len(got) == len(ODD)
    left = exact_dups.drop_exact_duplicates(frame(spark, ODD))
    assert left.columns == frame(spark, ODD).columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 5, 6, 7, 8, 9]
    twice = frame(spark, [r for r in ODD if r[0] is not None] * 2 + [(5, "one")]).union(frame(spark, [(9, "other"), (None, "lone"), (None, "lone")]))
    once = exact_dups.drop_exact_duplicates(twice)
    assert sorted(((r.doc_id, r.text) for r in once.collect()), key=str) == sorted({(i, t) for i, t in ODD if i in (2, 3, 5, 6, 7, 8, 9)} | {(9, "other"), (None, "lone")}, key=str)
    assert exact_dups.exact_duplicates(frame(spark, [])).count() == 0


def brute_components(rows, size, percent):
    sets = {}
    for i, text in rows:
        words = [w for w in (text or "").encode().lower().split()]
        n = max(1, min(size, len(words)))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets.items())


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, size):
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", 10)
    monkeypatch.setattr(near_dups, "TEXT_ROWS", 10)
    rng = random.Random(3)
    base = [[rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 4) for _ in range(60)] for _ in range(4)]
    rows = []
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = str(rng.random())
        rows.append((i, " ".join(words)))
    rows += [(200, ""), (201, "same"), (202, "SAME"), (203, "same thing"), (204, " \t")]
    found = near_dups.near_duplicates(frame(spark, rows), p=near_dups.MinHash(shingle=size))
    assert by_id(found, "n_shingles", "component_id", "kept") == sorted(brute_components(rows, size, 80), key=str)


def test_near_duplicates_on_odd_rows(spark):
    found = near_dups.near_duplicates(frame(spark, ODD), p=near_dups.MinHash(shingle=2))
    got = by_id(found, "component_id", "kept")
    assert (5, 4, False) in got and (6, 4, False) in got and (4, 4, True) in got and (8, 8, True) not in got or (7, 7, True) in got
    assert (None, None, True) in got and (2, 2, True) in got and len(got) == len(ODD)
    left = near_dups.drop_near_duplicates(frame(spark, ODD))
    assert left.columns == frame(spark, ODD).columns and left.filter("doc_id in (5, 6)").isEmpty()
    assert near_dups.near_duplicates(frame(spark, [])).count() == 0


def near_copies(n, words=60):
    """A text and ``n`` others, each of which differs from it in another last word."""
    base = [f"w{i}" for i in range(words)]
    return [" ".join(base), *(" ".join([*base[:-1], f"other{k}"]) for k in range(n))]


def test_near_duplicates_of_one_id_go_text_by_text(spark):
    text, other = near_copies(1)
    rows = [(3, text), (5, other), (5, "a text unlike all the others here"), (5, None), (6, "one more of its own kind")]
    left = near_dups.drop_near_duplicates(frame(spark, rows))
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([rows[0], *rows[2:]], key=str)


def test_rows_without_id_link_others(spark):
    text, other = near_copies(1)
    # Two texts that are near only to a third one, which has no id.
    bridge = [f"v{i}" for i in range(60)]
    left, right = " ".join(["new", "start", *bridge[5:]]), " ".join([*bridge[:-5], "new", "end"])
    rows = [(None, text), (7, text), (9, other), (None, " ".join(bridge)), (None, " ".join(bridge).upper()), (20, left), (21, right)]
    found = near_dups.near_duplicates(frame(spark, rows, 1), p=near_dups.MinHash(shingle=2))
    assert by_id(found, "component_id", "kept") == sorted(
        [(7, 7, True), (9, 7, False), (20, 20, True), (21, 20, False), *[(None, None, True)] * 3], key=str
    )


def test_estimates_follow_similarity():
    p = near_dups.MinHash(shingle=1)
    rng = np.random.default_rng(5)
    for want in (0.5, 0.8, 0.95):
        values = rng.integers(0, 2**63, 4000, dtype=np.uint64)
        cut = int(4000 * (1 - want) / 2)
        a, b = np.unique(values[cut:]), np.unique(values[: 4000 - cut])
        low = [near_dups.packed_low_bits(near_dups.minima(x, p.factors()), p.bits) for x in (a, b)]
        x = low[0] ^ low[1]
        for s in range(1, p.bits):
            x |= (low[0] ^ low[1]) >> np.uint64(s)
        differ = int(np.bitwise_count(x & np.uint64(sum(1 << i for i in range(0, 64, p.bits)))).sum())
        agree = 1 - differ / p.minima
        assert abs((agree - p.chance) / (1 - p.chance) - want) < 0.2


def test_components_of_a_long_chain(spark):
    links = spark.range(300).selectExpr("id as a", "id + 1 as b").unionByName(spark.range(500, 502).selectExpr("id as a", "id + 1 as b"))
    got = {r.node: r.root for r in components(links).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[502] == 500 and len(got) == 304


def brute_removed(rows, length):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                gone[p : p + length] = [True] * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        if spans:
            out[i] = (sum(gone), spans, kept)
    return out


@pytest.mark.parametrize("group_rows,length", [(2_000, 12), (3, 12), (3, 100), (2_000, 100)])
def test_repeated_passages_equal_all_windows(spark, group_rows, length):
    rng = random.Random(length + group_rows)
    passages = ["".join(rng.choice("abñ ") for _ in range(length + rng.randrange(60))) for _ in range(3)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("abcdefgñ€") for _ in range(rng.randrange(150))) for _ in range(4)]
        rows.append((i, "".join(parts)))
    rows += [(100, "x" * 700), (101, "x" * 350), (102, None), (103, ""), (104, rows[0][1])]
    found = repeats.repeated_passages(frame(spark, rows), length=length, group_rows=group_rows)
    got = {r.doc_id: (sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in found.collect()}
    assert got == brute_removed(rows, length)


def test_repeated_passages_on_odd_rows(spark):
    found = {r.doc_id: r.spans for r in repeats.repeated_passages(frame(spark, ODD)).collect()}
    assert [tuple(s) for s in found[8]] == [(0, len(LONG))] and found[7][0].start == 5 and set(found) == {7, 8}
    assert repeats.repeated_passages(frame(spark, [])).count() == 0


def test_long_texts_are_cut_into_overlapping_parts(monkeypatch):
    monkeypatch.setattr(repeats, "PORTION", 500)
    rng = random.Random(9)
    text = bytes(rng.choice(b"abcd") for _ in range(3_000))
    w = repeats.Windows()
    parts = {}
    for _, s, first, last, at, h in repeats.anchors([text], w):
        for f, z, a, k in zip(first + s, last + s, at + s, h):
            parts |= {p: (a, k) for p in range(f, z + 1)}
    monkeypatch.setattr(repeats, "PORTION", 1 << 20)
    whole = {}
    for _, s, first, last, at, h in repeats.anchors([text], w):
        for f, z, a, k in zip(first, last, at, h):
            whole |= {p: (a, k) for p in range(f, z + 1)}
    assert parts == whole and len(whole) == 3_000 - 99


def test_samples_collide_as_generalised_jaccard():
    sampler = weighted_prints.Sampler()
    rng = random.Random(4)
    errors = []
    for trial in range(60):
        a = Counter(rng.choices([f"w{trial}_{i % 7 * "x"}{i}" for i in range(40)], k=80))
        b = Counter({k: max(0, n + rng.choice((-1, 0, 0, 1))) for k, n in a.items()}) + Counter(rng.choices([f"v{trial}_{i}" for i in range(9)], k=9))
        true = sum(min(a[k], b[k]) * len(k) for k in a | b) / sum(max(a[k], b[k]) * len(k) for k in a | b)
        text = lambda c: " ".join(c.elements())
        errors.append(weighted_prints.likeness(sampler.fingerprint(text(a)), sampler.fingerprint(text(b))) - true)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.09


def test_fingerprints_of_neighbours(spark):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("ab ñ") for _ in range(rng.randrange(0, 40)))) for i in range(90)] + [(200, None), (201, None)]
    found = {r.doc_id: r for r in weighted_prints.fingerprints(frame(spark, rows, 7)).collect()}
    order = sorted(rows, reverse=True)
    sampler = weighted_prints.Sampler()
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        r = found[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == weighted_prints.as_hex(sampler.fingerprint(text))
        assert r.near_next == weighted_prints.likeness(sampler.fingerprint(text), sampler.fingerprint(after))
    assert len(found) == len(rows)


def test_fingerprints_on_odd_rows(spark):
    got = weighted_prints.fingerprints(frame(spark, ODD)).collect()
    assert len(got) == len(ODD) and len({r.fingerprint for r in got if r.doc_id in (4, 5, 6)}) == 1 and all(0 <= r.near_edited <= 1 for r in got)
    assert weighted_prints.fingerprints(frame(spark, [])).count() == 0
    assert weighted_prints.fingerprints(frame(spark, [(1, "a b")])).first().near_next == 1.0
