"""The conversation trie against a trie built from whole sequences."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from corpusflow.llm import trie

TURNS = "conv_id long, turn long, role string, text string, depth string, path long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(3)


def originals(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]  # as SQL does for negative numbers
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) if children[node] else 1
        saved[node] = own + sum(saved[k] for k in children[node])
    out = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in held if len(convs[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(held), len(node), parent, len(held), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sample(seed, n=60, longest=7, vocabulary=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "é" * 3, "long " * 9][:vocabulary])))
    return rows


ODD = [
    (None, 1, "user", "nobody"), (7, None, None, None), (7, None, "user", None), (7, 1, "user", ""), (7, 1, "user", ""), (7, 1, "user", "a"),
    (33, 5, None, "x"), (33, 5, "", "x"), (1000, 2, "user", "a"), (1001, 2, "user", "a"), (-3, 0, "user", "a"), (10, 0, "user", "y" * 70_000),
]


@pytest.mark.parametrize("least,band,queue", [(64, 64, 200_000), (1, 64, 2), (3, 2, 2), (1, 3, 1)])
def test_rebuilt_trie_equals_brute_force(spark, monkeypatch, least, band, queue):
    monkeypatch.setattr(trie, "LEAST_SHARD", least)
    monkeypatch.setattr(trie.math, "isqrt", lambda n: least)
    monkeypatch.setattr(trie, "BAND", band)
    monkeypatch.setattr(trie, "QUEUE_ROWS", queue)
    rows = [*sample(least + band), *ODD]
    convs, turns = trie.rebuilt(trie.numbered_turns(frame(spark, rows)))
    assert got(trie.conversation_trie(convs, turns)) == brute(rebuild(originals(rows)))


def test_hot_conversation_and_copies(spark, monkeypatch):
    """One conversation of a third of all turns, another copied many times, cut into small pieces everywhere."""
    monkeypatch.setattr(trie, "LEAST_SHARD", 4)
    monkeypatch.setattr(trie.math, "isqrt", lambda n: 4)
    monkeypatch.setattr(trie, "BAND", 8)
    monkeypatch.setattr(trie, "ENDS_CHUNK", 3)
    whole = trie.ordered_index
    monkeypatch.setattr(trie, "ordered_index", lambda *a, **k: whole(*a, **(k | {"min_rows": 50, "pieces": 5})))
    rows = [(0, t, "user", f"turn {t % 7}") for t in range(300)] + [(100 + c, t, "user", f"turn {t % 7}") for c in range(60) for t in range(5)]
    convs = originals(rows)
    turns = trie.numbered_turns(frame(spark, rows))
    assert got(trie.conversation_trie(turns.select("conv_id").distinct(), turns)) == brute(convs)


def test_turnless_and_empty(spark):
    turns = trie.numbered_turns(frame(spark, []))
    assert got(trie.conversation_trie(turns.select("conv_id"), turns)) == []
    convs = spark.createDataFrame([(4,), (2,)], "conv_id long")
    ends = hashlib.sha256(b"2,4").hexdigest()
    assert got(trie.conversation_trie(convs, turns)) == [(2, 0, None, 2, 0, 1, 0, ends)]


def test_queue_spills_in_order():
    rng = random.Random(4)
    queue, waiting = trie.SpillingQueue(7), defaultdict(lambda: [0, 0])
    for level in range(-20, 0):
        for node in range(10):
            assert queue.take(level, node) == tuple(waiting.pop((level, node), (0, 0)))
            for _ in range(rng.randrange(4)):
                to = (level + 1, rng.randrange(10))
                queue.push((*to, 1, node))
                waiting[to] = [waiting[to][0] + 1, waiting[to][1] + node]
