import random

import pytest
from corpusflow.operators import dedup, graph
from corpusflow.session import cut_lineage


def near(a, b, k=3):
    return ((a ^ b) & (2**64 - 1)).bit_count() <= k


def fingerprints(seed, n, centres):
    """Random 64-bit values with many close to each other."""
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(centres)]
    out = set()
    while len(out) < n:
        v = rng.choice(base)
        for _ in range(rng.randint(0, 4)):
            v ^= 1 << rng.randrange(64)
        out.add(v - 2**64 if v >= 2**63 else v)
    return sorted(out)


def brute_pairs(values, k=3):
    return {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if near(a, b, k)}


@pytest.mark.parametrize("crowded,agree", [(10_000, 1), (10_000, 3), (2, 1), (4, 2)])
def test_near_fingerprints_are_exactly_the_brute_force_pairs(spark, crowded, agree):
    values = fingerprints(1, 150, 6)
    prints = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    found = dedup.near_fingerprints(prints, 3, crowded=crowded, agree=agree).collect()
    assert {(r.a, r.b) for r in found} == brute_pairs(values) and len(found) == len(brute_pairs(values))


def test_exploded_fingerprints_are_never_broadcast(spark):
    prints = spark.createDataFrame([(v,) for v in fingerprints(2, 60, 3)], "fingerprint long")
    found = dedup.near_fingerprints(prints, 3, crowded=2, agree=2)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.split("Initial Plan")[0].splitlines() if "BroadcastHashJoin" in line]
    # The keys that many share are few and may be broadcast; fingerprints and their flips may not.
    assert all("LeftSemi" in line for line in joins) and "SortMergeJoin [m#" in plan


def test_flip_masks_cover_the_ball(spark):
    masks = spark.range(1).select(dedup._flips(2).alias("m")).first().m
    assert len(masks) == len(set(masks)) == 1 + 64 + 64 * 63 // 2
    assert all(bin(m & (2**64 - 1)).count("1") <= 2 for m in masks)


def scan(edges):
    earlier = {}
    for a, b in edges:
        earlier.setdefault(b, []).append(a)
    removed = set()
    for v in sorted(earlier):
        if any(e not in removed for e in earlier[v]):
            removed.add(v)
    return removed


def ranks(df):
    rows = [r["rank"] for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("budget", [1000, 40, 3])
def test_first_kept_equals_a_scan_in_order(spark, budget):
    rng = random.Random(7)
    edges = {tuple(sorted(rng.sample(range(90), 2))) for _ in range(70)}
    edges |= {(100, v) for v in range(101, 130)} | {(v, v + 1) for v in range(200, 230)}
    frame = spark.createDataFrame(sorted(edges), "earlier long, later long")
    assert ranks(graph.first_kept(frame, budget)) == scan(edges)
    assert ranks(graph.first_kept(frame.limit(0), budget)) == set()


@pytest.mark.parametrize("budget", [1_000_000, 6_000])
def test_a_long_chain_takes_few_checkpoints(spark, monkeypatch, budget):
    """Above the budget, 5,000 links are split into components first."""
    made = []
    for module in (graph, dedup):
        monkeypatch.setattr(module, "cut_lineage", lambda df: made.append(1) or cut_lineage(df))
    edges = [(v, v + 1) for v in range(5_000)] + [(10_000 + v, 10_001 + v) for v in range(2_000)]
    frame = spark.createDataFrame(edges, "earlier long, later long").repartition(4)
    assert ranks(graph.first_kept(frame, budget)) == scan(edges)
    assert len(made) < 10


def test_components_equal_a_search(spark):
    rng = random.Random(11)
    edges = [tuple(rng.sample(range(300), 2)) for _ in range(170)] + [(500, v) for v in range(400, 500)] + [(5, 5)]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    found = graph.components(spark.createDataFrame(edges, "a long, b long"), budget=20).collect()
    roots = {}
    for node in sorted(near):
        todo = [node] if node not in roots else []
        while todo:
            v = todo.pop()
            if v not in roots:
                roots[v] = node
                todo += near[v]
    lone = {v for v in near if near[v] == {v}}
    assert sorted((r.node, r.root) for r in found) == sorted((v, r) for v, r in roots.items() if v not in lone)


def test_chain_keeps_every_other_text(spark):
    """A near B near C, but A not near C: the scan keeps A and C, unlike connected components."""
    frame = spark.createDataFrame([(0, 1), (1, 2)], "earlier long, later long")
    assert [r["rank"] for r in graph.first_kept(frame).collect()] == [1]


def test_candidate_join_is_an_equi_join(spark):
    prints = spark.createDataFrame([(v,) for v in fingerprints(2, 30, 3)], "fingerprint long")
    plan = dedup.near_fingerprints(prints, 3, agree=3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_empty_texts_share_the_zero_fingerprint(spark):
    rows = spark.createDataFrame([(1, ""), (2, "  "), (3, None), (4, "x")], "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in dedup.simhash64(rows).collect()}
    assert prints[1] == prints[2] == prints[3] == 0 != prints[4]
    assert {r.doc_id for r in dedup.deduplicate(rows).collect()} == {1, 4}


def test_exact_duplicates_keep_the_first(spark):
    rows = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b")], "doc_id long, text string")
    assert {r.doc_id for r in dedup.deduplicate_exact(rows).collect()} == {1, 2}
