"""Discounted sums, batch means, positions and registries against plain loops."""

import json
import math
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import skew
from corpusflow.operators import batching, rewards, rollouts
from corpusflow.plans import rollout_queries
from corpusflow.session import checkpoint_root


def tokens(spark, sizes, seed=1):
    rng = random.Random(seed)
    rows = [(s, p * 3 + 5, rng.uniform(-1, 1), rng.uniform(-1, 1)) for s, n in enumerate(sizes) for p in range(n)]
    return rows, spark.createDataFrame(rows, "sample_id long, pos long, token_reward double, value double").repartition(3)


@pytest.mark.parametrize("gamma,lam", [(1.0, 0.0), (1.0, 0.01), (0.0, 0.95), (0.5, 0.1), (1.0, 0.95), (0.99, 0.999), (1.0, 1.0), (1e-200, 0.5)])
def test_gae_for_any_discount(spark, gamma, lam):
    rows, df = tokens(spark, [1, 2, 700, 65, 8])
    got = {(r.sample_id, r.pos): (r.advantage, r["return"]) for r in rollouts.gae(df, gamma, lam).collect()}
    want, rest, value, sample = {}, 0.0, 0.0, None
    for s, p, reward, v in reversed(rows):
        if s != sample:
            rest, value, sample = 0.0, 0.0, s
        rest = reward + gamma * value - v + gamma * lam * rest
        value = v
        want[s, p] = (rest, rest + v)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9)


def test_gae_shuffles_once_and_rejects_growth(spark):
    _, df = tokens(spark, [5])
    plan = rollouts.gae(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(sample_id") == 1 and "Join" not in plan
    with pytest.raises(ValueError):
        rollouts.gae(df, 1.1, 1.0)


def test_batch_loss_counts_samples_alike(spark):
    losses = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 5.0)], "sample_id long, loss double")
    batches = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1), (1, 1)], "sample_id long, batch_id long")
    got = sorted(tuple(r) for r in rollouts.batch_loss(losses, batches).collect())
    assert got == [(0, 2, 2.0), (1, 2, 3.0)]


def test_positions_follow_the_order(spark):
    df = spark.range(1000).select(F.pmod(F.hash("id"), F.lit(97)).alias("x"), "id").repartition(7).orderBy("x", "id")
    rows = batching.with_positions(df).orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(1000)) and [(r.x, r.id) for r in rows] == sorted((r.x, r.id) for r in rows)
    assert batching.with_positions(df.limit(0)).count() == 0


def test_completions_meet_their_prompts(spark):
    prompts = spark.range(10).orderBy("id").select(F.col("id").alias("p"))
    completions = spark.range(45).orderBy("id").select(F.col("id").alias("c"))
    got = sorted((r.p, r.c) for r in rewards.join_prompts(prompts, completions, 4).collect())
    assert got == [(c // 4, c) for c in range(40)]


def test_calls_against_a_registry(spark):
    string, number = {"type": "string"}, {"type": "number"}
    tools = [
        ("say", json.dumps({"properties": {"text": string, "n": {"type": "integer"}}, "required": ["text"]}), ["n"]),
        ("add", json.dumps({"properties": {"a": number, "b": number}, "required": ["a"]}), None),
        *((f"tool{i}", "{}", None) for i in range(20)),
        ("broken", None, None),
    ]
    registry = spark.createDataFrame(tools, "name string, parameters_json string, not_null array<string>")
    calls = [
        ("say", {"text": "x", "n": 0}, True), ("say", {"text": "", "n": 1}, False), ("say", {"text": "0", "n": 1}, True),
        ("say", {"text": "x"}, False), ("say", {"text": "x", "n": None}, False), ("say", {"text": 5, "n": 1}, False),
        ("say", {"text": "x", "n": 1.5}, False), ("add", {"a": 2, "b": 0}, True), ("add", {"a": 0}, False), ("add", {"a": 3, "b": "4"}, False),
        ("add", {"a": -2.5, "other": [1]}, True), ("add", {"a": 9}, False), ("tool7", {}, True), ("broken", {"z": 1}, True),
        ("nobody", {}, False), ("tool8", {}, False), (None, {}, False),
    ]
    offered = ["say", "add", "tool7", "broken", "nobody"]
    rows = [(i, offered, [(n, json.dumps(a))]) for i, (n, a, _) in enumerate(calls)] + [(99, offered, []), (98, None, [("say", "{}")])]
    df = spark.createDataFrame(rows, "id long, offered array<string>, calls array<struct<name:string,decoded:string>>")
    small = {"add": lambda v: F.try_variant_get(v, "$.a", "double") < 5}
    got = {r.id: (r.n_calls, r.n_valid) for r in rewards.validate_by_registry(df, registry, "id", predicates=small).collect()}
    assert got == {i: (1, int(ok)) for i, (_, _, ok) in enumerate(calls)} | {99: (0, 0), 98: (1, 0)}


def test_a_batch_of_long_rows_is_spread_by_its_ids(spark, monkeypatch):
    asked = []

    def stats(df, keys, aggregates, spread_by, min_rows=skew.ROW_BUDGET):
        asked.append(min_rows)
        return skew.group_stats(df, keys, aggregates, spread_by, 2)

    monkeypatch.setattr(rollouts, "group_stats", stats)
    rows = [("b", i, [7] * (i + 1), [8] * i, [1] * i, [-0.5] * i) for i in range(9)]
    schema = "batch string, sample_id long, prompt_ids array<int>, response_ids array<int>, response_mask array<int>, response_logps array<double>"
    packed = rollouts.pack_rollouts(spark.createDataFrame(rows, schema), ["batch"], 300).collect()
    assert len(packed) == 9 and {len(r.input_ids) for r in packed} == {17}
    assert asked[0] * 300 <= 10_000_000


def test_frequent_and_rare_tokens_get_the_same_log_probabilities(spark, tmp_path):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "b", "c", f"w{i}x{j}"]) for j in range(rng.randint(0, 30))) for i in range(40)]
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2"])) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")

    def scored(most):
        return sorted(map(str, rollout_queries.token_logps(spark, str(tmp_path), most).collect()))

    assert scored(0) == scored(12) == scored(10**6) and len(scored(0)) == sum(len(t.split()) for t in texts)
    plan = rollout_queries.token_logps(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "BroadcastHashJoin" in plan


def documents(spark, path, n=40):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["a", "b", "c", f"w{i}x{j}"]) for j in range(rng.randint(1, 30))) for i in range(n)]
    ids = [None if i % 11 == 3 else i // 2 if i % 7 == 1 else i for i in range(n)]
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2"]), len(t)) for i, t in zip(ids, texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.fixture
def few_frequent(monkeypatch):
    """Most words are rare, as in large tables."""
    whole = rollout_queries.token_logps
    monkeypatch.setattr(rollout_queries, "token_logps", lambda spark, sf, **how: whole(spark, sf, 8, **how))


def shuffles(df):
    """The keys by which the plan deals out rows."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return Counter(line.split("hashpartitioning(")[1].split(")")[0].rsplit(", ", 1)[0] for line in plan.split("\n") if "Exchange hashpartitioning(" in line)


def test_tokens_by_sample_are_the_same_and_counts_are_removed(spark, tmp_path):
    sf = documents(spark, tmp_path)

    def rows(**how):
        return sorted(map(str, rollout_queries.token_logps(spark, sf, 8, **how).collect()))

    scratch = Path(checkpoint_root(spark).removeprefix("file:")) / "scratch"
    before = set(scratch.glob("*"))
    assert rows(by_sample=True) == rows() and rows()
    assert {p.name.split("-")[0] for p in set(scratch.glob("*")) - before} == {"frequent", "rare"}


def test_joined_logps_meet_without_a_shuffle_of_tokens(spark, tmp_path, few_frequent):
    df = rollout_queries.join_logps(spark, documents(spark, tmp_path))
    dealt = shuffles(df)
    assert not any("pos" in keys for keys in dealt)
    # Rows and texts only, with no other shuffle for the groups by sample.
    assert {keys.split("#")[0] for keys in dealt} == {"sample_id"} and sum(dealt.values()) <= 6


def test_joined_logps_with_nulls_and_repeated_keys(spark):
    tables = [
        [(1, 0, 0.1), (1, 1, 0.2), (2, 0, 0.3), (2, 0, 0.4), (None, 0, 1.0), (3, None, 1.0), (4, 0, 1.0), (5, 2, None)],
        [(1, 0, 1.1), (1, 1, None), (2, 0, 1.3), (None, 0, 1.0), (3, None, 1.0), (5, 2, 2.0), (6, 0, 2.0)],
        [(1, 0, 2.1), (1, 1, 2.2), (2, 0, 2.3), (2, 0, 2.4), (2, 0, 2.5), (None, 0, 1.0), (3, None, 1.0), (4, 0, 1.0), (5, 2, 3.0)],
    ]
    frames = [spark.createDataFrame(t, "sample_id long, pos int, logp double") for t in tables]
    got = rollouts.join_logps(*frames)
    assert got.dtypes == [("sample_id", "bigint"), ("pos", "int"), ("logp_policy", "double"), ("logp_old", "double"), ("logp_ref", "double")]
    want = Counter(
        (s, p, x, y, z)
        for s, p, x in tables[0] for t, q, y in tables[1] for u, r, z in tables[2]
        if None not in (s, p) and (s, p) == (t, q) == (u, r)
    )
    assert Counter(map(tuple, got.collect())) == want


def test_rewards_meet_tokens_read_once(spark, tmp_path, few_frequent):
    sf = documents(spark, tmp_path)
    for query in (rollout_queries.place_reward, rollout_queries.ppo_terms):
        df = query(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Generate posexplode") == 1
        assert sum(n for keys, n in shuffles(df).items() if keys.startswith("sample_id#")) == 2  # texts and rare tokens
        assert "ShuffledHashJoin" in plan and plan.count("Sort [sample_id#") == 1


def test_rewards_with_nulls_and_repeated_keys(spark):
    tokens = [(1, 0, 1), (1, 1, 1), (1, 2, 0), (2, 0, 0), (3, 0, 1), (3, 0, 1), (None, 0, 1), (4, 5, 1), (5, 0, 1)]
    rewards = [(1, 2.0), (2, 3.0), (2, 4.0), (3, 5.0), (None, 6.0), (4, 7.0), (4, 8.0), (9, 1.0), (5, None)]
    df = rollouts.place_reward(
        spark.createDataFrame(tokens, "sample_id long, pos int, mask int"), spark.createDataFrame(rewards, "sample_id long, reward double")
    )
    assert df.columns == ["sample_id", "pos", "mask", "token_reward"]
    assert Counter(map(tuple, df.collect())) == Counter({
        (1, 0, 1, 0.0): 1, (1, 1, 1, 2.0): 1, (1, 2, 0, 0.0): 1, (2, 0, 0, 0.0): 1, (3, 0, 1, 5.0): 2, (None, 0, 1, 0.0): 1,
        (4, 5, 1, 7.0): 1, (4, 5, 1, 8.0): 1, (5, 0, 1, 0.0): 1,
    })


def test_whitening_stores_no_rows(spark, tmp_path):
    spark.range(100).select("id", F.col("id").cast("double").alias("advantage"), (F.col("id") % 3 != 0).cast("int").alias("mask")).write.parquet(f"{tmp_path}/t")
    df = rollouts.whiten(spark.read.parquet(f"{tmp_path}/t"))
    assert "ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()
    held = [i for i in range(100) if i % 3]
    mean = sum(held) / len(held)
    scale = math.sqrt(sum((i - mean) ** 2 for i in held) / len(held))
    got = {r.id: r.advantage for r in df.collect()}
    assert all(got[i] == pytest.approx((i - mean) / scale if i % 3 else 0.0, abs=1e-9) for i in range(100))
