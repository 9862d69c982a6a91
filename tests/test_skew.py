"""Balanced joins and positions, forced to split by tiny limits."""

from pyspark.sql import Window, functions as F

from corpusflow.functions import skew
from corpusflow.operators import batching, examples, metrics


def rows(spark, n=600):
    """Half of the rows in one group."""
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 5).alias("g"),
        ((F.col("id") * 37) % 101).alias("x"),
    )


def test_group_stats_equal_a_window_with_hot_and_null_groups(spark):
    df = rows(spark)
    got = skew.group_stats(df, ["g"], {"m": F.avg("x"), "n": F.count(F.lit(1))}, ["id"], min_rows=20)
    w = Window.partitionBy("g")
    want = df.withColumns({"m": F.avg("x").over(w), "n": F.count(F.lit(1)).over(w)})
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_hot_groups_are_cut_into_copies(spark):
    df = rows(spark)
    table = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    assert skew.attach(df, table, ["g"], ["id"], "n", min_rows=20).count() == 600
    plan = skew.attach(df, table, ["g"], ["id"], "n", min_rows=20)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "explode(sequence(0" in plan


def test_ordered_index_equals_row_number(spark):
    df = rows(spark)
    got = skew.ordered_index(df, ["g"], ["x", "id"], min_rows=20, pieces=8, running={"s": F.col("x")})
    w = Window.partitionBy("g").orderBy("x", "id")
    want = df.withColumns({"i": F.row_number().over(w), "s": F.sum("x").over(w), "n": F.count(F.lit(1)).over(Window.partitionBy("g"))})
    a = {r.id: (r._idx, r.s, r._n) for r in got.collect()}
    assert a == {r.id: (r.i, r.s, r.n) for r in want.collect()}


def test_blocks_leave_rolling_means_unchanged(spark):
    df = spark.range(500).select(F.lit("m").alias("metric"), F.col("id").alias("at"), ((F.col("id") * 7) % 13 * 1.0).alias("value"))
    small = {r.at: r.smooth for r in metrics.smooth(df, ["metric"], ["at"], min_rows=25).collect()}
    large = {r.at: r.smooth for r in metrics.smooth(df, ["metric"], ["at"]).collect()}
    assert small == large and len(small) == 500
    series = [(i * 7) % 13 * 1.0 for i in range(500)]
    assert all(abs(small[i] - sum(series[max(0, i - 19) : i + 1]) / min(20, i + 1)) < 1e-9 for i in range(500))


def test_few_records_are_not_smoothed_and_windows_shrink(spark):
    df = spark.range(24).select(F.when(F.col("id") < 10, "a").otherwise("b").alias("metric"), F.col("id").alias("at"), (F.col("id") * 1.0).alias("value"))
    got = {r.at: r.smooth for r in metrics.smooth(df, ["metric"], ["at"]).collect()}
    assert got[5] is None and got[23] == (23 + 22 + 21 + 20) / 4


def test_history_is_the_same_in_blocks(spark):
    df = spark.range(90).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    got = {r.turn: [m.text for m in r.context] for r in examples.history_context(df, 2, min_rows=10).collect()}
    assert got[0] == ["0"] and all(got[i] == [str(i - 2), str(i - 1), str(i)] for i in range(2, 90))
    own = {r.turn: len(r.context) for r in examples.history_context(df, 2, include_current=True, min_rows=10).collect()}
    assert own[50] == 2


def test_permutation_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    plans = [batching.plan_batches(d, 7, 2, 32) for d in (df.repartition(1), df.repartition(13))]
    a, b = ({r.doc_id: (r.idx, r.batch_id) for r in p.collect()} for p in plans)
    assert a == b and sorted(i for i, _ in a.values()) == list(range(1000))
    assert "Window [" in plans[0]._jdf.queryExecution().executedPlan().toString()
    for line in plans[0]._jdf.queryExecution().executedPlan().toString().splitlines():
        if "+- Window" in line or line.strip().startswith("Window"):
            assert "_b" in line or "_hi" in line


def test_ties_and_one_value_are_cut_too(spark):
    df = spark.range(3000).select(F.lit("m").alias("g"), F.lit(1.0).alias("x"), "id")
    got = skew.ordered_index(df, ["g"], ["x", "id"], min_rows=100)
    assert sorted((r.id, r._idx) for r in got.collect()) == [(i, i + 1) for i in range(3000)]
    pieces = df.repartitionByRange(60, "g", "x", "id").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in pieces.collect()) <= 100


def test_groups_above_the_budget_are_cut_however_large_the_table(spark):
    df = spark.range(40_000).select((F.col("id") % 400).alias("g"), "id")
    table = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    joined = skew.attach(df, table, ["g"], ["id"], "n", min_rows=50)
    assert joined.count() == 40_000 and joined.filter("n <> 100").isEmpty()
