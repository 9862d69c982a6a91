"""Curation and description read the text once."""

from pyspark.sql import functions as F

from corpusflow.operators import curate, stats
from corpusflow.plans.registry import table

SF = "/root/testdata/sf0.001"


def test_describe_scans_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = stats.describe_dataset(docs, curate.count_words_and_marks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Subquery" not in plan


def test_report_counts_every_stage_in_one_pass(spark):
    seen = spark.sparkContext.accumulator(0)
    touch = F.udf(lambda t: seen.add(1) or t, "string").asNondeterministic()
    docs = table(spark, SF, "documents").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, "short"), (-2, None), (-3, "w " * 9000), (-4, "one-and-a-half")], "doc_id long, text string")
    )
    kept, report = curate.process(docs.withColumn("text", touch("text")))
    row = report.first()
    assert seen.value == docs.count() == row.n_total
    assert row.dropped_chars >= 2 and row.dropped_tokens >= 1
    assert row.n_kept == kept.count() == row.n_total - row.n_removed
    assert row.n_removed == row.dropped_chars + row.dropped_tokens + row.dropped_duplicates


def test_empty_table(spark):
    kept, report = curate.process(spark.createDataFrame([], "doc_id long, text string"))
    assert kept.count() == 0 and report.first().n_total == 0 and report.first().removed_pct == 0
