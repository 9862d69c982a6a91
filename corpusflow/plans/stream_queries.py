"""Streaming jobs run over the files present, compared with their batch meaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import metrics
from corpusflow.plans import sqlparts as q
from corpusflow.plans.corpus_queries import dirty
from corpusflow.plans.registry import query, table
from corpusflow.session import scratch_path
from corpusflow.streaming import jobs


@query(
    "stream_curate",
    f"""WITH c AS (SELECT doc_id, {q.clean(q.DIRTY)} AS text FROM documents)
SELECT doc_id, md5(text) AS text_md5 FROM c WHERE length(text) BETWEEN 200 AND 500000 AND {q.n_pieces('text')} BETWEEN 50 AND 8192""",
)
def stream_curate(spark, sf):
    root = scratch_path(spark, "stream")
    dirty(table(spark, sf, "documents")).select("doc_id", F.col("text").alias("content")).write.json(f"{root}/in")
    job = jobs.stream_curate(
        spark, f"{root}/in", "pretrain", f"{root}/out", f"{root}/ckpt",
        "doc_id long, content string", files_per_trigger=4, min_chars=200, min_tokens=50,
    )
    job.awaitTermination()
    return spark.read.parquet(f"{root}/out").select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "stream_monitor",
    """SELECT event_type AS metric, count(*) AS n_records, arg_max(value, ts) AS latest FROM events GROUP BY 1""",
)
def stream_monitor(spark, sf):
    root = scratch_path(spark, "monitor")
    rows = table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("step"),
        F.col("event_type").alias("metric"), "value",
    )
    rows.write.parquet(f"{root}/in")
    jobs.stream_monitor(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt").awaitTermination()
    return jobs.monitored(spark, f"{root}/out")


@query(
    "stream_smooth",
    f"""WITH r AS (SELECT event_type AS metric, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS step,
  count(*) OVER (PARTITION BY event_type) AS n FROM events),
w AS (SELECT metric, step, value, n, least({metrics.WIDEST}, n // {metrics.SHARE}) AS width,
  list(value) OVER (PARTITION BY metric ORDER BY step ROWS BETWEEN {metrics.WIDEST - 1} PRECEDING AND CURRENT ROW) AS near FROM r)
SELECT metric, step, value, round(CASE WHEN n > {metrics.FEWEST} THEN list_avg(near[greatest(len(near) - width + 1, 1):]) END, 6) + 0.0 AS smooth FROM w""",
)
def stream_smooth(spark, sf):
    """Rolling means of records that come in five refreshes."""
    root = scratch_path(spark, "monitor")
    rows = table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("step"),
        F.col("event_type").alias("metric"), "value",
    )
    last = table(spark, sf, "events").agg(F.max("event_id")).first()[0]
    for k in range(5):
        part = F.floor(F.col("step") * 5 / F.lit((last or 0) + 1)) == k
        rows.filter(part).write.mode("append").parquet(f"{root}/in")
        jobs.stream_monitor(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", smoothed_dir=f"{root}/smooth").awaitTermination()
    return jobs.smoothed(spark, f"{root}/smooth").withColumn("smooth", F.round("smooth", 6) + 0.0)
