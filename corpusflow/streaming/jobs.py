"""Structured Streaming jobs: curate corpus files as they arrive, and watch run metrics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from corpusflow.operators import curate, metrics
from corpusflow.operators.schema_ops import normalize_schema, validate_schema
from corpusflow.streaming.versions import Versions

METRIC_ROW = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("step", T.LongType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def curated(df: DataFrame, kind: str, **stages) -> DataFrame:
    """The stateless curation stages; the same columns for batch and stream."""
    named = validate_schema(normalize_schema(df, kind), kind)
    key = "text" if kind == "pretrain" else "conversations"
    flagged = curate.flag_stages(named, text_key=stages.pop("text_key", key), **stages)
    return flagged.filter(F.col("_dropped_by").isNull()).drop("_dropped_by")


def stream_curate(
    spark: SparkSession,
    in_dir: str,
    kind: str,
    out_dir: str,
    checkpoint: str,
    schema: T.StructType,
    fmt: str = "json",
    files_per_trigger: int = 1000,
    once: bool = True,
    **stages,
) -> StreamingQuery:
    """Append curated rows of new files to ``out_dir``; ``once`` stops after the files present."""
    source = (
        spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_trigger).load(in_dir)
    )
    writer = (
        curated(source, kind, **stages)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start(out_dir)


LATEST = "metric string, n_records long, latest double"
SMOOTHED = "metric string, step long, value double, smooth double"
# What the state of a metric sends out at a refresh: one ``latest`` row, and its smoothed rows. Those that no
# later record can change are ``final``; while a metric is short, its window still grows, and all its rows are ``open``.
_SENT = "kind string, metric string, n_records long, latest double, step long, value double, smooth double"
_STATE = "n long, ts timestamp, at long, latest double, held array<double>"
# Records from which on the window no longer grows.
_SETTLED = metrics.WIDEST * metrics.SHARE
# Rows that are given out at a time.
_PIECE = 20_000


def _rolling(values: np.ndarray, at: np.ndarray, n: int, upto: np.ndarray) -> np.ndarray:
    """The means at the ends ``at`` of ``values``, which are records ``upto`` of ``n``; like the batch operator's."""
    if n <= metrics.FEWEST:
        return np.full(len(at), np.nan)
    widest = min(metrics.WIDEST, n // metrics.SHARE)
    total = np.zeros(len(at))
    for back in range(widest - 1, -1, -1):  # in the order of the records
        total = np.where(upto > back, total + values[np.maximum(at - back, 0)], total)
    return total / np.minimum(widest, upto)


def _follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Take a refresh's new records of one metric. The state holds its last 20 values (or all of up to 59).

    Records are three numbers each here, and what is sent is made and given out piece by piece.
    """
    n, ts, at, latest, held = state.get if state.exists else (0, None, None, None, [])
    columns = zip(*[[f[c].to_numpy() for c in ("step", "ts", "value")] for f in frames])
    step, when, value = (np.concatenate(c) for c in columns)
    newest = np.lexsort((step, when))[-1]
    newest_ts = pd.Timestamp(when[newest])
    if ts is None or (newest_ts, step[newest]) >= (ts, at):
        ts, at, latest = newest_ts.to_pydatetime(), int(step[newest]), float(value[newest])
    values = np.concatenate([np.array(held, float), value[np.lexsort((when, step))].astype(float)])
    first, total = n - len(held) + 1, n + len(value)  # record numbers of the first value here, and of the last
    kind = "final" if total >= _SETTLED else "open"
    # Nothing of a short metric has been final so far, so all its rows are sent.
    begin = n + 1 if n >= _SETTLED else 1
    state.update((total, ts, at, latest, [float(v) for v in (values[-metrics.WIDEST :] if total >= _SETTLED else values)]))
    types = {"n_records": "Int64", "step": "Int64", "latest": float, "value": float, "smooth": float}
    names = ["kind", "metric", "n_records", "latest", "step", "value", "smooth"]
    yield pd.DataFrame([("latest", key[0], total, latest, None, None, None)], columns=names).astype(types)
    for start in range(begin, total + 1, _PIECE):
        k = np.arange(start, min(start + _PIECE, total + 1))
        rows = {"kind": kind, "metric": key[0], "n_records": None, "latest": None, "step": k, "value": values[k - first]}
        yield pd.DataFrame(rows | {"smooth": _rolling(values, k - first, total, k)}, columns=names).astype(types)


def stream_monitor(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    fmt: str = "parquet",
    refresh: str = "5 seconds",
    once: bool = True,
    smoothed_dir: str | None = None,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Keep the latest value and the record count of every metric, and with ``smoothed_dir`` their rolling means.

    Each metric's state is its count, its newest value and its last 20 values, so a refresh reads the new files
    only. Records of a metric are taken in the order of their steps within a refresh, and refreshes as files come.
    Outputs are read by :func:`monitored` and :func:`smoothed`. A refresh writes a version of its own, made of the
    version before and of what has changed, and commits it at the end: readers see whole refreshes, and never an
    empty table. Rolling means that are final are added to, not written anew.
    """
    records = spark.readStream.schema(METRIC_ROW).format(fmt).option("maxFilesPerTrigger", files_per_trigger).load(in_dir)
    sent = records.groupBy("metric").applyInPandasWithState(_follow, _SENT, _STATE, "update", "NoTimeout")

    def replace(table: Versions, n: int, changed: DataFrame, touched: DataFrame) -> None:
        before = table.before(n)
        if before is not None:
            old = spark.read.schema(changed.schema).parquet(table.path(before))
            changed = old.join(touched, "metric", "left_anti").select(*changed.columns).unionByName(changed)
        changed.write.mode("overwrite").parquet(table.path(n))

    def refresh_tables(batch: DataFrame, n: int) -> None:
        updates = f"{checkpoint}/refreshed"  # one refresh at a time, and a repeated one starts anew
        batch.write.mode("overwrite").parquet(updates)
        changed = spark.read.schema(batch.schema).parquet(updates)
        touched = changed.filter("kind = 'latest'").select("metric")
        table = Versions(spark, out_dir)
        replace(table, n, changed.filter("kind = 'latest'").select("metric", "n_records", "latest"), touched)
        if smoothed_dir:
            means = changed.select("kind", "metric", "step", "value", "smooth")
            means.filter("kind = 'final'").drop("kind").write.mode("overwrite").parquet(f"{smoothed_dir}/final/refresh={n}")
            open_rows = Versions(spark, smoothed_dir)
            replace(open_rows, n, means.filter("kind = 'open'").drop("kind"), touched)
            open_rows.commit(n)
        table.commit(n)

    writer = sent.writeStream.outputMode("update").foreachBatch(refresh_tables).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=refresh)
    return writer.start()


def monitored(spark: SparkSession, out_dir: str) -> DataFrame:
    """``metric, n_records, latest`` as of the last refresh; empty before the first."""
    table = Versions(spark, out_dir)
    current = table.current()
    if current is None:
        return spark.createDataFrame([], LATEST)
    return spark.read.schema(LATEST).parquet(table.path(current))


def smoothed(spark: SparkSession, smoothed_dir: str) -> DataFrame:
    """``metric, step, value, smooth`` of all records, as of the last refresh; empty before the first."""
    table = Versions(spark, smoothed_dir)
    current = table.current()
    if current is None:
        return spark.createDataFrame([], SMOOTHED)
    final = spark.read.schema(f"{SMOOTHED}, refresh long").parquet(f"{smoothed_dir}/final")
    final = final.filter(F.col("refresh") <= current).drop("refresh")
    return final.unionByName(spark.read.schema(SMOOTHED).parquet(table.path(current)))
