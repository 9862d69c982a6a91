"""The streaming monitor against its batch twins, refresh by refresh."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import metrics
from corpusflow.streaming import jobs
from corpusflow.streaming.versions import Versions


def rows(n, begin, rng):
    start = dt.datetime(2024, 1, 1)
    names = ["loss", "lr", "rare"]
    return [(1, start + dt.timedelta(seconds=begin + i), begin + i, names[0 if i % 2 else 1 if i % 23 else 2], rng.random()) for i in range(n)]


def test_refreshes_equal_batch(spark, tmp_path):
    rng, begin = random.Random(3), 0
    assert jobs.monitored(spark, f"{tmp_path}/out").count() == 0 and jobs.smoothed(spark, f"{tmp_path}/sm").count() == 0
    for n in (3, 40, 1, 200, 57):
        spark.createDataFrame(rows(n, begin, rng), jobs.METRIC_ROW).write.mode("append").parquet(f"{tmp_path}/in")
        begin += n
        jobs.stream_monitor(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", smoothed_dir=f"{tmp_path}/sm").awaitTermination()
        on_file = spark.read.schema(jobs.METRIC_ROW).parquet(f"{tmp_path}/in")
        want = sorted(tuple(r) for r in metrics.latest(on_file, ["metric"], ["ts", "step"]).select("metric", "n_records", "latest").collect())
        assert sorted(tuple(r) for r in jobs.monitored(spark, f"{tmp_path}/out").collect()) == want
        smooth = metrics.smooth(on_file, ["metric"], ["step"]).select("metric", "step", "value", "smooth")
        want = sorted((tuple(r) for r in smooth.collect()), key=lambda r: r[:2])
        got = sorted((tuple(r) for r in jobs.smoothed(spark, f"{tmp_path}/sm").collect()), key=lambda r: r[:2])
        assert [r[:3] for r in got] == [r[:3] for r in want]
        assert [r[3] for r in got] == [pytest.approx(r[3]) if r[3] is not None else None for r in want]
    assert len(Versions(spark, f"{tmp_path}/out").committed()) == 2


class State:
    exists = False

    def update(self, value):
        self.exists, self.get = True, value


def test_many_records_of_a_metric_are_sent_in_pieces():
    start, rng, state, sent, n = dt.datetime(2024, 1, 1), random.Random(4), State(), [], 60_000
    values = [rng.random() for _ in range(n)]
    frames = (
        pd.DataFrame({"ts": [start + dt.timedelta(seconds=i) for i in part], "step": part, "value": [values[i] for i in part]})
        for part in (range(n - 1000, n), *(range(b, b + 1000) for b in range(0, n - 1000, 1000)))
    )
    for frame in jobs._follow(("loss",), frames, state):
        assert len(frame) <= n // 2
        sent += list(frame[frame["kind"] == "final"][["step", "value", "smooth"]].itertuples(index=False, name=None))
    want = [(k, values[k - 1], sum(values[max(0, k - 20) : k]) / min(20, k)) for k in range(1, n + 1)]
    assert [r[:2] for r in sent] == [r[:2] for r in want] and [r[2] for r in sent] == pytest.approx([r[2] for r in want])
    assert state.get == (n, start + dt.timedelta(seconds=n - 1), n - 1, values[-1], values[-20:])


def test_an_uncommitted_version_is_not_read(spark, tmp_path):
    table = Versions(spark, f"{tmp_path}/t")
    spark.range(3).write.parquet(table.path(0))
    table.commit(0)
    spark.range(5).write.parquet(table.path(1))
    assert table.current() == 0 and table.before(1) == 0 and table.before(0) is None
    table.commit(1)
    assert spark.read.parquet(table.path(table.current())).agg(F.count("id")).first()[0] == 5
