"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusflow.sources.readers import read_parquet

Query = Callable[[SparkSession, str], DataFrame]

ONE_SPLIT = 128 << 20

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Readers cut files at row groups, so a small file of one group is one task; it is dealt
    out by size, a task for each 128 KB (rows are small where there are many). Tables above one split are left as
    the reader cuts them."""
    df = read_parquet(spark, [f"{sf_dir}/{name}.parquet"])
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = min(spark.sparkContext.defaultParallelism, size >> 17)
    return df.repartition(tasks) if 1 < tasks and size < ONE_SPLIT else df
