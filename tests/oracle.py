"""Run a registered query and its SQL side by side and compare the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return repr(value)


def _bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between the rows of ``df`` and of ``sql``; empty when they agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    arrow = df.toArrow()
    rows = list(zip(*[c.to_pylist() for c in arrow.columns])) if arrow.num_rows else []
    kinds = {"int64": "BIGINT", "int32": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "bool": "BOOLEAN"}
    sql_types = {d[0]: str(d[1]) for d in result.description}
    for field in arrow.schema:
        want = kinds.get(str(field.type), str(field.type))
        if sql_types[field.name] != want:
            problems.append(f"column {field.name} is {want}, SQL has {sql_types[field.name]}")
    got, want = _bag(rows, df.columns), _bag(expected, names)
    if got != want:
        extra, lacking = got - want, want - got
        problems.append(
            f"{len(rows)} rows instead of {len(expected)}; "
            f"{sum(extra.values())} only in Spark, e.g. {str(next(iter(extra), None))[:400]}; "
            f"{sum(lacking.values())} only in SQL, e.g. {str(next(iter(lacking), None))[:400]}"
        )
    return problems
