"""Keep costly expressions from being repeated by later ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fence(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """Compute ``columns`` behind a generator, beside the columns to ``keep`` (by default the others).

    The optimizer neither merges expressions into a generator's output nor pushes filters on it
    below, so a cleaned or rendered text is computed once per row however often it is read.
    """
    kept = [c for c in df.columns if c not in columns] if keep is None else keep
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
