"""Records of delimited and JSON-array files, read by byte ranges.

Spark's text source cuts files into ranges and gives each task the pieces between separators. Whether a
separator stands inside a quoted string is known only from what comes before, so each range is first
summed up as what it does to a reader that enters it outside and to one that enters it inside a string;
composing these along a file gives the state in which each range is entered. Then every range cuts its own
pieces into records, and the few that cross a border are put together from their ends.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.session import cut_lineage

# Ranges entered in another state than the usual one whose list is broadcast; a longer one is joined by a shuffle.
BROADCAST_RANGES = 100_000

BLANK = "\ufeff \t\r\n"

# What a piece does: (piece, inside a string) -> (inside a string after it, change of depth).
Step = Callable[[str, bool], tuple[bool, int]]

_CSV_CLOSE = re.compile(r'(?:[^"]++|"")*+"').match
_JSON_CLOSE = re.compile(r'(?:[^"\\]++|\\.)*+"', re.S).match
_JSON_TOKEN = re.compile(r'"(?:[^"\\]++|\\.)*+("?)|[\[\]{}]', re.S).finditer


def csv_step(sep: str) -> Step:
    """Lines of a delimited file: whether a quoted field is open at their end. Quotes count at the start of a field."""

    def step(line: str, inside: bool) -> tuple[bool, int]:
        if '"' not in line:
            return inside, 0
        at = 0
        while True:
            if inside:
                close = _CSV_CLOSE(line, at)
                if close is None:
                    return True, 0
                at, inside = line.find(sep, close.end()), False
            elif line.startswith('"', at):
                at, inside = at + 1, True
                continue
            else:
                at = line.find(sep, at)
            if at < 0:
                return False, 0
            at += len(sep)

    return step


def json_step(piece: str, inside: bool) -> tuple[bool, int]:
    """Text up to a closing brace: whether a string is open there, and the change of depth, with that brace."""
    at = 0
    if inside:
        close = _JSON_CLOSE(piece)
        if close is None:
            return True, 0
        at = close.end()
    depth = 0
    for token in _JSON_TOKEN(piece, at):
        mark = token[0][0]
        if mark == '"':
            if not token[1]:
                return True, depth
        else:
            depth += 1 if mark in "[{" else -1
    return False, depth - 1


def pieces(spark: SparkSession, paths: list[str], separator: str) -> DataFrame:
    """``path, start, piece``: what stands between separators, in order within each range of a file."""
    text = spark.read.option("lineSep", separator).text(paths)
    return text.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("piece")
    )


def _ranges(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple, Iterator[str]]]:
    """The pieces of each range in turn. A task reads ranges one after the other."""
    rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in ("piece", *columns))))
    return ((key, (r[0] for r in group)) for key, group in groupby(rows, lambda r: r[1:]))


def _manifest(table: DataFrame, step: Step, depth: int, separator: str) -> DataFrame:
    """One row per range: its effect on a reader outside and inside a string, and a file's first record.

    The first record ends at ``depth``; it is null if it goes on beyond the first range.
    """

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (path, start), own in _ranges(batches, "path", "start"):
            state, change = [False, True], [0, 0]
            head, first = [], None
            for piece in own:
                for entered in (0, 1):
                    state[entered], more = step(piece, state[entered])
                    change[entered] += more
                if start == 0 and first is None:
                    head.append(piece)
                    if not state[0] and change[0] == depth and (len(head) > 1 or piece.strip(BLANK)):
                        first = separator.join(head)
                    elif len(head) == 1 and not piece.strip(BLANK):
                        head = []
            yield pa.RecordBatch.from_pylist(
                [{"path": path, "start": start, "to0": state[0], "to1": state[1], "d0": change[0], "d1": change[1], "first": first}],
                pa.schema([("path", "string"), ("start", "int64"), ("to0", "bool"), ("to1", "bool"), ("d0", "int64"), ("d1", "int64"), ("first", "string")]),
            )

    kind = "path string, start long, to0 boolean, to1 boolean, d0 long, d1 long, first string"
    return cut_lineage(table.mapInArrow(sum_up, kind))


def _entered(manifest: DataFrame) -> DataFrame:
    """``path, start, inside, depth``: how each range is entered, by composing the ranges before it."""
    order = F.array_sort(F.collect_list(F.struct("start", "to0", "to1", "d0", "d1")))
    found = F.array().cast("array<struct<start:bigint,inside:boolean,depth:bigint>>")
    begin = F.struct(F.lit(False).alias("inside"), F.lit(0).cast("long").alias("depth"), found.alias("found"))

    def compose(now, part):
        here = F.struct(part["start"].alias("start"), now["inside"].alias("inside"), now["depth"].alias("depth"))
        return F.struct(
            F.when(now["inside"], part["to1"]).otherwise(part["to0"]).alias("inside"),
            (now["depth"] + F.when(now["inside"], part["d1"]).otherwise(part["d0"])).alias("depth"),
            F.concat(now["found"], F.array(here)).alias("found"),
        )

    states = manifest.groupBy("path").agg(F.aggregate(order, begin, compose, lambda s: s["found"]).alias("s"))
    return states.select("path", F.inline("s"))


COMPLETE, HEAD, TAIL, THROUGH = range(4)


def records(spark: SparkSession, paths: list[str], step: Step, separator: str, depth: int = 0) -> tuple[DataFrame, DataFrame]:
    """Records ``path, start, k, record``, and the files' first ones ``path, first``.

    A record ends with a separator outside of strings at ``depth``; the separators are kept. ``start`` and
    ``k`` order the records of a file. The files are read twice.
    """
    table = pieces(spark, paths, separator)
    manifest = _manifest(table, step, depth, separator)
    usual = (~F.col("inside")) & (F.col("depth") == F.when(F.col("start") == 0, 0).otherwise(depth))
    entered = cut_lineage(_entered(manifest).filter(~usual))
    n = entered.count()
    if 0 < n <= BROADCAST_RANGES:
        placed = table.join(F.broadcast(entered), ["path", "start"], "left")
    elif n:
        numbered = table.withColumn("n", F.monotonically_increasing_id()).join(entered, ["path", "start"], "left")
        placed = numbered.repartition("path", "start").sortWithinPartitions("path", "start", "n").drop("n")
    else:
        placed = table.withColumns({"inside": F.lit(False), "depth": F.lit(None).cast("long")})
    kind = pa.schema([("path", "string"), ("start", "int64"), ("k", "int64"), ("kind", "int8"), ("record", "string")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (path, start, inside, at), own in _ranges(batches, "path", "start", "inside", "depth"):
            inside = bool(inside)
            at = at if at is not None else 0 if start == 0 else depth
            whole = not inside and (at == depth or start == 0)  # whether a record begins here
            out, held, k = [], [], 0
            for piece in own:
                inside, more = step(piece, inside)
                at += more
                held.append(piece)
                if not inside and at == depth:
                    record = separator.join(held) + separator
                    if record.strip(BLANK) or not whole:
                        out.append((path, start, k, COMPLETE if whole else HEAD, record))
                        k += 1
                    held, whole = [], True
                    if len(out) >= 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kind)], schema=kind)
                        out = []
            if held:
                out.append((path, start, k, TAIL if whole else THROUGH, separator.join(held) + separator))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kind)], schema=kind)

    made = placed.mapInArrow(cut, "path string, start long, k long, kind byte, record string")
    own = ["path", "start", "k", "record"]
    complete = made.filter(F.col("kind") == COMPLETE).select(*own)
    firsts = manifest.filter("first IS NOT NULL").select("path", "first")
    if not n and manifest.filter("to0").isEmpty():
        return complete, firsts
    # At most two ends a range: a record goes from a tail to the next head.
    ends = cut_lineage(made.filter(F.col("kind") != COMPLETE))
    numbered = ends.selectExpr("*", f"count_if(kind = {TAIL}) OVER (PARTITION BY path ORDER BY start, k) AS record_no")
    parts = F.array_sort(F.collect_list(F.struct("start", "k", "record")))
    joined = numbered.groupBy("path", "record_no").agg(parts.alias("p")).select(
        "path", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["k"].alias("k"), F.array_join(F.col("p.record"), "").alias("record")
    )
    return complete.unionByName(joined), firsts


def csv_records(spark: SparkSession, paths: list[str], sep: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Records of delimited files, without their line ends, and the files' headers. Blank lines are left out."""
    step = csv_step(sep) if multi_line else lambda line, inside: (False, 0)
    found, firsts = records(spark, paths, step, "\n")
    plain = F.regexp_replace("record", r"\r?\n\z", "")
    header = F.regexp_replace("first", r"\A\x{FEFF}|\r\z", "")
    return found.withColumn("record", F.regexp_replace(plain, r"\A\x{FEFF}", "")), firsts.withColumn("first", header)


def array_elements(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Objects of files that hold one JSON array each, as one line of JSON each, in ``value``."""
    found, _ = records(spark, paths, json_step, "}", depth=1)
    # What stands between elements comes before each; white space outside of strings may be anything.
    plain = F.regexp_replace(F.regexp_replace("record", r"[\r\n]", " "), r"\A[\s\x{FEFF}]*[\[,]\s*", "")
    return found.select(plain.alias("value")).filter(~F.col("value").rlike(r"\A\s*\]?\s*\}?\z"))
