"""Corpus readers: path expansion, format detection, tolerant scans, merged loading."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from corpusflow.functions.text import strip
from corpusflow.operators.batching import shuffle as seeded_shuffle
from corpusflow.operators.schema_ops import normalize_schema, validate_schema
from corpusflow.session import scratch_path
from corpusflow.sources.ranges import array_elements, csv_records
from corpusflow.schemas import ALIASES, FORMAT_OF as _FORMAT_OF, MESSAGE, MESSAGES, SCHEMAS


def _suffix(path: str) -> str:
    match = re.search(r"[^/](\.[^./]+)$", path)
    return match.group(1).lower() if match else ""


def _hadoop(spark: SparkSession, path: str):
    """The path and its file system, so object stores and HDFS work like local disks."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _shown(path: str, like: str) -> str:
    """Drop the ``file:`` scheme Hadoop adds to plain local paths."""
    return path if "://" in like or like.startswith("file:") else re.sub(r"^file:/*", "/", path)


def expand_paths(spark: SparkSession, paths: str | Iterable[str]) -> list[str]:
    """Files named by paths, folders (direct children only) and globs; sorted within each."""
    found: list[str] = []
    for path in [paths] if isinstance(paths, str) else list(paths):
        where, fs = _hadoop(spark, path)
        if fs.exists(where) and fs.getFileStatus(where).isDirectory():
            children = [s for s in fs.listStatus(where) if s.isFile()]
            found += sorted(_shown(s.getPath().toString(), path) for s in children)
        elif "*" in path or "?" in path:
            found += sorted(_shown(s.getPath().toString(), path) for s in fs.globStatus(where) or [])
        else:
            found.append(path)

    def usable(path: str) -> bool:
        if _suffix(path) in _FORMAT_OF:
            return True
        where, fs = _hadoop(spark, path)
        return fs.exists(where) and fs.getFileStatus(where).isFile()

    return [p for p in found if usable(p)]


def _first_bytes(spark: SparkSession, path: str, n: int = 4) -> bytes:
    where, fs = _hadoop(spark, path)
    try:
        stream = fs.open(where)
    except Exception:  # unreadable files fall back to the default format
        return b""
    try:
        head = [stream.read() for _ in range(n)]
    finally:
        stream.close()
    return bytes(b for b in head if b >= 0)


def detect_format(spark: SparkSession, path: str) -> str:
    """Format by suffix, else by the first bytes, else JSON."""
    known = _FORMAT_OF.get(_suffix(path))
    if known:
        return known
    return "parquet" if _first_bytes(spark, path) == b"PAR1" else "json"


def _message_columns(kind: str | None) -> set[str]:
    """Names under which the kind's message arrays may come."""
    fields = SCHEMAS[kind].fields if kind in SCHEMAS else []
    names = set()
    for field in fields:
        if field.dataType == MESSAGES:
            names |= {field.name, *ALIASES.get(kind, {}).get(field.name, ())}
    return names


def _array_files(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[str]]:
    """The files that begin with a bracket, and the others that hold anything; found by one distributed pass."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.substring(F.regexp_replace("value", r"\A[\s\x{FEFF}]+", ""), 1, 1).alias("mark"),
        F.monotonically_increasing_id().alias("n"),
    )
    marks = lines.filter("start = 0 AND mark <> ''").groupBy("path").agg(F.min_by("mark", "n").alias("mark")).collect()
    found = sorted((unquote(r["path"]), r["mark"] == "[") for r in marks)  # the paths come as URIs
    return [p for p, array in found if array], [p for p, array in found if not array]


def read_json(
    spark: SparkSession, paths: list[str], schema: T.StructType | None = None, kind: str | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """JSON lines, or whole-file arrays of objects for the files that start with a bracket.

    ``.jsonl`` files are lines and are not looked at to find out. Arrays are read by ranges, however they are laid
    out, and written to the checkpoint folder as lines. A malformed record is an error unless ``mode`` is
    ``DROPMALFORMED``; :func:`bad_json_lines` lists such lines. With a ``kind``, message arrays are read as
    such: fields that are missing become null, and decoded ones stay JSON text with their keys in the
    order of the file.
    """
    lines = [p for p in paths if _suffix(p) == ".jsonl"]
    unknown = [p for p in paths if _suffix(p) != ".jsonl"]
    if unknown:
        arrays, others = _array_files(spark, unknown)
        if arrays:
            written = scratch_path(spark, "arrays")
            array_elements(spark, arrays).write.text(written)
            others.append(written)
        lines += others or ([] if lines else unknown)
    messages = _message_columns(kind)
    reader = spark.read.options(mode=mode)
    if schema is None and messages:
        found = reader.json(lines).schema
        schema = T.StructType([T.StructField(f.name, MESSAGES if f.name in messages else f.dataType) for f in found.fields])
    return (reader.schema(schema) if schema else reader).json(lines)


def bad_json_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines of JSON-lines files that are not one JSON value, with the file's path."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    return lines.filter((F.trim("value") != "") & F.try_parse_json("value").isNull())


# Types that a column of delimited files may have if all its values look like it, in this order.
_LOOKS = (
    ("int", r"\A\s*[+-]?\d+\s*\z"),
    ("bigint", r"\A\s*[+-]?\d+\s*\z"),
    ("double", r"\A\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z|\A(NaN|[+-]?Infinity)\z"),
    ("date", r"\A\d{4}-\d{2}-\d{2}\z"),
    ("timestamp", r"\A\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"),
    ("boolean", r"\A(?i:true|false)\z"),
)


def _inferred(rows: DataFrame) -> dict[str, str]:
    """Types of text columns by all their values, in one pass; columns without values are text."""
    checks = []
    for i, name in enumerate(rows.columns):
        value = F.col(f"`{name}`")
        checks.append(F.count(value).alias(f"n{i}"))
        for kind, look in _LOOKS:
            checks.append(F.count_if(value.rlike(look) & value.try_cast(kind).isNotNull()).alias(f"{kind}{i}"))
    counts = rows.agg(*checks).first()
    return {
        name: next((kind for kind, _ in _LOOKS if counts[f"n{i}"] and counts[f"{kind}{i}"] == counts[f"n{i}"]), "string")
        for i, name in enumerate(rows.columns)
    }


def _column_names(header: str, sep: str) -> list[str]:
    names = next(csv.reader(io.StringIO(header, newline=""), delimiter=sep))
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def read_csv(
    spark: SparkSession, paths: list[str], sep: str = ",", schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """Delimited files with headers, read by ranges and joined by column names.

    Files may have different headers, which are matched to them by their own paths. A quoted field may hold line
    feeds, and large files are split nevertheless. Without ``multi_line``, a record is a line, which saves
    a pass in Python. Types are those of a ``schema``, by name, else what all values look like. A record with more
    or fewer fields than its header is an error.
    """
    found, firsts = csv_records(spark, paths, sep, multi_line)
    headers = sorted(r["first"] for r in firsts.select("first").distinct().collect())  # one for each layout
    if not headers:
        return spark.createDataFrame([], schema or T.StructType())
    parts = []
    for header in headers:
        names = _column_names(header, sep)
        own = found
        if len(headers) > 1:
            own = found.join(firsts.filter(F.col("first") == header).select("path"), "path", "left_semi")
        body = own.filter(~((F.col("start") == 0) & (F.col("k") == 0)))
        fields = ", ".join(f"c{i} string" for i in range(len(names)))
        options = {"sep": sep, "escape": '"', "multiLine": "true", "mode": "FAILFAST"}
        rows = body.select(F.from_csv("record", fields, options).alias("r")).select(
            *[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)]
        )
        if schema is None:
            types = _inferred(rows)
            parts.append(rows.select(*[F.col(f"`{n}`").cast(types[n]).alias(n) for n in names]))
        else:
            have = {f.name: F.col(f"`{f.name}`") if f.name in names else F.lit(None) for f in schema.fields}
            parts.append(rows.select(*[have[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]))
    return _union(parts)


def read_parquet(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet files; of several, a column that some lack is null in their rows."""
    return spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)


def read_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per line that is not blank, trimmed."""
    lines = spark.read.text(paths).select(strip(F.col("value")).alias("text"))
    return lines.filter(F.length("text") > 0)


def _read(
    spark: SparkSession, fmt: str, paths: list[str], kind: str | None = None, mode: str = "FAILFAST", multi_line: bool = True
) -> DataFrame:
    if fmt == "json":
        return read_json(spark, paths, kind=kind, mode=mode)
    if fmt in ("csv", "tsv"):
        return read_csv(spark, paths, "\t" if fmt == "tsv" else ",", multi_line=multi_line)
    return read_parquet(spark, paths) if fmt == "parquet" else read_text(spark, paths)


def _union(parts: list[DataFrame]) -> DataFrame:
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged


def _as_message(item: Column, kind: T.StructType) -> Column:
    """A message with the canonical fields: absent ones are null, values that are not text become JSON."""
    types = {f.name: f.dataType for f in kind.fields}
    fields = []
    for name in MESSAGE.fieldNames():
        if name not in types:
            value = F.lit(None).cast("string")
        elif isinstance(types[name], (T.StructType, T.ArrayType, T.MapType)):
            value = F.to_json(item[name])
        else:
            value = item[name].cast("string")
        fields.append(value.alias(name))
    return F.struct(*fields)


def conform(df: DataFrame, kind: str) -> DataFrame:
    """Canonical columns in their canonical types, whatever types the files had."""
    for field in SCHEMAS[kind].fields:
        if field.name not in df.columns:
            continue
        have = df.schema[field.name].dataType
        column = F.col(field.name)
        if field.dataType == MESSAGES and isinstance(have, T.StringType):
            column = F.from_json(column, MESSAGES)
        elif field.dataType == MESSAGES and isinstance(have, T.ArrayType) and isinstance(have.elementType, T.StructType) and have != MESSAGES:
            element = have.elementType
            column = F.transform(column, lambda m: _as_message(m, element))
        elif isinstance(field.dataType, T.ArrayType) and not isinstance(have, T.ArrayType):
            column = F.when(column.isNotNull(), F.array(column.cast("string")))
        elif field.dataType != MESSAGES:
            column = column.cast(field.dataType)
        df = df.withColumn(field.name, column)
    return df


class CorpusReader:
    """Loads paths, remembering the plan of each path it has seen."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._plans: dict[str, DataFrame] = {}

    def load(self, path: str) -> DataFrame:
        if path not in self._plans:
            self._plans[path] = _read(self.spark, detect_format(self.spark, path), [path])
        return self._plans[path]

    def load_multi(
        self,
        paths: str | Iterable[str],
        kind: str = "pretrain",
        shuffle: bool = True,
        seed: int = 42,
        process_fn: Callable[[DataFrame], DataFrame] | None = None,
        strict: bool = False,
        mode: str = "FAILFAST",
        multi_line: bool = True,
    ) -> DataFrame:
        """All files of ``paths`` as one table in the kind's canonical columns and types.

        Files of one format (and, for delimited ones, header) are read by one scan; ``process_fn`` maps a
        DataFrame, so per-row functions go through ``mapInPandas`` or column expressions. Where several
        columns may hold a field, a row takes the first that is set. Shuffling orders rows by a hash of
        their content and needs no row key. A malformed JSON record is an error unless ``mode`` is
        ``DROPMALFORMED``. Without ``multi_line``, fields of delimited files hold no line feeds.
        """
        files = expand_paths(self.spark, paths)
        if not files:
            raise FileNotFoundError(f"no readable files in {paths}")
        groups: dict[str, list[str]] = {}
        for path in files:
            groups.setdefault(detect_format(self.spark, path), []).append(path)
        parts = []
        for fmt, members in groups.items():
            part = conform(normalize_schema(_read(self.spark, fmt, members, kind, mode, multi_line), kind), kind)
            part = validate_schema(part, kind, strict)
            parts.append(process_fn(part) if process_fn else part)
        merged = _union(parts)
        if not shuffle:
            return merged
        keyed = merged.withColumn("_row", F.md5(F.to_json(F.struct(*merged.columns))))
        return seeded_shuffle(keyed, seed, "_row").drop("_row")


def load_pretrain_data(spark: SparkSession, paths, **options) -> DataFrame:
    return CorpusReader(spark).load_multi(paths, "pretrain", **options)


def load_sft_data(spark: SparkSession, paths, **options) -> DataFrame:
    return CorpusReader(spark).load_multi(paths, "sft", **options)


def load_dpo_data(spark: SparkSession, paths, **options) -> DataFrame:
    return CorpusReader(spark).load_multi(paths, "dpo", **options)


def load_rlaif_data(spark: SparkSession, paths, **options) -> DataFrame:
    return CorpusReader(spark).load_multi(paths, "rlaif", **options)


def load_agent_data(spark: SparkSession, paths, **options) -> DataFrame:
    return CorpusReader(spark).load_multi(paths, "agent", **options)


def tokenizer_corpus(lines: DataFrame, line_key: str = "value", limit: int | None = None, order_key: str | None = None) -> DataFrame:
    """Training texts from raw JSON lines: broken lines are skipped, contents joined by line feeds.

    All lines by default; a ``limit`` takes the first ones by ``order_key``.
    """
    if limit is not None:
        if order_key is None:
            raise ValueError("a limit needs an order_key")
        lines = lines.orderBy(order_key).limit(limit)
    record = F.from_json(F.col(line_key), T.StructType([T.StructField("conversations", MESSAGES)]))
    contents = F.transform(record["conversations"], lambda m: m["content"])
    kept = F.filter(contents, lambda c: F.coalesce(F.length(c) > 0, F.lit(False)))
    texts = lines.withColumn("_kept", kept).filter(F.size("_kept") > 0)
    return texts.withColumn("text", F.array_join("_kept", "\n")).drop("_kept")
