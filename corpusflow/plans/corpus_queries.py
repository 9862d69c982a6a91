"""Queries over ingest, schema, cleaning, statistics, duplicates and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.functions import chat, text as tx
from corpusflow.operators import batching, curate, dedup, schema_ops, stats
from corpusflow.plans import sqlparts as q
from corpusflow.plans.registry import query, table
from corpusflow.session import scratch_path
from corpusflow.sources import readers, sinks


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return schema_ops.assemble_conversations(table(spark, sf, "conversations"))


def dirty(df: DataFrame) -> DataFrame:
    mess = F.concat(F.lit("\te\u0301\u00a0\u3000"), F.col("text"), F.lit("\r\n\u0007 "))
    return df.withColumn("text", mess)


# ---- scans ---------------------------------------------------------------------------------


@query("scan_parquet", "SELECT doc_id, lang, source, n_chars FROM documents WHERE n_chars >= 1000")
def scan_parquet(spark, sf):
    docs = readers.read_parquet(spark, [f"{sf}/documents.parquet"])
    return docs.filter(F.col("n_chars") >= 1000).select("doc_id", "lang", "source", "n_chars")


@query(
    "load_text_lines",
    rf"""WITH l AS (SELECT {q.strip("unnest(string_split_regex(text, '\r\n|\r|\n'))")} AS text FROM documents)
SELECT text, count(*) AS n FROM l WHERE text <> '' GROUP BY text""",
)
def load_text_lines(spark, sf):
    path = scratch_path(spark, "text")
    documents(spark, sf).select("text").write.text(path)
    lines = readers.read_text(spark, readers.expand_paths(spark, f"{path}/*.txt"))
    return lines.groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@query("load_jsonl", "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents")
def load_jsonl(spark, sf):
    path = scratch_path(spark, "json")
    documents(spark, sf).select("doc_id", "lang", F.col("text").alias("body")).write.json(path)
    loaded = readers.load_pretrain_data(spark, f"{path}/*.json")
    return loaded.select("doc_id", "lang", F.md5("text").alias("text_md5"))


def _csv(spark, sf, sep, pattern):
    path = scratch_path(spark, "delimited files, 100%")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    events.write.options(header=True, escape='"', sep=sep).csv(path)
    files = readers.expand_paths(spark, f"{path}/{pattern}")
    return readers.read_csv(spark, files, sep).select(
        F.col("event_id").cast("long"), F.col("user_id").cast("long"), "event_type", F.col("value").cast("double"), "props"
    )


_EVENTS = "SELECT event_id, user_id, event_type, value, props FROM events"


@query("load_csv", _EVENTS)
def load_csv(spark, sf):
    return _csv(spark, sf, ",", "*.csv")


@query("load_tsv", _EVENTS)
def load_tsv(spark, sf):
    return _csv(spark, sf, "\t", "*.csv")


@query("load_quoted_csv", "SELECT doc_id, source, md5(text) AS text_md5 FROM documents")
def load_quoted_csv(spark, sf):
    """Texts with line feeds, quotes and commas in fields, in files that are read by ranges."""
    path = scratch_path(spark, "quoted")
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    documents(spark, sf).select("doc_id", "text", "source").write.options(header=True, escape='"', **kept).csv(path)
    loaded = readers.read_csv(spark, readers.expand_paths(spark, f"{path}/*.csv"))
    return loaded.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.md5("text").alias("text_md5"))


@query("load_json_arrays", "SELECT doc_id, source, md5(text) AS text_md5 FROM documents")
def load_json_arrays(spark, sf):
    """Files that hold one array of 200 documents each, read by ranges."""
    path = scratch_path(spark, "json arrays")
    record = F.to_json(F.struct("doc_id", "source", "text"))
    files = documents(spark, sf).groupBy(F.expr("doc_id div 200")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(record), ",\n"), F.lit("]")).alias("value"))
    files.select("value").write.option("maxRecordsPerFile", 1).text(path)
    loaded = readers.read_json(spark, readers.expand_paths(spark, f"{path}/part-*"))
    return loaded.select("doc_id", "source", F.md5("text").alias("text_md5"))


@query("load_mixed_formats", "SELECT doc_id, md5(text) AS text_md5, length(text) AS chars FROM documents")
def load_mixed_formats(spark, sf):
    root = scratch_path(spark, "mixed")
    docs = documents(spark, sf)
    docs.filter("lang = 'en'").select("doc_id", F.col("text").alias("content")).write.parquet(f"{root}/a")
    docs.filter("lang = 'fr'").select("doc_id", F.col("text").alias("passage")).write.json(f"{root}/b")
    docs.filter("lang NOT IN ('en', 'fr')").select("doc_id", "text").write.json(f"{root}/c")
    paths = [f"{root}/a/*.parquet", f"{root}/b/*.json", f"{root}/c/*.json"]
    loaded = readers.CorpusReader(spark).load_multi(
        paths, "pretrain", process_fn=lambda d: d.withColumn("chars", F.length("text"))
    )
    return loaded.select("doc_id", F.md5("text").alias("text_md5"), F.col("chars").cast("long").alias("chars"))


@query(
    "load_mixed_columns",
    "SELECT doc_id, md5(text) AS text_md5 FROM documents UNION ALL SELECT event_id AS doc_id, md5(event_type) AS text_md5 FROM events",
)
def load_mixed_columns(spark, sf):
    """Parquet and delimited files that name and order their columns differently."""
    path, docs, events = scratch_path(spark, "mixed columns"), documents(spark, sf), table(spark, sf, "events")
    half = F.col("doc_id") % 2 == 0
    docs.filter(half).select("doc_id", "text").write.parquet(f"{path}/a")
    docs.filter(~half).select(F.col("text").alias("content"), "doc_id").write.parquet(f"{path}/b")
    half = F.col("event_id") % 2 == 0
    rows = events.select(F.col("event_id").alias("doc_id"), F.col("event_type").alias("text"))
    for name, part in (("c", rows.filter(half)), ("d", rows.filter(~half).select(F.col("text").alias("passage"), "doc_id"))):
        part.write.option("header", True).csv(f"{path}/{name}")
    loaded = readers.load_pretrain_data(spark, [f"{path}/{n}/part-*" for n in "abcd"])
    return loaded.select("doc_id", F.md5("text").alias("text_md5"))


_CHATS = """c AS (SELECT conv_id, count(*)::INTEGER AS n, md5(string_agg(role || ':' || text, '|' ORDER BY turn)) AS said
FROM conversations GROUP BY conv_id)"""


def _chats(spark, sf) -> DataFrame:
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("t")
    )
    return turns.select("conv_id", F.transform("t", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def _said(messages: str) -> Column:
    return F.md5(F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|"))


@query("load_sft", f"WITH {_CHATS} SELECT conv_id, n, said FROM c")
def load_sft(spark, sf):
    path = scratch_path(spark, "sft")
    _chats(spark, sf).write.json(path)
    loaded = readers.load_sft_data(spark, f"{path}/part-*")
    return loaded.select("conv_id", F.size("conversations").alias("n"), _said("conversations").alias("said"))


@query("load_dpo", f"WITH {_CHATS} SELECT conv_id, said AS chosen, said AS rejected FROM c")
def load_dpo(spark, sf):
    path = scratch_path(spark, "dpo")
    _chats(spark, sf).select("conv_id", F.col("messages").alias("preferred"), F.to_json("messages").alias("negative")).write.parquet(path)
    loaded = readers.load_dpo_data(spark, f"{path}/part-*")
    return loaded.select("conv_id", _said("chosen").alias("chosen"), _said("rejected").alias("rejected"))


@query("load_rlaif", f"WITH {_CHATS} SELECT conv_id, n, said FROM c")
def load_rlaif(spark, sf):
    path = scratch_path(spark, "rlaif")
    _chats(spark, sf).withColumnRenamed("messages", "dialog").write.parquet(path)
    loaded = readers.load_rlaif_data(spark, f"{path}/part-*")
    return loaded.select("conv_id", F.size("conversations").alias("n"), _said("conversations").alias("said"))


@query("load_agent", f"WITH {_CHATS} SELECT conv_id, said, n::VARCHAR AS gt FROM c")
def load_agent(spark, sf):
    path = scratch_path(spark, "agent")
    _chats(spark, sf).withColumn("ground_truth", F.array(F.size("messages").cast("string"))).write.json(path)
    loaded = readers.load_agent_data(spark, f"{path}/part-*")
    return loaded.select("conv_id", _said("conversations").alias("said"), F.get("gt", F.lit(0)).alias("gt"))


@query(
    "tokenizer_corpus",
    f"""WITH {q.CONVERSATIONS}
SELECT conv_id, array_to_string([m.content FOR m IN msgs IF m.content <> ''], chr(10)) AS text
FROM convs WHERE conv_id % 7 <> 0""",
)
def tokenizer_corpus(spark, sf):
    record = F.to_json(F.struct("conversations"))
    broken = F.substring(record, F.lit(1), F.length(record) - 3)
    lines = conversations(spark, sf).select(
        "conv_id", F.when(F.col("conv_id") % 7 == 0, broken).otherwise(record).alias("value")
    )
    return readers.tokenizer_corpus(lines, limit=None).select("conv_id", "text")


@query(
    "write_metrics",
    """SELECT event_type AS metric, count(*) AS n, round(sum(value), 4) AS total, max(user_id) AS last_run
FROM events GROUP BY 1""",
)
def write_metrics(spark, sf):
    path = scratch_path(spark, "metrics")
    rows = table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), "ts", F.col("event_id").alias("step"), F.col("event_type").alias("metric"), "value"
    )
    sinks.write_metrics(rows, path)
    return (
        spark.read.parquet(path)
        .groupBy(F.col("metric").cast("string").alias("metric"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.sum("value"), 4).alias("total"),
            F.max("run_id").alias("last_run"),
        )
    )


# ---- schema --------------------------------------------------------------------------------


@query("normalize_schema", "SELECT doc_id, length(text) AS chars, md5(text) AS text_md5 FROM documents")
def normalize_schema(spark, sf):
    split = documents(spark, sf).select(
        "doc_id",
        F.when(F.col("lang") == "en", F.col("text")).alias("content"),
        F.when(F.col("lang") != "en", F.col("text")).alias("passage"),
    )
    return schema_ops.normalize_schema(split, "pretrain").select(
        "doc_id", F.length("text").cast("long").alias("chars"), F.md5("text").alias("text_md5")
    )


@query("validate_schema", "SELECT doc_id, lang FROM documents WHERE n_chars >= 200")
def validate_schema(spark, sf):
    gaps = documents(spark, sf).withColumn("text", F.when(F.col("n_chars") >= 200, F.col("text")))
    return schema_ops.validate_schema(gaps, "pretrain", strict=True).select("doc_id", "lang")


# Records of every kind, made of the tables: texts under several names, and conversations as messages, answers,
# preference pairs and prompts that end on an empty turn.
_RECORDS = """m AS (SELECT conv_id, list(json_object('role', role, 'content', text) ORDER BY turn) AS m FROM conversations GROUP BY conv_id),
r AS (SELECT 'document' AS origin, doc_id AS id, CASE lang WHEN 'en' THEN json_object('doc_id', doc_id, 'text', text)
    WHEN 'fr' THEN json_object('content', text, 'source', source) WHEN 'de' THEN json_object('passage', text, 'chosen', lang)
    ELSE json_object('words', text) END AS j FROM documents
  UNION ALL SELECT 'conversation', conv_id, CASE conv_id % 5 WHEN 0 THEN json_object('conversations', m) WHEN 1 THEN json_object('messages', m)
    WHEN 2 THEN json_object('conversations', m, 'gt', m[1]) WHEN 3 THEN json_object('chosen', m, 'rejected', m)
    ELSE json_object('conversations', list_append(m, json_object('role', 'user', 'content', ''))) END FROM m),
k AS (SELECT *, json_keys(j) AS ks, json_extract(j, '$.conversations[#-1]') AS l FROM r),
kinds AS (SELECT origin, id, CASE
  WHEN list_has_all(ks, ['chosen', 'rejected']) THEN 'dpo'
  WHEN list_has_all(ks, ['conversations', 'gt']) THEN 'agent'
  WHEN list_contains(ks, 'conversations') AND json_extract_string(l, '$.role') = 'user'
       AND json_extract_string(l, '$.content') = '' THEN 'rlaif'
  WHEN list_contains(ks, 'conversations') THEN 'sft'
  WHEN list_contains(ks, 'text') THEN 'pretrain'
  WHEN list_has_any(ks, ['messages', 'dialog', 'chat']) THEN 'sft'
  WHEN list_has_any(ks, ['content', 'passage', 'document']) THEN 'pretrain'
  ELSE 'unknown' END AS kind FROM k)"""


def _records(spark, sf) -> DataFrame:
    text, lang = F.col("text"), F.col("lang")
    named = F.when(lang == "en", F.to_json(F.struct("doc_id", "text"))).when(lang == "fr", F.to_json(F.struct(text.alias("content"), "source")))
    named = named.when(lang == "de", F.to_json(F.struct(text.alias("passage"), lang.alias("chosen"))))
    docs = documents(spark, sf).select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), named.otherwise(F.to_json(F.struct(text.alias("words")))).alias("j")
    )
    m, shape = F.col("messages"), F.col("conv_id") % 5
    asks = F.concat(m, F.array(F.struct(F.lit("user").alias("role"), F.lit("").alias("content"))))
    made = F.when(shape == 0, F.to_json(F.struct(m.alias("conversations")))).when(shape == 1, F.to_json(F.struct("messages")))
    made = made.when(shape == 2, F.to_json(F.struct(m.alias("conversations"), m[0].alias("gt"))))
    made = made.when(shape == 3, F.to_json(F.struct(m.alias("chosen"), m.alias("rejected")))).otherwise(F.to_json(F.struct(asks.alias("conversations"))))
    chats = _chats(spark, sf).select(F.lit("conversation").alias("origin"), F.col("conv_id").alias("id"), made.alias("j"))
    return docs.unionByName(chats).select("origin", "id", schema_ops.detect_kind_col(F.col("j")).alias("kind"))


@query("detect_kind_rows", f"WITH {_RECORDS} SELECT origin, id, kind FROM kinds")
def detect_kind_rows(spark, sf):
    return _records(spark, sf)


@query(
    "detect_task_rows",
    f"""WITH {_RECORDS}, f AS (SELECT origin, id, lower('/data/' || left(origin, 4) || '/' || CASE id % 3 WHEN 0 THEN upper(kind) ELSE kind END
  || CASE id % 4 WHEN 3 THEN '_medical' ELSE '' END || '.jsonl') AS p FROM kinds)
SELECT origin, id, CASE
  WHEN regexp_matches(p, 'pretrain') THEN 'pretrain'
  WHEN regexp_matches(p, 'sft|chat|instruct|conversation') THEN 'full_sft'
  WHEN regexp_matches(p, 'dpo|preference|chosen|reject') THEN 'dpo'
  WHEN regexp_matches(p, 'rl|rlaif|reward') THEN 'grpo'
  WHEN regexp_matches(p, 'agent|tool|function_call') THEN 'agent'
  WHEN regexp_matches(p, 'lora|medical|domain') THEN 'lora'
  ELSE 'full_sft' END AS task FROM f""",
)
def detect_task_rows(spark, sf):
    """Files named by what their records are."""
    kind = F.when(F.col("id") % 3 == 0, F.upper("kind")).otherwise(F.col("kind"))
    topic = F.when(F.col("id") % 4 == 3, F.lit("_medical")).otherwise(F.lit(""))
    path = F.concat(F.lit("/data/"), F.left("origin", F.lit(4)), F.lit("/"), kind, topic, F.lit(".jsonl"))
    return _records(spark, sf).select("origin", "id", schema_ops.detect_task(path).alias("task"))


@query(
    "text_view",
    f"""SELECT doc_id, md5(array_to_string([w FOR w IN string_split_regex(text, '{q.SP}+') IF w <> ''], ' ')) AS joined
FROM documents""",
)
def text_view(spark, sf):
    listed = documents(spark, sf).select("doc_id", tx.tokens(F.col("text")).alias("text"))
    return listed.select("doc_id", F.md5(schema_ops.view_of(listed, "text")).alias("joined"))


# ---- cleaning and filters --------------------------------------------------------------------


@query("clean_text", f"SELECT doc_id, {q.clean(q.DIRTY)} AS text FROM documents")
def clean_text(spark, sf):
    return dirty(documents(spark, sf)).select("doc_id", tx.clean_text(F.col("text")).alias("text"))


@query("clean_columns", f"SELECT page_id, {q.clean('url')} AS url, {q.clean('html')} AS html FROM pages")
def clean_columns(spark, sf):
    return curate.clean_columns(table(spark, sf, "pages"))


@query(
    "clean_conversations",
    f"""SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS pos, role,
       {q.clean(q.DIRTY)} AS content FROM conversations""",
)
def clean_conversations(spark, sf):
    convs = schema_ops.assemble_conversations(dirty(table(spark, sf, "conversations")))
    cleaned = convs.select("conv_id", F.posexplode(tx.clean_conversations(F.col("conversations"))).alias("pos", "m"))
    return cleaned.select("conv_id", "pos", "m.role", "m.content")


@query(
    "valid_conversations",
    """SELECT conv_id, bool_and(CASE WHEN conv_id % 10 = 3 AND turn = 1 THEN false
                         WHEN conv_id % 10 = 4 AND turn = 1 THEN false
                         ELSE role IN ('system', 'user', 'assistant', 'tool') END) AS valid
FROM conversations GROUP BY conv_id""",
)
def valid_conversations(spark, sf):
    second = F.col("turn") == 1
    turns = table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.when(second & (F.col("conv_id") % 10 == 3), F.lit("critic")).otherwise(F.col("role")).alias("role"),
        F.when(~(second & (F.col("conv_id") % 10 == 4)), F.col("text")).alias("text"),
    )
    convs = schema_ops.assemble_conversations(turns)
    return convs.select("conv_id", schema_ops.is_valid_conversation(F.col("conversations")).alias("valid"))


@query("filter_by_length", "SELECT doc_id, n_chars FROM documents WHERE length(text) BETWEEN 200 AND 5000")
def filter_by_length(spark, sf):
    return curate.filter_by_length(documents(spark, sf), 200, 5000).select("doc_id", "n_chars")


@query("filter_by_tokens", f"SELECT doc_id, n_chars FROM documents WHERE {q.n_pieces('text')} BETWEEN 50 AND 1000")
def filter_by_tokens(spark, sf):
    return curate.filter_by_token_length(documents(spark, sf), lo=50, hi=1000).select("doc_id", "n_chars")


_STAGED = f"""src0 AS (SELECT doc_id, {q.clean('text')} AS text FROM documents),
staged AS (SELECT *, length(text) BETWEEN 10 AND 500000 AS ok_chars, {q.n_pieces('text')} BETWEEN 5 AND 8192 AS ok_tokens
           FROM src0),
src AS (SELECT doc_id, text FROM staged WHERE ok_chars AND ok_tokens)"""


@query(
    "curate_documents",
    f"""WITH RECURSIVE {_STAGED}, {q.fingerprints('src')}, {q.GREEDY}
SELECT doc_id, md5(text) AS text_md5 FROM src WHERE doc_id IN (SELECT doc_id FROM kept)""",
)
def curate_documents(spark, sf):
    kept = curate.process_dataset(documents(spark, sf).select("doc_id", "text"))
    return kept.select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "curate_report",
    f"""WITH RECURSIVE {_STAGED}, {q.fingerprints('src')}, {q.GREEDY},
n AS (SELECT count(*) AS n_total, (SELECT count(*) FROM kept) AS n_kept,
      count(*) FILTER (NOT ok_chars) AS dropped_chars,
      count(*) FILTER (ok_chars AND NOT ok_tokens) AS dropped_tokens FROM staged)
SELECT *, n_total - n_kept - dropped_chars - dropped_tokens AS dropped_duplicates, n_total - n_kept AS n_removed,
       round((n_total - n_kept) * 100.0 / n_total, 1)::DOUBLE AS removed_pct FROM n""",
)
def curate_report(spark, sf):
    return curate.process_report(documents(spark, sf).select("doc_id", "text"))


@query(
    "message_flags",
    """SELECT conv_id, false AS has_tools, arg_min(role, turn) = 'system' AS starts_with_system
FROM conversations GROUP BY conv_id""",
)
def message_flags(spark, sf):
    m = F.col("conversations")
    return conversations(spark, sf).select(
        "conv_id", chat.has_tools(m).alias("has_tools"), chat.starts_with_system(m).alias("starts_with_system")
    )


# ---- duplicates ------------------------------------------------------------------------------


@query("simhash_fingerprints", f"WITH {q.fingerprints('documents')} SELECT doc_id, fp AS fingerprint FROM prints")
def simhash_fingerprints(spark, sf):
    return dedup.simhash64(documents(spark, sf))


@query(
    "near_dup_pairs",
    f"""WITH {q.fingerprints('documents')},
firsts AS (SELECT fp, min(doc_id) AS doc_id FROM prints GROUP BY fp)
SELECT a.doc_id AS earlier, b.doc_id AS later, bit_count(xor(a.fp, b.fp))::INTEGER AS distance
FROM firsts a JOIN firsts b ON a.doc_id < b.doc_id AND bit_count(xor(a.fp, b.fp)) <= 3""",
)
def near_dup_pairs(spark, sf):
    return dedup.near_dup_pairs(documents(spark, sf))


@query(
    "dedup_near",
    f"WITH RECURSIVE {q.fingerprints('documents')}, {q.GREEDY} SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM kept)",
)
def dedup_near(spark, sf):
    return dedup.deduplicate(documents(spark, sf)).select("doc_id", "n_chars")


@query("dedup_exact", "SELECT min(doc_id) AS doc_id, any_value(n_chars) AS n_chars FROM documents GROUP BY text")
def dedup_exact(spark, sf):
    return dedup.deduplicate_exact(documents(spark, sf)).select("doc_id", "n_chars")


# ---- statistics ------------------------------------------------------------------------------


@query(
    "describe_documents",
    f"""WITH s AS (SELECT count(*) AS n, avg(length(text)) AS a, sum(length(text)) / sum({q.n_pieces('text')}) AS r FROM documents)
SELECT n AS n_rows, 5 AS n_columns, round(a, 6) AS avg_chars, round_even(r, 2) AS chars_per_token,
       floor(a * n / r)::BIGINT AS est_total_tokens, round_even(a * n / 1048576, 2) AS raw_text_mb FROM s""",
)
def describe_documents(spark, sf):
    described = stats.describe_dataset(documents(spark, sf), curate.count_words_and_marks)
    return described.withColumn("avg_chars", F.round("avg_chars", 6))


@query(
    "describe_sampled",
    f"""WITH f AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn FROM documents),
s AS (SELECT count(*) AS n, avg(length(text)) FILTER (rn <= 1000) AS a,
      sum(length(text)) FILTER (rn <= 500) / sum({q.n_pieces('text')}) FILTER (rn <= 500) AS r FROM f)
SELECT n AS n_rows, 5 AS n_columns, round(a, 6) AS avg_chars, round_even(r, 2) AS chars_per_token,
       floor(a * n / r)::BIGINT AS est_total_tokens, round_even(a * n / 1048576, 2) AS raw_text_mb FROM s""",
)
def describe_sampled(spark, sf):
    described = stats.describe_dataset(
        documents(spark, sf), curate.count_words_and_marks, sample=1000, token_sample=500, order_key="doc_id"
    )
    return described.withColumn("avg_chars", F.round("avg_chars", 6))


def _profile_sql(source: str, by: str, total: str = "n") -> str:
    group = f"GROUP BY {by}" if by else ""
    part = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""WITH src AS ({source}),
r AS (SELECT *, length(text) AS len, row_number() OVER ({part} ORDER BY length(text)) AS rk, count(*) OVER ({part}) AS n FROM src),
p AS (SELECT {lead}any_value(n) AS n, round_even(avg(len), 0)::BIGINT AS avg_chars,
  min(len) FILTER (rk >= n // 2 + 1) AS char_p50,
  min(len) FILTER (rk >= CASE WHEN n >= 10 THEN 9 * n // 10 + 1 ELSE n END) AS char_p90, max(len) AS char_max
  FROM r {group})
SELECT {lead}{total} AS n_rows, avg_chars, char_p50, char_p90, char_max,
  round_even(avg_chars / 2, 0)::BIGINT AS est_tokens_per_row, {total} * round_even(avg_chars / 2, 0)::BIGINT AS est_total_tokens FROM p"""


@query("analyze_documents", _profile_sql("SELECT text FROM documents", ""))
def analyze_documents(spark, sf):
    return _longs(stats.analyze_dataset(documents(spark, sf)))


@query(
    "analyze_sampled",
    _profile_sql("SELECT text FROM documents ORDER BY doc_id LIMIT 300", "", "(SELECT count(*) FROM documents)"),
)
def analyze_sampled(spark, sf):
    return _longs(stats.analyze_dataset(documents(spark, sf), sample=300, order_key="doc_id"))


@query("profile_by_lang_source", _profile_sql("SELECT lang, source, text FROM documents", "lang, source"))
def profile_by_lang_source(spark, sf):
    return _longs(stats.profile(documents(spark, sf), ["lang", "source"]))


def _longs(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in ("char_p50", "char_p90", "char_max")})


@query(
    "compression_by_lang",
    f"""WITH s AS (SELECT lang, length(text) AS c, {q.n_pieces('text')} AS t FROM documents)
SELECT lang, count(*) AS n_rows, sum(c)::BIGINT AS chars, sum(t)::BIGINT AS tokens, round(avg(c / t), 6) AS mean_ratio
FROM s WHERE t > 0 GROUP BY lang""",
)
def compression_by_lang(spark, sf):
    ratio = stats.compression_ratio(documents(spark, sf), curate.count_words_and_marks, ["lang"])
    return ratio.withColumn("mean_ratio", F.round("mean_ratio", 6))


@query(
    "truncation_by_lang",
    f"""WITH s AS (SELECT lang, {q.n_pieces('text')} AS t FROM documents)
SELECT lang, count(*) AS n_rows, count(*) FILTER (t > 512) AS rows_cut,
       round(count(*) FILTER (t > 512) / count(*), 6) AS rows_cut_share, sum(greatest(t - 512, 0))::BIGINT AS tokens_cut,
       round(sum(greatest(t - 512, 0)) / greatest(sum(t), 1), 6) AS tokens_cut_share FROM s GROUP BY lang""",
)
def truncation_by_lang(spark, sf):
    docs = documents(spark, sf)
    report = stats.truncation_report(docs, 512, ["lang"], curate.count_words_and_marks(F.col("text")))
    return report.withColumns({c: F.round(c, 6) for c in ("rows_cut_share", "tokens_cut_share")})


@query(
    "masked_mean_by_user",
    """SELECT user_id, count(*) FILTER (event_type <> 'error') AS n_masked,
  round(coalesce(sum(value) FILTER (event_type <> 'error'), 0) / greatest(count(*) FILTER (event_type <> 'error'), 1), 6) AS masked_mean
FROM events GROUP BY user_id""",
)
def masked_mean_by_user(spark, sf):
    mask = (F.col("event_type") != "error").cast("int")
    means = stats.masked_mean(table(spark, sf, "events"), F.col("value"), mask, ["user_id"])
    return means.withColumn("masked_mean", F.round("masked_mean", 6))


@query(
    "head_documents", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 300"
)
def head_documents(spark, sf):
    return stats.head(documents(spark, sf).select("doc_id", "lang", "n_chars"), 300, "doc_id")


# ---- order, batches, samples -----------------------------------------------------------------

_PLACED = """WITH p AS (SELECT doc_id, lang, row_number() OVER (ORDER BY md5('42:{epoch}:' || doc_id), doc_id) - 1 AS idx FROM documents)"""


@query("shuffle_documents", _PLACED.format(epoch=0) + " SELECT doc_id, lang, idx FROM p")
def shuffle_documents(spark, sf):
    docs = documents(spark, sf).select("doc_id", "lang")
    return batching.with_positions(batching.shuffle(docs, 42)).select("doc_id", "lang", "idx")


@query(
    "plan_batches",
    _PLACED.format(epoch=3) + " SELECT doc_id, idx, idx // 32 AS batch_id, (idx % 4)::INTEGER AS rank FROM p",
)
def plan_batches(spark, sf):
    planned = batching.plan_batches(documents(spark, sf).select("doc_id"), 42, 3, 32)
    return batching.shard(planned, 4).select("doc_id", "idx", "batch_id", "rank")


@query(
    "resume_batches",
    _PLACED.format(epoch=1)
    + """ SELECT batch_id, count(*) AS n, greatest(ceil((SELECT count(*) FROM documents) / 16)::BIGINT - 5, 0) AS remaining,
  batch_id * 8 // 3 AS step_rescaled FROM (SELECT idx // 16 AS batch_id FROM p) WHERE batch_id >= 5 GROUP BY batch_id""",
)
def resume_batches(spark, sf):
    docs = documents(spark, sf).select("doc_id")
    rows = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    left = batching.skip_batches(batching.plan_batches(docs, 42, 1, 16), 5)
    return left.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).select(
        "batch_id",
        "n",
        batching.remaining_batches(rows, 16, 5).cast("long").alias("remaining"),
        batching.rescale_step(F.col("batch_id"), 8, 3).alias("step_rescaled"),
    )


@query(
    "sample_flags",
    f"""SELECT doc_id, round({q.uniform('doc_id', 42, 'system')}, 9) AS u, {q.uniform('doc_id', 42, 'system')} < 0.2 AS chosen
FROM documents""",
)
def sample_flags(spark, sf):
    u = tx.hash_uniform(F.col("doc_id"), 42, "system")
    return documents(spark, sf).select("doc_id", F.round(u, 9).alias("u"), (u < 0.2).alias("chosen"))


@query(
    "expand_generations",
    "SELECT doc_id, unnest(range(4))::INTEGER AS generation FROM documents",
)
def expand_generations(spark, sf):
    return batching.expand_generations(documents(spark, sf).select("doc_id"), 4)
