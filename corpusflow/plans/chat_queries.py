"""Queries over chat markup, tokenizer and training examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.functions import chat
from corpusflow.functions.fence import fence
from corpusflow.operators import batching, examples, tokenizer as tk
from corpusflow.operators.schema_ops import assemble_conversations
from corpusflow.plans import sqlparts as q
from corpusflow.plans.registry import query, table
from corpusflow.session import scratch_path
from corpusflow.sources import sinks

BYTES = tk.BpeModel()  # no merges: one token per byte, which SQL can reproduce

_TOOLS = '[{"type": "function", "function": {"name": "lookup", "parameters": {"required": ["k"]}}}]'


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations")


def plain(spark: SparkSession, sf: str) -> DataFrame:
    return assemble_conversations(turns(spark, sf))


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations enriched with tools, tool calls, tool turns and two ways of thinking."""
    conv, turn, role = F.col("conv_id"), F.col("turn"), F.col("role")
    is_assistant = role == "assistant"
    content = F.when(
        is_assistant & (conv % 4 == 2), F.concat(F.lit("<think>\nI see "), role, F.lit("\n</think>\n"), F.col("text"))
    ).otherwise(F.col("text"))
    rows = turns(spark, sf).select(
        conv,
        turn,
        F.when((role == "user") & (turn >= 3) & (conv % 3 == 1), F.lit("tool")).otherwise(role).alias("role"),
        content.alias("content"),
        F.when(is_assistant & (conv % 4 == 3), F.lit("\nthought over\n")).alias("reasoning_content"),
        F.when((role == "system") & (conv % 2 == 0), F.lit(_TOOLS)).alias("tools"),
        F.when(
            is_assistant & (conv % 5 == 0),
            F.concat(
                F.lit('[{"name": "lookup", "arguments": {"k": '), turn.cast("string"),
                F.lit('}}, {"function": {"name": "note", "arguments": "{\\"b\\":1}"}}]'),
            ),
        ).alias("tool_calls"),
    )
    message = F.struct("turn", "role", "content", "reasoning_content", "tools", "tool_calls")
    return rows.groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(message)), lambda m: m.dropFields("turn")).alias("conversations")
    )


# Rendering in SQL: one text per turn from the roles around it, then joined in order.
_TAGGED = f"""tagged AS (
  SELECT conv_id, turn, CASE WHEN role = 'user' AND turn >= 3 AND conv_id % 3 = 1 THEN 'tool' ELSE role END AS role,
    text AS content,
    CASE WHEN role = 'assistant' AND conv_id % 4 = 3 THEN 'thought over'
         WHEN role = 'assistant' AND conv_id % 4 = 2 THEN 'I see ' || role ELSE '' END AS reasoning,
    CASE WHEN role = 'system' AND conv_id % 2 = 0 THEN '{_TOOLS[1:-1]}' END AS tools,
    CASE WHEN role = 'assistant' AND conv_id % 5 = 0 THEN
      (CASE WHEN text <> '' THEN chr(10) ELSE '' END) || '<tool_call>' || chr(10) || '{{"name": "lookup", "arguments": {{"k": ' || turn
      || '}}}}' || chr(10) || '</tool_call>' || chr(10) || '<tool_call>' || chr(10) || '{{"name": "note", "arguments": {{"b":1}}}}'
      || chr(10) || '</tool_call>' ELSE '' END AS calls
  FROM conversations)"""
_PLAIN = """tagged AS (SELECT conv_id, turn, role, text AS content, '' AS reasoning, NULL::VARCHAR AS tools, '' AS calls FROM conversations)"""


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _rendered(source: str = "tagged") -> str:
    """CTEs ending in ``rendered(conv_id, body)`` over the turns of ``source``."""
    return f"""near AS (
  SELECT *, row_number() OVER w AS rn, coalesce(lag(role) OVER w, '') AS before, coalesce(lead(role) OVER w, '') AS after
  FROM {source} WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
bits AS (
  SELECT conv_id, turn, CASE
    WHEN role = 'system' AND rn = 1 AND tools IS NOT NULL THEN
      '<|im_start|>system' || chr(10) || content || chr(10) || chr(10) || {_sql(chat.TOOLS_INTRO)} || chr(10) || tools || {_sql(chat.TOOLS_OUTRO)}
    WHEN role IN ('user', 'system') THEN '<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10)
    WHEN role = 'assistant' THEN '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) || reasoning || chr(10) || '</think>'
      || chr(10) || chr(10) || ltrim(content, chr(10)) || calls || '<|im_end|>' || chr(10)
    WHEN role = 'tool' THEN (CASE WHEN before <> 'tool' THEN '<|im_start|>user' ELSE '' END) || chr(10) || '<tool_response>' || chr(10)
      || content || chr(10) || '</tool_response>' || (CASE WHEN after <> 'tool' THEN '<|im_end|>' || chr(10) ELSE '' END)
    ELSE '' END AS bit FROM near),
rendered AS (SELECT conv_id, string_agg(bit, '' ORDER BY turn) AS body FROM bits GROUP BY conv_id)"""


_PROMPTS = "[" + ", ".join(_sql(p) for p in chat.system_prompts()) + "]"


def _injected(source: str = "tagged") -> str:
    """CTE ``injected``: ``source`` plus a system turn for the chosen conversations."""
    return f"""injected AS (
  SELECT * FROM {source}
  UNION ALL BY NAME
  SELECT conv_id, -1 AS turn, 'system' AS role,
    {_PROMPTS}[(('0x' || substr(md5('42:prompt:' || conv_id), 1, 8))::BIGINT % 10) + 1] AS content,
    '' AS reasoning, NULL AS tools, '' AS calls
  FROM (SELECT conv_id, arg_min(role, turn) AS r, count(tools) AS t FROM {source} GROUP BY conv_id)
  WHERE r <> 'system' AND t = 0 AND {q.uniform('conv_id', 42, 'system')} < 0.2)"""


_EMPTY = _sql(chat.EMPTY_THINK)


def _stripped(body: str, key: str) -> str:
    return f"CASE WHEN {q.uniform(key, 42, 'think')} > 0.2 THEN replace({body}, {_EMPTY}, '') ELSE {body} END"


def _byte_ids(source: str, key: str = "conv_id") -> str:
    """CTE ``coded(key, ids)``: byte-level ids of ``source(key, body)``, special tokens as one id."""
    marked = "body"
    for i, token in enumerate(tk.ALL_SPECIAL):
        if i in (1, 2) or token in tk.ADDITIONAL:
            marked = f"replace({marked}, '{token}', chr({0xE000 + i}))"
    shown = "[" + ", ".join(str(i) for i in tk.BYTE_IDS) + "]"
    octets = "[('0x' || substr(hex(encode(c)), 2 * i - 1, 2))::INTEGER FOR i IN range(1, strlen(c) + 1)]"
    return f"""coded AS (
  SELECT {key}, flatten([CASE WHEN unicode(c) BETWEEN {0xE000} AND {0xE000 + 63} THEN [unicode(c) - {0xE000}]
    ELSE [{shown}[b + 1] FOR b IN {octets}] END FOR c IN string_split({marked}, '') IF c <> '']) AS ids
  FROM {source})"""


def _joined(column: Column | str) -> Column:
    return F.md5(F.array_join(column, ","))


# ---- conversations ---------------------------------------------------------------------------


@query(
    "assemble_conversations",
    f"""WITH {q.CONVERSATIONS}
SELECT conv_id, len(msgs) AS n_turns, array_to_string([m.role FOR m IN msgs], ',') AS roles,
       md5(array_to_string([m.content FOR m IN msgs], chr(10))) AS content_md5 FROM convs""",
)
def assemble(spark, sf):
    m = F.col("conversations")
    return plain(spark, sf).select(
        "conv_id",
        F.size(m).cast("long").alias("n_turns"),
        F.array_join(F.transform(m, lambda x: x["role"]), ",").alias("roles"),
        F.md5(F.array_join(F.transform(m, lambda x: x["content"]), "\n")).alias("content_md5"),
    )


@query(
    "inject_system",
    f"""WITH {_TAGGED}, {_injected()}
SELECT conv_id, count(*) AS n_turns, arg_min(content, turn) AS first_content, arg_min(role, turn) AS first_role
FROM injected GROUP BY conv_id""",
)
def inject_system(spark, sf):
    injected = tagged(spark, sf).select(
        "conv_id", chat.inject_system(F.col("conversations"), F.col("conv_id")).alias("m")
    )
    first = F.get("m", F.lit(0))
    content = F.regexp_replace(first["content"], "(?s)^<think>.*?</think>\n", "")
    return injected.select(
        "conv_id", F.size("m").cast("long").alias("n_turns"), content.alias("first_content"), first["role"].alias("first_role")
    )


@query(
    "split_tools",
    f"""SELECT conv_id, CASE WHEN arg_min(role, turn) = 'system' AND conv_id % 2 = 0 THEN '{_TOOLS}' END AS tools,
  count(*) - 1 AS n_messages FROM conversations GROUP BY conv_id""",
)
def split_tools(spark, sf):
    m = F.col("conversations")
    return tagged(spark, sf).select(
        "conv_id", chat.offered_tools(m).alias("tools"), F.size(chat.without_last(m)).cast("long").alias("n_messages")
    )


@query("render_chat", f"WITH {_TAGGED}, {_rendered()} SELECT conv_id, body FROM rendered")
def render_chat(spark, sf):
    m = F.col("conversations")
    return tagged(spark, sf).select("conv_id", chat.render_chat(m, chat.offered_tools(m)).alias("body"))


@query(
    "strip_empty_think",
    f"WITH {_TAGGED}, {_rendered()} SELECT conv_id, {_stripped('body', 'conv_id')} AS body FROM rendered",
)
def strip_empty_think(spark, sf):
    m = F.col("conversations")
    body = chat.render_chat(m, chat.offered_tools(m))
    return tagged(spark, sf).select("conv_id", chat.strip_empty_think(body, F.col("conv_id")).alias("body"))


@query(
    "rlaif_prompts",
    f"""WITH {_TAGGED}, {_injected()},
cut AS (SELECT * FROM injected QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) > 1),
{_rendered('(SELECT conv_id, turn, role, content, reasoning, NULL AS tools, calls FROM cut)')}
SELECT conv_id, body || '<|im_start|>assistant' || chr(10) || CASE WHEN {q.uniform('conv_id', 42, 'thinking')} < 0.5
  THEN '<think>' || chr(10) ELSE {_EMPTY} END AS prompt, '' AS answer FROM rendered""",
)
def rlaif_prompts(spark, sf):
    return examples.rlaif_prompts(tagged(spark, sf))


@query(
    "agent_samples",
    f"""SELECT conv_id, CASE WHEN arg_min(role, turn) = 'system' AND conv_id % 2 = 0 THEN '{_TOOLS}' END AS tools,
  count(*) - 1 AS n_messages, conv_id::VARCHAR AS gt FROM conversations GROUP BY conv_id""",
)
def agent_samples(spark, sf):
    rows = tagged(spark, sf).withColumn("gt", F.array(F.col("conv_id").cast("string")))
    return examples.agent_samples(rows).select(
        "conv_id", "tools", F.size("messages").cast("long").alias("n_messages"), F.array_join("gt", ",").alias("gt")
    )


@query(
    "parse_chat",
    f"""SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS pos, role,
  {q.strip("CASE WHEN role = 'assistant' THEN '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || ltrim(text, chr(10)) ELSE text END")} AS content
FROM conversations""",
)
def parse_chat(spark, sf):
    prompts = plain(spark, sf).select("conv_id", chat.render_chat(F.col("conversations")).alias("prompt"))
    parsed = prompts.select("conv_id", F.posexplode(chat.parse_chat(F.col("prompt"))).alias("pos", "m"))
    return parsed.select("conv_id", "pos", "m.role", "m.content")


@query(
    "history_context",
    """SELECT conv_id, turn, string_agg(role || ':' || text, '|') OVER w AS context FROM conversations
WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
)
def history_context(spark, sf):
    context = F.array_join(F.transform("context", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "|")
    return examples.history_context(turns(spark, sf), 3).select("conv_id", "turn", context.alias("context"))


# ---- tokenizer -------------------------------------------------------------------------------

_S = r"\p{Z}\t-\r\x{85}"
# RE2 has no look-ahead: a mark before the last blank of a run that a word follows does the same.
_PIECES = rf"""regexp_extract_all(regexp_replace(text, '([{_S}])([^{_S}])', chr(1) || '\1\2', 'g'),
  '''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^\p{{L}}\p{{N}}{_S}\x01]+|[{_S}]+')"""


@query("word_counts", f"SELECT word, count(*) AS n FROM (SELECT unnest({_PIECES}) AS word FROM documents) GROUP BY word")
def word_counts(spark, sf):
    return tk.word_counts(table(spark, sf, "documents"))


_MODELS: dict[tuple[str, int], tk.BpeModel] = {}


def _trained(spark: SparkSession, sf: str, vocab_size: int = 420) -> tk.BpeModel:
    """Trained once per corpus and size, then shared by the queries that need it."""
    if (sf, vocab_size) not in _MODELS:
        _MODELS[sf, vocab_size] = tk.train_bpe(tk.word_counts(table(spark, sf, "documents")), vocab_size)
    return _MODELS[sf, vocab_size]


@query("bpe_merges")
def bpe_merges(spark, sf):
    return _trained(spark, sf).merges_table(spark)


_SPECIAL_ROWS = ", ".join(f"({i}, '{t}', {str(t in tk.SPECIAL).lower()})" for i, t in enumerate(tk.ALL_SPECIAL))


@query(
    "special_token_counts",
    f"""WITH {_TAGGED}, {_rendered()}, t(token_id, token, special) AS (VALUES {_SPECIAL_ROWS})
SELECT token_id, token, special, sum((length(body) - length(replace(body, token, ''))) // length(token))::BIGINT AS n
FROM rendered, t GROUP BY ALL""",
)
def special_token_counts(spark, sf):
    m = F.col("conversations")
    rendered = fence(tagged(spark, sf), {"body": chat.render_chat(m, chat.offered_tools(m))}, ["conv_id"])
    found = rendered.select(F.explode(tk.pieces_with_specials(F.col("body"))).alias("token"))
    counts = found.filter(F.col("token").isin(*tk.ALL_SPECIAL)).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    tokens = tk.special_tokens(spark)
    return tokens.join(counts, "token", "left").select(
        "token_id", "token", "special", F.coalesce("n", F.lit(0)).alias("n")
    )


@query("encode_documents")
def encode_documents(spark, sf):
    model = _trained(spark, sf)
    coded = table(spark, sf, "documents").select("doc_id", "n_chars", tk.encode(F.col("text"), model).alias("ids"))
    return coded.select("doc_id", "n_chars", F.size("ids").alias("n_tokens"), _joined("ids").alias("ids_md5"))


@query(
    "encode_bytes",
    f"""WITH d AS (SELECT doc_id, text AS body FROM documents), {_byte_ids('d', 'doc_id')}
SELECT doc_id, len(ids)::INTEGER AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5 FROM coded""",
)
def encode_bytes(spark, sf):
    coded = table(spark, sf, "documents").select("doc_id", tk.encode(F.col("text"), BYTES).alias("ids"))
    return coded.select("doc_id", F.size("ids").alias("n_tokens"), _joined("ids").alias("ids_md5"))


@query("decode_documents", "SELECT doc_id, md5(text) AS text_md5, true AS same FROM documents")
def decode_documents(spark, sf):
    model = _trained(spark, sf)
    coded = table(spark, sf, "documents").select("doc_id", "text", tk.encode(F.col("text"), model).alias("ids"))
    back = coded.select("doc_id", "text", tk.decode(F.col("ids"), model).alias("decoded"))
    return back.select("doc_id", F.md5("decoded").alias("text_md5"), (F.col("text") == F.col("decoded")).alias("same"))


# ---- examples --------------------------------------------------------------------------------


def _padded(ids: str, length: int) -> str:
    cut = f"({ids})[1:{length}]"
    return f"list_resize({cut}, {length}, 0)"


@query(
    "pretrain_examples",
    f"""WITH d AS (SELECT doc_id, text AS body FROM documents), {_byte_ids('d', 'doc_id')},
f AS (SELECT doc_id, {_padded('list_concat([1], ids[1:510], [2])', 512)} AS x FROM coded)
SELECT doc_id, md5(array_to_string(x, ',')) AS input_md5,
  md5(array_to_string([CASE WHEN i = 0 THEN -100 ELSE i END FOR i IN x], ',')) AS labels_md5 FROM f""",
)
def pretrain_examples(spark, sf):
    coded = table(spark, sf, "documents").select("doc_id", tk.encode(F.col("text"), BYTES).alias("ids"))
    made = examples.pretrain_examples(coded, 512)
    return made.select("doc_id", _joined("input_ids").alias("input_md5"), _joined("labels").alias("labels_md5"))


def _mask(source: str, key: str, ids: str) -> str:
    """CTEs ending in ``masked(key, x, mask)``: a position counts when the last opening before it is
    later than the last closing completed before it."""
    bos, eos = examples.answer_marks(BYTES)

    def starts(sequence):
        return " AND ".join(f"lead(x, {i}, -1) OVER w = {t}" for i, t in enumerate(sequence))

    return f"""placed AS (SELECT {key}, generate_subscripts({ids}, 1) AS p, unnest({ids}) AS x FROM {source}),
flagged AS (
  SELECT {key}, p, x, {starts(bos)} AS opens, {starts(eos)} AS closes FROM placed
  WINDOW w AS (PARTITION BY {key} ORDER BY p)),
shifted AS (
  SELECT {key}, p, x, CASE WHEN lag(opens, {len(bos)}, false) OVER w THEN p END AS s,
    CASE WHEN lag(closes, {len(eos)}, false) OVER w THEN p - {len(eos)} END AS c
  FROM flagged WINDOW w AS (PARTITION BY {key} ORDER BY p)),
judged AS (
  SELECT {key}, p, x, (max(s) OVER w IS NOT NULL AND coalesce(max(c) OVER w, -1) < max(s) OVER w)::INTEGER AS m
  FROM shifted WINDOW w AS (PARTITION BY {key} ORDER BY p)),
masked AS (SELECT {key}, list(x ORDER BY p) AS x, list(m ORDER BY p) AS mask FROM judged GROUP BY {key})"""


_SFT = f"""{_TAGGED}, {_injected()},
{_rendered("(SELECT * FROM injected)")},
texts AS (SELECT conv_id, {_stripped('body', 'conv_id')} AS body FROM rendered), {_byte_ids('texts')},
padded AS (SELECT conv_id, {_padded('ids', 1024)} AS ids FROM coded), {_mask('padded', 'conv_id', 'ids')}"""


@query(
    "sft_examples",
    f"""WITH {_SFT}
SELECT conv_id, md5(array_to_string(x, ',')) AS input_md5,
  md5(array_to_string([CASE WHEN z[2] = 1 THEN z[1] ELSE -100 END FOR z IN list_zip(x, mask)], ',')) AS labels_md5 FROM masked""",
)
def sft_examples(spark, sf):
    made = examples.sft_examples(tagged(spark, sf), BYTES, 1024)
    return made.select("conv_id", _joined("input_ids").alias("input_md5"), _joined("labels").alias("labels_md5"))


@query(
    "span_labels",
    f"""WITH {_PLAIN}, {_rendered()}, {_byte_ids('rendered')}, {_mask('coded', 'conv_id', 'ids')}
SELECT conv_id, len(x)::INTEGER AS n_ids, list_sum(mask)::BIGINT AS n_answer FROM masked""",
)
def span_labels(spark, sf):
    rendered = fence(plain(spark, sf), {"t": chat.render_chat(F.col("conversations"))}, ["conv_id"])
    coded = fence(rendered.select("conv_id", tk.encode(F.col("t"), BYTES).alias("i")), {"ids": F.col("i")}, ["conv_id"])
    mask = chat.span_mask(F.col("ids"), *examples.answer_marks(BYTES))
    return coded.select(
        "conv_id", F.size("ids").alias("n_ids"), F.aggregate(mask, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_answer")
    )


def preference_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations ending on an answer, against the same one with the next conversation's answer."""
    convs = plain(spark, sf).withColumn("last", F.element_at("conversations", -1)).filter("last.role = 'assistant'")
    other = convs.select((F.col("conv_id") - 1).alias("conv_id"), F.col("last").alias("swap"))
    both = convs.join(other, "conv_id")
    rejected = F.concat(chat.without_last(F.col("conversations")), F.array("swap"))
    return both.select("conv_id", F.col("conversations").alias("chosen"), rejected.alias("rejected"))


_SIDES = """ends AS (SELECT conv_id, max(turn) AS lt, arg_max(role, turn) AS lr, arg_max(text, turn) AS lx FROM conversations GROUP BY conv_id),
pairs AS (SELECT a.conv_id, a.lt, b.lx FROM ends a JOIN ends b ON b.conv_id = a.conv_id + 1 WHERE a.lr = 'assistant' AND b.lr = 'assistant'),
sided AS (
  SELECT s.side || ':' || c.conv_id AS conv_id, c.turn, c.role,
    CASE WHEN s.side = 'rejected' AND c.turn = p.lt THEN p.lx ELSE c.text END AS content,
    '' AS reasoning, NULL::VARCHAR AS tools, '' AS calls
  FROM conversations c JOIN pairs p USING (conv_id), (VALUES ('chosen'), ('rejected')) s(side))"""


@query(
    "dpo_examples",
    f"""WITH {_SIDES}, {_rendered('sided')},
texts AS (SELECT conv_id, {_stripped('body', 'conv_id')} AS body FROM rendered), {_byte_ids('texts')},
padded AS (SELECT conv_id, {_padded('ids', 4096)} AS ids FROM coded), {_mask('padded', 'conv_id', 'ids')},
s AS (SELECT split_part(conv_id, ':', 1) AS side, split_part(conv_id, ':', 2)::BIGINT AS conv_id,
  md5(array_to_string(x[1:4095], ',')) AS xs, md5(array_to_string(x[2:4096], ',')) AS ys, md5(array_to_string(mask[2:4096], ',')) AS ms FROM masked)
SELECT conv_id, {', '.join(f"max({v}s) FILTER (side = '{s}') AS {n}_{s}" for s in ('chosen', 'rejected') for v, n in (('x', 'x'), ('y', 'y'), ('m', 'mask')))}
FROM s GROUP BY conv_id""",
)
def dpo_examples(spark, sf):
    made = examples.dpo_examples(preference_pairs(spark, sf), BYTES, 4096)
    return made.select("conv_id", *[_joined(c).alias(c) for c in made.columns if c != "conv_id"])


@query(
    "write_examples",
    f"""WITH d AS (SELECT doc_id, text AS body FROM documents), {_byte_ids('d', 'doc_id')},
f AS (SELECT doc_id, {_padded('list_concat([1], ids[1:126], [2])', 128)} AS x,
  row_number() OVER (ORDER BY md5('42:0:' || doc_id), doc_id) - 1 AS idx FROM coded)
SELECT (idx % 4)::INTEGER AS rank, idx // 16 AS batch_id, count(*) AS n, sum(list_sum(x))::BIGINT AS id_sum FROM f GROUP BY ALL""",
)
def write_examples(spark, sf):
    coded = table(spark, sf, "documents").select("doc_id", tk.encode(F.col("text"), BYTES).alias("ids"))
    made = batching.plan_batches(examples.pretrain_examples(coded, 128), 42, 0, 16)
    path = scratch_path(spark, "examples")
    sinks.write_examples(made, path, 4)
    total = F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + x)
    return spark.read.parquet(path).groupBy("rank", "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(total).alias("id_sum")
    )
