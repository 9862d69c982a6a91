"""Queries over response parsing, tool-call checks and rule rewards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.functions import chat, parse, score
from corpusflow.operators import rewards
from corpusflow.plans import sqlparts as q
from corpusflow.plans.chat_queries import plain
from corpusflow.plans.registry import query, table

# The event types stand for tools; one stays unknown and one is not offered to every sample.
SPECS = tuple(rewards.ToolSpec(n, ("k",)) for n in ("signup", "click", "view")) + (rewards.ToolSpec("error", (), ("k",)),)


def completions(spark: SparkSession, sf: str) -> DataFrame:
    """Responses built from events: one or two calls, some malformed or unclosed, some with thinking."""
    e, text = F.col("event_id"), F.col("value").cast("string")
    body = F.concat(F.lit('{"name": "'), F.col("event_type"), F.lit('", "arguments": '), F.col("props"), F.lit("}"))
    quoted = F.replace(F.col("props"), F.lit('"'), F.lit('\\"'))
    second = F.concat(F.lit('<tool_call>{"name": "click", "arguments": "'), quoted, F.lit('"}</tool_call>'))
    call = (
        F.when(e % 7 == 0, F.concat(F.lit("<tool_call>"), F.substring(body, F.lit(1), F.length(body) - 1), F.lit("</tool_call>")))
        .when(e % 11 == 0, F.concat(F.lit("<tool_call>"), body))
        .otherwise(F.concat(F.lit("<tool_call>\n"), body, F.lit("\n</tool_call>")))
    )
    think = F.concat(F.repeat(F.lit("weigh it "), (e % 45).cast("int")), F.lit("</think>\n"))
    response = F.concat(
        F.when(e % 3 == 0, F.concat(F.lit("<think>"), think)).when(e % 13 == 0, think).otherwise(F.lit("")),
        F.when(e % 2 == 0, call).otherwise(F.lit("")),
        F.when(e % 10 == 0, second).otherwise(F.lit("")),
        F.lit(" It is "), text, F.lit(", it is "), text, F.lit("."),
    )
    offered = F.when(F.col("user_id") % 2 == 0, F.array(*map(F.lit, ("signup", "click", "error", "purchase")))).otherwise(
        F.array(*map(F.lit, ("signup", "click", "view", "error", "purchase")))
    )
    expected = F.when(e % 4 == 0, F.array(text, F.col("event_type"))).otherwise(F.array(text, F.lit("99999"), text))
    return table(spark, sf, "events").select(
        "event_id", response.alias("response"), expected.alias("gt"), offered.alias("offered"),
        (e % 17 == 0).alias("unfinished"), ((e % 9 - 4) * 1.0).alias("scorer"),
    )


COMPLETIONS = """parts AS (
  SELECT *, '{"name": "' || event_type || '", "arguments": ' || props || '}' AS body,
    repeat('weigh it ', event_id % 45) || '</think>' || chr(10) AS think FROM events),
comp AS (
  SELECT event_id,
    CASE WHEN event_id % 3 = 0 THEN '<think>' || think WHEN event_id % 13 = 0 THEN think ELSE '' END
    || CASE WHEN event_id % 2 = 0 THEN
         CASE WHEN event_id % 7 = 0 THEN '<tool_call>' || left(body, length(body) - 1) || '</tool_call>'
              WHEN event_id % 11 = 0 THEN '<tool_call>' || body
              ELSE '<tool_call>' || chr(10) || body || chr(10) || '</tool_call>' END ELSE '' END
    || CASE WHEN event_id % 10 = 0 THEN '<tool_call>{"name": "click", "arguments": "' || replace(props, '"', chr(92) || '"') || '"}</tool_call>' ELSE '' END
    || ' It is ' || value::VARCHAR || ', it is ' || value::VARCHAR || '.' AS response,
    CASE WHEN event_id % 4 = 0 THEN [value::VARCHAR, event_type] ELSE [value::VARCHAR, '99999', value::VARCHAR] END AS gt,
    CASE WHEN user_id % 2 = 0 THEN ['signup', 'click', 'error', 'purchase'] ELSE ['signup', 'click', 'view', 'error', 'purchase'] END AS offered,
    event_id % 17 = 0 AS unfinished, (event_id % 9 - 4) * 1.0 AS scorer FROM parts)"""


def _calls_sql(source: str, text: str) -> str:
    """CTEs ending in ``calls(event_id, pos, name, args, decoded)``: well-formed calls only."""
    return f"""bodies AS (
  SELECT event_id, unnest(b) AS body, generate_subscripts(b, 1) - 1 AS pos
  FROM (SELECT event_id, regexp_extract_all({text}, '(?s)<tool_call>(.*?)</tool_call>', 1) AS b FROM {source})),
decoded AS (
  SELECT event_id, pos, json_extract_string(body, '$.name') AS name, json_extract(body, '$.arguments')::VARCHAR AS args,
    CASE WHEN json_type(body, '$.arguments') = 'VARCHAR' THEN json_extract_string(body, '$.arguments')
         ELSE json_extract(body, '$.arguments')::VARCHAR END AS inner_args
  FROM (SELECT * FROM bodies WHERE json_valid(body))),
calls AS (SELECT event_id, pos, name, args, inner_args AS decoded FROM decoded)"""


_AFTER = q.strip("CASE WHEN contains(response, '</think>') THEN substr(response, strpos(response, '</think>') + 8) ELSE response END")


@query(
    "parse_tool_calls",
    f"""WITH {COMPLETIONS}, {_calls_sql('comp', 'response')}
SELECT event_id, pos::INTEGER AS position, name, replace(replace(args, ' ', ''), ':', ': ') AS arguments,
  replace(replace(decoded, ' ', ''), ':', ': ') AS decoded FROM calls""",
)
def parse_tool_calls(spark, sf):
    found = completions(spark, sf).select("event_id", F.explode(parse.parse_tool_calls(F.col("response"))).alias("c"))
    spaced = {
        n: F.replace(F.replace(F.col(f"c.{n}"), F.lit(" "), F.lit("")), F.lit(":"), F.lit(": "))
        for n in ("arguments", "decoded")
    }
    return found.select("event_id", "c.position", "c.name", *[c.alias(n) for n, c in spaced.items()])


@query(
    "tool_calls_openai",
    f"""WITH {COMPLETIONS}, {_calls_sql('comp', 'response')}
SELECT event_id, string_agg('call_' || pos || ' ' || name, ',' ORDER BY pos) AS calls FROM calls GROUP BY event_id
UNION ALL SELECT event_id, NULL FROM comp WHERE event_id NOT IN (SELECT event_id FROM calls)""",
)
def tool_calls_openai(spark, sf):
    calls = parse.tool_calls_openai(F.col("response"))
    shown = completions(spark, sf).select("event_id", calls.alias("calls"))
    return shown.select(
        "event_id",
        F.array_join(F.transform("calls", lambda c: F.concat(c["id"], F.lit(" "), c["name"])), ",").alias("calls"),
    )


@query(
    "split_response",
    f"""WITH {COMPLETIONS},
r AS (SELECT event_id, response, regexp_matches(response, '(?s)<think>.*?</think>') AS closed, contains(response, '</think>') AS think FROM comp),
s AS (SELECT event_id,
  CASE WHEN closed THEN {q.strip("regexp_extract(response, '(?s)<think>(.*?)</think>', 1)")}
       WHEN think THEN {q.strip("split_part(response, '</think>', 1)")} END AS reasoning,
  CASE WHEN closed THEN regexp_replace(response, '(?s)<think>.*?</think>{q.SP}*', '', 'g')
       WHEN think THEN {q.strip("substr(response, strpos(response, '</think>') + 8)")} ELSE response END AS rest FROM r),
{_calls_sql('s', 'rest')},
n AS (SELECT event_id, count(*) AS n FROM calls GROUP BY event_id)
SELECT s.event_id, {q.strip("CASE WHEN n IS NULL THEN rest ELSE regexp_replace(rest, '(?s)<tool_call>.*?</tool_call>', '', 'g') END")} AS content,
  reasoning, coalesce(n, 0)::INTEGER AS n_calls, CASE WHEN n IS NULL THEN 'stop' ELSE 'tool_calls' END AS finish_reason
FROM s LEFT JOIN n USING (event_id)""",
)
def split_response(spark, sf):
    split = completions(spark, sf).select("event_id", parse.split_response(F.col("response")).alias("r"))
    return split.select(
        "event_id", "r.content", "r.reasoning",
        F.coalesce(F.size("r.tool_calls"), F.lit(0)).alias("n_calls"), "r.finish_reason",
    )


@query(
    "merge_deltas",
    "SELECT event_id, 'c' || event_id AS id, event_type AS name, props AS arguments FROM events",
)
def merge_deltas(spark, sf):
    """Each event's JSON arrives in pieces of four characters, its name with the first."""
    n = F.ceil(F.length("props") / 4).cast("int")
    seq = F.explode(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).alias("seq")
    cut = table(spark, sf, "events").select("event_id", "event_type", "props", seq)
    first = F.col("seq") == 0
    parts = cut.select(
        "event_id", "seq",
        F.when(first, F.concat(F.lit("c"), F.col("event_id").cast("string"))).alias("id"),
        F.when(first, F.col("event_type")).alias("name"),
        F.substring("props", F.col("seq") * 4 + 1, F.lit(4)).alias("arguments"),
    )
    return rewards.merge_deltas(parts, ["event_id"])


@query(
    "attach_tools",
    """WITH reg AS (SELECT event_type AS name, min(props) AS definition FROM events WHERE event_type <> 'purchase' GROUP BY 1),
n AS (SELECT event_id, unnest([event_type, 'click', 'purchase']) AS name, unnest([1, 2, 3]) AS pos FROM events)
SELECT event_id, string_agg(definition, '|' ORDER BY pos) AS tools, string_agg(DISTINCT CASE WHEN definition IS NULL THEN name END, ',') AS unknown
FROM n LEFT JOIN reg USING (name) GROUP BY event_id""",
)
def attach_tools(spark, sf):
    events = table(spark, sf, "events")
    registry = events.filter("event_type <> 'purchase'").groupBy(F.col("event_type").alias("name")).agg(
        F.min("props").alias("definition")
    )
    named = events.select("event_id", F.array("event_type", F.lit("click"), F.lit("purchase")).alias("tool_names"))
    found = rewards.attach_tools(named, registry, "event_id")
    return found.select("event_id", F.array_join("tools", "|").alias("tools"), F.array_join("unknown", ",").alias("unknown"))


_VALID = """(name IN ('signup', 'click', 'view', 'error') AND list_contains(offered, name)
  AND json_extract(decoded, '$.k') IS NOT NULL AND (name = 'error' OR json_extract(decoded, '$.k')::VARCHAR <> '0'))"""


@query(
    "validate_calls",
    f"""WITH {COMPLETIONS}, {_calls_sql('comp', 'response')}
SELECT event_id, count(name)::INTEGER AS n_calls, count(*) FILTER ({_VALID})::INTEGER AS n_valid
FROM comp LEFT JOIN calls USING (event_id) GROUP BY event_id""",
)
def validate_calls(spark, sf):
    parsed = completions(spark, sf).withColumn("calls", parse.parse_tool_calls(F.col("response")))
    return rewards.validate_calls(parsed, SPECS).select("event_id", "n_calls", "n_valid")


_REGISTERED = """(list_contains(offered, name) AND CASE name
  WHEN 'error' THEN json_extract(decoded, '$.k') IS NOT NULL
  WHEN 'signup' THEN json_extract(decoded, '$.k')::VARCHAR <> '0'
  WHEN 'view' THEN json_extract(decoded, '$.k')::VARCHAR <> '0' AND json_extract(decoded, '$.k')::BIGINT % 2 = 0
  ELSE false END)"""


@query(
    "validate_by_registry",
    f"""WITH {COMPLETIONS}, {_calls_sql('comp', 'response')}
SELECT event_id, count(name)::INTEGER AS n_calls, count(*) FILTER ({_REGISTERED})::INTEGER AS n_valid
FROM comp LEFT JOIN calls USING (event_id) GROUP BY event_id""",
)
def validate_by_registry(spark, sf):
    """Tools named by event types and sources; clicks declare a type that no call has, views an even number."""
    tool = F.col("name")
    kind = F.when(tool == "click", "string").otherwise("integer")
    needed = F.when(tool == "error", F.lit("[]")).otherwise(F.lit('["k"]'))
    schema = F.format_string('{"type": "object", "properties": {"k": {"type": "%s"}}, "required": %s}', kind, needed)
    names = table(spark, sf, "events").filter("event_type <> 'purchase'").select(F.col("event_type").alias("name")).unionByName(
        table(spark, sf, "documents").select(F.col("source").alias("name"))
    )
    listed = F.when(tool == "error", F.array(F.lit("k"))).otherwise(F.array().cast("array<string>"))
    registry = names.distinct().select("name", schema.alias("parameters_json"), listed.alias("not_null"))
    even = {"view": lambda v: F.try_variant_get(v, "$.k", "bigint") % 2 == 0}
    parsed = completions(spark, sf).withColumn("calls", parse.parse_tool_calls(F.col("response")))
    return rewards.validate_by_registry(parsed, registry, "event_id", predicates=even).select("event_id", "n_calls", "n_valid")


def _count(x: str, tag: str) -> str:
    return f"((length({x}) - length(replace({x}, '{tag}', ''))) // {len(tag)})"


_PENALTY = f"(abs({_count('ans', '<tool_call>')} - {_count('ans', '</tool_call>')}) * 0.5)"


@query(
    "tag_penalty", f"WITH {COMPLETIONS}, a AS (SELECT event_id, {_AFTER} AS ans FROM comp) SELECT event_id, {_PENALTY}::DOUBLE AS penalty FROM a"
)
def tag_penalty(spark, sf):
    turns = F.array(score.after_think(F.col("response")))
    return completions(spark, sf).select("event_id", score.tag_penalty(turns).alias("penalty"))


def _verified_sql(text: str, key: str = "event_id") -> str:
    """Expression: how many distinct expected answers ``text`` contains."""
    edge = r"[^\p{L}\p{N}_.]"
    numbers = rf"""regexp_extract_all(' ' || regexp_replace(replace({text}, ',', ''), '({edge})', '\1\1', 'g') || ' ',
      '{edge}([-+]?[0-9]+(?:\.[0-9]+)?){edge}', 1)"""
    return f"""len([g FOR g IN list_distinct(gt) IF contains(lower({text}), lower(g))
      OR (regexp_full_match(g, '[-+]?[0-9]+(\\.[0-9]+)?') AND len([n FOR n IN {numbers} IF abs(n::DOUBLE - try_cast(g AS DOUBLE)) < 1e-6]) > 0)])"""


@query(
    "verify_gt", f"WITH {COMPLETIONS} SELECT event_id, {_verified_sql('response')}::INTEGER AS n_found FROM comp"
)
def verify_gt(spark, sf):
    found = score.verify_gt(F.col("response"), F.col("gt"))
    return completions(spark, sf).select("event_id", F.size(found).alias("n_found"))


def _rep_sql(source: str, key: str, text: str) -> str:
    """CTE ``rep(key, rep)``: repetition penalty from three-grams of words and marks."""
    return f"""pieces AS (SELECT {key}, unnest(w) AS w, generate_subscripts(w, 1) AS p FROM (
  SELECT {key}, regexp_extract_all(lower({text}), '{q.WORD_OR_MARK}') AS w FROM {source})),
grams AS (SELECT {key}, w || chr(1) || lead(w, 1) OVER g || chr(1) || lead(w, 2) OVER g AS g3 FROM pieces
  WINDOW g AS (PARTITION BY {key} ORDER BY p)),
reps AS (SELECT {key}, least(0.5, (count(g3) - count(DISTINCT g3)) * 1.0 / count(g3)) AS r FROM grams GROUP BY {key} HAVING count(g3) > 0),
rep AS (SELECT s.{key}, coalesce(r, 0)::DOUBLE AS rep FROM {source} s LEFT JOIN reps USING ({key}))"""


@query("rep_penalty", f"WITH {_rep_sql('documents', 'doc_id', 'text')} SELECT doc_id, round(rep, 6) AS penalty FROM rep")
def rep_penalty(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(score.rep_penalty(F.col("text")), 6).alias("penalty"))


def _format_sql(text: str, low: int) -> str:
    body, head = q.strip(text), q.strip(f"split_part({text}, '</think>', 1)")
    return f"""(CASE WHEN length({body}) BETWEEN {low} AND 800 THEN 0.5 ELSE -0.5 END
  + CASE WHEN contains({text}, '</think>') THEN
      CASE WHEN length({head}) BETWEEN 20 AND 300 THEN 1.0 ELSE -0.5 END
      + CASE WHEN {_count(text, '</think>')} = 1 THEN 0.25 ELSE -0.25 END ELSE 0 END)"""


@query("format_score", f"WITH {COMPLETIONS} SELECT event_id, {_format_sql('response', 20)}::DOUBLE AS score FROM comp")
def format_score(spark, sf):
    return completions(spark, sf).select("event_id", score.format_score(F.col("response")).alias("score"))


@query(
    "rm_input",
    f"""WITH m AS (SELECT conv_id, turn, role, {q.strip("CASE WHEN role = 'assistant' THEN '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || ltrim(text, chr(10)) ELSE text END")} AS c FROM conversations),
h AS (SELECT conv_id, string_agg(role || ': ' || c, chr(10) ORDER BY turn) FILTER (turn < lt) AS history, arg_max(c, turn) AS last_query
  FROM m JOIN (SELECT conv_id, max(turn) AS lt FROM m GROUP BY conv_id) USING (conv_id) GROUP BY conv_id)
SELECT conv_id, CASE WHEN coalesce(history, '') <> '' THEN history || chr(10) || '{score.QUESTION_FRAME.strip()}' || chr(10) || last_query ELSE last_query END AS question
FROM h""",
)
def rm_input(spark, sf):
    prompts = plain(spark, sf).select("conv_id", chat.render_chat(F.col("conversations")).alias("prompt"))
    parsed = prompts.select("conv_id", chat.parse_chat(F.col("prompt")).alias("m"))
    return parsed.select("conv_id", score.rm_input(F.col("m")).alias("question"))


_CLIPPED = "greatest(least(scorer, 3), -3)"


@query(
    "chat_reward",
    f"""WITH {COMPLETIONS}, a AS (SELECT *, CASE WHEN contains(response, '</think>') THEN {_AFTER} ELSE response END AS ans FROM comp),
{_rep_sql('a', 'event_id', 'ans')}
SELECT event_id, round(({_format_sql('response', 20)} - rep + {_CLIPPED})::DOUBLE, 6) AS reward FROM a JOIN rep USING (event_id)""",
)
def chat_reward(spark, sf):
    scored = rewards.chat_reward(completions(spark, sf), scorer=F.col("scorer"))
    return scored.select("event_id", F.round("reward", 6).alias("reward"))


@query(
    "chat_reward_prompts",
    f"""WITH {COMPLETIONS}, a AS (SELECT *, CASE WHEN contains(response, '</think>') THEN {_AFTER} ELSE response END AS ans FROM comp),
{_rep_sql('a', 'event_id', 'ans')},
c AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 8 AS at FROM events),
p AS (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS at FROM customer)
SELECT c_custkey AS prompt_id, c_name AS prompt, event_id, round(({_format_sql('response', 20)} - rep + {_CLIPPED})::DOUBLE, 6) AS reward
FROM a JOIN rep USING (event_id) JOIN c USING (event_id) JOIN p ON p.at = c.at""",
)
def chat_reward_prompts(spark, sf):
    """Eight completions to each prompt, which two tables hold in the same order."""
    prompts = table(spark, sf, "customer").orderBy("c_custkey").select(F.col("c_custkey").alias("prompt_id"), F.col("c_name").alias("prompt"))
    paired = rewards.join_prompts(prompts, completions(spark, sf).orderBy("event_id"), 8)
    scored = rewards.chat_reward(paired, scorer=F.col("scorer"))
    return scored.select("prompt_id", "prompt", "event_id", F.round("reward", 6).alias("reward"))


_FINAL = "CASE WHEN unfinished THEN '' WHEN contains(ans, '</tool_call>') THEN list_last(string_split(ans, '</tool_call>')) ELSE ans END"


@query(
    "agent_reward",
    f"""WITH {COMPLETIONS}, a AS (SELECT *, {_AFTER} AS ans FROM comp), {_calls_sql('a', 'ans')},
n AS (SELECT event_id, count(name) AS n_calls, count(*) FILTER ({_VALID}) AS n_valid
  FROM a LEFT JOIN calls USING (event_id) GROUP BY event_id),
f AS (SELECT a.*, n_calls, n_valid, {_FINAL} AS final FROM a JOIN n USING (event_id)),
t AS (SELECT *, CASE WHEN n_calls = 0 THEN ans WHEN final <> '' THEN final ELSE ans END AS judged,
  abs(n_valid - len(gt)) + greatest(n_calls - n_valid, 0) AS gap FROM f),
{_rep_sql('t', 'event_id', 'judged')}
SELECT event_id, n_calls::INTEGER AS n_calls, n_valid::INTEGER AS n_valid, round(greatest(least((CASE WHEN n_calls = 0
  THEN {_format_sql('response', 5)} + {_CLIPPED} - rep
  ELSE CASE WHEN gap = 0 THEN 0.5 ELSE -0.5 * gap END + 2.5 * {_verified_sql('final')} / len(gt)
    - CASE WHEN unfinished THEN 0.5 ELSE 0 END - rep END - {_PENALTY})::DOUBLE, 3), -3), 6) AS reward
FROM t JOIN rep USING (event_id)""",
)
def agent_reward(spark, sf):
    runs = completions(spark, sf).withColumn("turns", F.array("response"))
    scored = rewards.agent_reward(runs, SPECS, scorer=F.col("scorer"))
    return scored.select("event_id", "n_calls", "n_valid", F.round("reward", 6).alias("reward"))
