"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpus_pipeline import ORACLE_SQL, run
from corpusflow.llm.alignment import with_alignment
from corpusflow.llm.exact_dups import exact_duplicates
from corpusflow.llm.leaks import with_leaks
from corpusflow.llm.mixing import with_slots
from corpusflow.llm.near_dups import MinHash, near_duplicates
from corpusflow.llm.repeats import repeated_passages
from corpusflow.llm.tables import table, whole_text
from corpusflow.llm.token_counts import with_token_counts
from corpusflow.llm.tool_calls import SCHEMAS, calls_from_conversations, link_tool_calls
from corpusflow.llm.toxicity import held_out, train, with_toxicity
from corpusflow.llm.transducer import with_round_trip
from corpusflow.llm.trie import conversation_trie, numbered_turns, rebuilt
from corpusflow.llm.url_templates import Rule, path_of, url_verdicts
from corpusflow.llm.weighted_prints import fingerprints

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query(
    "op1_near_dedup",
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
        FROM documents
    ), shingles AS (
        SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
            WHEN len(w) = 1 THEN [w[1]]
            ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s
        FROM words
    ), sizes AS (SELECT doc_id, count(*) AS n, list(s) AS l FROM shingles GROUP BY doc_id),
    common AS (SELECT s, count(*) AS f FROM shingles GROUP BY s),
    -- Sets that reach the threshold share one of the rarest n - ceil(0.8 n) + 1 shingles of each.
    ranked AS (
        SELECT doc_id, s, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS r FROM shingles JOIN common USING (s)
    ), rare AS (SELECT doc_id, s, n FROM ranked JOIN sizes USING (doc_id) WHERE r <= n - ceil(0.8 * n) + 1),
    candidates AS (
        SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM rare a JOIN rare b ON a.s = b.s AND a.doc_id <> b.doc_id
        WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    ), shared AS (
        SELECT a, b, x.n AS na, y.n AS nb, len(list_intersect(x.l, y.l)) AS k
        FROM candidates JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    ), links AS (SELECT a, b FROM shared WHERE 100 * k >= 80 * (na + nb - k)
    ), reach(a, b) AS (
        SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    ), roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM roots LEFT JOIN sizes USING (doc_id)
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), p=MinHash(shingle=2))


@query(
    "op2_exact_dedup",
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(text) AS text_sha256
    FROM d JOIN g USING (text)
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query("op3_weighted_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


@query(
    "op4_repeated_passages",
    """
    WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    h AS (SELECT doc_id, n, hex(b) AS x FROM d),
    pieces AS (SELECT doc_id, n, x, unnest(range(0, n - 99, 1000)) AS base FROM h WHERE n >= 100),
    short AS (SELECT doc_id, base, substr(x, 2 * base + 1, 2198) AS y FROM pieces),
    starts AS (SELECT doc_id, base, y, unnest(range(0, least(1000, len(y) // 2 - 99))) AS o FROM short),
    windows AS (SELECT doc_id, base + o AS p, md5_number(substr(y, 2 * o + 1, 200)) AS w FROM starts),
    firsts AS (SELECT w, min((doc_id, p)) AS f FROM windows GROUP BY w HAVING count(*) > 1),
    late AS (SELECT doc_id, p FROM windows JOIN firsts USING (w) WHERE (doc_id, p) > f
    ), runs AS (
        SELECT doc_id, p, p > max(p) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 100 AS gap
        FROM late
    ), numbered AS (SELECT doc_id, p, sum(coalesce(gap, true)::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM runs),
    spans AS (SELECT doc_id, run, min(p) AS s, max(p) + 100 AS e FROM numbered GROUP BY doc_id, run),
    ordered AS (SELECT doc_id, s, e, lead(s) OVER (PARTITION BY doc_id ORDER BY s) AS next FROM spans),
    cut AS (
        SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans, min(s) AS first,
            string_agg(substr(x, 2 * e + 1, 2 * (coalesce(next, n) - e)), '' ORDER BY s) AS rest
        FROM ordered JOIN h USING (doc_id) GROUP BY doc_id
    )
    SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
        sha256(CASE WHEN n_spans IS NULL THEN unhex(x) ELSE unhex(substr(x, 1, 2 * first) || rest) END) AS kept_sha256
    FROM h LEFT JOIN cut USING (doc_id)
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    changed = repeated_passages(docs).select(
        F.col("doc_id").alias("changed_id"),
        "version",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    whole = docs.select(
        "doc_id",
        F.xxhash64("text").alias("whole_version"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2("text", 256).alias("whole_sha256"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("changed_id")) & (F.col("whole_version") == F.col("version"))
    return whole.join(changed, same, "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = with_token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
    both = with_round_trip(docs, ranks)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return with_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("sentences").alias("n_offending")
    )


@query(
    "op8_mix_sources",
    """
    WITH RECURSIVE s AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    e AS (SELECT source, n, round(sqrt(n) / sum(sqrt(n)) OVER () * (1000 - count(*) OVER ()), 9) AS exact FROM s),
    r AS (
        SELECT source, floor(exact) AS whole, row_number() OVER (ORDER BY exact - floor(exact) DESC, n DESC, source) AS rank,
            1000 - count(*) OVER () - sum(floor(exact)) OVER () AS spare
        FROM e
    ), p AS (SELECT source, (1 + whole + (rank <= spare)::INT)::BIGINT AS parts FROM r),
    l AS (SELECT list(source ORDER BY source) AS names, list(parts ORDER BY source) AS ps FROM p),
    edf(t, n, pick) AS (
        SELECT -1, list_transform(ps, lambda x: 0), 0 FROM l
        UNION ALL
        SELECT t + 1, n, coalesce(list_min(list_filter(list_transform(n, lambda k, i:
            CASE WHEN floor(k * 1000 / ps[i]) <= t + 1 THEN ceil((k + 1) * 1000 / ps[i])::BIGINT * 100000 + i END),
            lambda x: x IS NOT NULL)) % 100000, 0)::INT
        FROM (SELECT t, list_transform(n, lambda k, i: k + (i = pick)::INT) AS n, ps FROM edf, l WHERE t < 999)
    ), slots AS (
        SELECT names[pick] AS source, ps[pick] AS parts, t AS in_cycle,
            row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS within
        FROM edf, l WHERE pick > 0
    ), d AS (
        SELECT doc_id, source, parts, row_number() OVER (PARTITION BY source ORDER BY md5('0:' || doc_id), doc_id) - 1 AS place
        FROM documents JOIN p USING (source)
    )
    SELECT doc_id, d.source, place // 8 AS block, place // 8 // d.parts * 1000 + in_cycle AS slot,
        place // 8 // d.parts * 1000 + floor(within * 1000 / d.parts)::BIGINT AS released,
        place // 8 // d.parts * 1000 + ceil((within + 1) * 1000 / d.parts)::BIGINT AS due, place
    FROM d JOIN slots ON slots.source = d.source AND slots.within = place // 8 % d.parts
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_slots(table(spark, sf_dir, "documents").select("doc_id", "source"))


# The rules of the filter's contract.
URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def _tree_level(k: int) -> str:
    """One level of the path-template tree: children of wide nodes become a wildcard."""
    return f"""t{k} AS (
        SELECT t.* EXCLUDE (template), CASE WHEN len(shape) < {k} THEN t.template
            ELSE list_append(t.template, CASE WHEN children > 30 THEN '*' ELSE shape[{k}] END) END AS template
        FROM t{k - 1} t LEFT JOIN (
            SELECT host, template, count(DISTINCT shape[{k}]) AS children FROM t{k - 1} WHERE len(shape) >= {k} GROUP BY host, template
        ) w ON w.host = t.host AND w.template = t.template
    )"""


def _branch_level(k: int) -> str:
    """One level of the tree that verdicts come from: children that differ from the rest of their node, or a wildcard."""
    return f"""c{k} AS (
        SELECT * EXCLUDE (open), CASE WHEN open THEN shape[{k}] END AS child, open AS was,
            sum(n) OVER c AS nc, sum(k) OVER c AS kc, sum(n) OVER p AS np, sum(k) OVER p AS kp
        FROM b{k - 1} WINDOW c AS (PARTITION BY host, branch, open, shape[{k}]), p AS (PARTITION BY host, branch, open)
    ), s{k} AS (
        SELECT * EXCLUDE (branch), CASE WHEN NOT was THEN branch ELSE list_append(branch, CASE WHEN np > nc AND
            abs((kc + 20.0::DOUBLE * kp / np) / (nc + 20.0::DOUBLE) - (kp - kc) / (np - nc))
            > 4 * sqrt(kp / np * (1 - kp / np) * (1 / (nc + 20.0::DOUBLE) + 1 / (np - nc))) THEN child ELSE '*' END) END AS branch FROM c{k}
    ), b{k} AS (
        SELECT host, shape, template, n, k, branch,
            was AND len(shape) > {k} AND sum(k) OVER g > 0 AND sum(k) OVER g < sum(n) OVER g AS open
        FROM s{k} WINDOW g AS (PARTITION BY host, branch, was)
    )"""


_URL_SQL = f"""
    WITH b AS (
        SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ), c AS (
        SELECT *, list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''),
            lambda x: regexp_replace(x, '[0-9]+', '*', 'g')) AS parts FROM b
    ), d AS (
        SELECT page_id, host, path, list_concat(CASE WHEN len(parts) > 4 THEN list_append(parts[1:4], '**') ELSE parts END,
            CASE WHEN path LIKE '%/' THEN [''] ELSE [] END) AS shape FROM c
    ), m AS (
        SELECT host, shape, (quality = 1 AND toxic = 0)::INT AS good
        FROM d JOIN labels ON doc_id = try_cast(regexp_extract(path, '/([0-9]+)[^/]*/?$', 1) AS BIGINT)
    ), t0 AS (
        SELECT host, shape, []::VARCHAR[] AS template, coalesce(n, 0) AS n, coalesce(k, 0) AS k
        FROM (SELECT DISTINCT host, shape FROM d) LEFT JOIN (SELECT host, shape, count(*) AS n, sum(good) AS k FROM m GROUP BY ALL)
        USING (host, shape)
    ), {", ".join(map(_tree_level, range(1, 5)))},
    shapes AS (SELECT host, shape, list_concat(template, shape[5:]) AS template, n, k FROM t4),
    b0 AS (SELECT *, []::VARCHAR[] AS branch, len(shape) > 0 AND sum(k) OVER g > 0 AND sum(k) OVER g < sum(n) OVER g AS open
        FROM shapes WINDOW g AS (PARTITION BY host)),
    {", ".join(map(_branch_level, range(1, 6)))},
    v AS (SELECT host, shape, (sum(k) OVER g + 20.0::DOUBLE * mean) / (sum(n) OVER g + 20.0::DOUBLE) AS purity
        FROM b5, (SELECT coalesce(sum(k) / nullif(sum(n), 0), 1.0) AS mean FROM shapes) WINDOW g AS (PARTITION BY host, branch)),
    rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
        ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
    fit AS (
        SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
        FROM d JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
    )
    SELECT page_id, host, path, rule, coalesce(fit.verdict, CASE WHEN purity < 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
        '/' || array_to_string(template, '/') AS template, purity
    FROM d JOIN shapes USING (host, shape) JOIN v USING (host, shape) LEFT JOIN fit USING (page_id)
"""


@query("op9_url_filter", _URL_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # The last number in a page's path is the document that the page shows; labels are known for some.
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]+)[^/]*/?$", 1)
    shown = pages.select("url", number.try_cast("long").alias("doc_id"))
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")
    labelled = shown.join(table(spark, sf_dir, "labels"), "doc_id").select("url", good.alias("good"))
    return url_verdicts(pages, URL_RULES, labelled)


@query("op10_tool_calls")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = calls_from_conversations(table(spark, sf_dir, "conversations"))
    return link_tool_calls(calls, results, SCHEMAS)


@query(
    "op11_prefix_trie",
    r"""
    WITH o AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
        FROM conversations WHERE conv_id IS NOT NULL
    ), n AS (SELECT conv_id, count(*) AS n FROM o GROUP BY conv_id),
    -- CRC-32 of the digits: a byte is mixed in, then come eight steps.
    c AS (
        SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(
            list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 9 AS h
        FROM n
    ), r AS (
        SELECT c.conv_id, i AS d, role, text FROM c JOIN o ON o.conv_id = base AND i <= h
        UNION ALL
        SELECT c.conv_id, i - h + least(h, coalesce(n.n, 0)) AS d, role, text
        FROM c JOIN o USING (conv_id) LEFT JOIN n ON n.conv_id = base WHERE i > h
    ), p AS (
        SELECT conv_id, d, octet_length(encode(text)) AS bytes,
            md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY d)) AS k FROM r
    ), m AS (
        SELECT conv_id, 0 AS d, 0 AS bytes, '' AS k FROM c UNION ALL SELECT conv_id, d, bytes, k FROM p
    ), q AS (
        SELECT *, lag(k) OVER w AS parent, lead(d) OVER w IS NULL AS ends FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY d)
    ), nodes AS (
        SELECT k, d, min(conv_id) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs, any_value(bytes) AS bytes,
            string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends) AS ids
        FROM q GROUP BY k, d
    ), kids AS (SELECT parent AS k, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
    known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
    sums AS (
        SELECT q.k, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * known.bytes) AS saved
        FROM known JOIN q ON q.conv_id = known.conv_id AND q.d <= known.d GROUP BY q.k
    )
    SELECT x.conv_id, x.d::BIGINT AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves::BIGINT AS n_leaves,
        saved::BIGINT AS saved_tokens, sha256(coalesce(x.ids, '')) AS ends_sha256
    FROM known x JOIN sums USING (k) LEFT JOIN nodes y ON y.k = x.parent
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(*rebuilt(numbered_turns(table(spark, sf_dir, "conversations"))))


@query(
    "op12_decontamination",
    r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    ), b AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
    ), s AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
    p AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM s),
    windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM p),
    q AS (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d, (SELECT DISTINCT n FROM windows)),
    hits AS (SELECT doc_id, i, q.n, item_id FROM q JOIN windows ON windows.n = q.n AND x = array_to_string(w[i:i + q.n - 1], ' ')),
    words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_leaks(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_alignment(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("pipeline", ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
