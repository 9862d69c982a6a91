"""SQL fragments shared by the oracle statements (DuckDB dialect)."""

SP = r"[\p{Z}\t-\r\x{1c}-\x{1f}\x{85}]"
BLANK = r"[\p{Z}\t\r\x{1c}-\x{1f}\x{85}]"
WORD = r"[\p{L}\p{N}_]+"
WORD_OR_MARK = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\p{Z}\t-\r\x{1c}-\x{1f}\x{85}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SP}+|{SP}+$', '', 'g')"


def clean(x: str) -> str:
    composed = rf"regexp_replace(nfc_normalize({x}), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g')"
    return strip(f"regexp_replace({composed}, '{BLANK}+', ' ', 'g')")


def n_pieces(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{WORD_OR_MARK}'))"


def uniform(key: str, seed: int, salt: str) -> str:
    return f"(('0x' || substr(md5('{seed}:{salt}:' || {key}), 1, 8))::BIGINT / 4294967296.0)"


# Text with the kinds of dirt cleaning removes: a decomposed letter, odd blanks, controls.
DIRTY = "(chr(9) || 'e' || chr(769) || chr(160) || chr(12288) || text || chr(13) || chr(10) || chr(7) || ' ')"

CONVERSATIONS = """convs AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'content': text} ORDER BY turn) AS msgs
  FROM conversations GROUP BY conv_id)"""


def fingerprints(source: str) -> str:
    """CTEs ending in ``prints(doc_id, fp)`` over ``source(doc_id, text)``."""
    return f"""tok AS (
  SELECT doc_id, unnest([w FOR w IN string_split_regex(text, '{SP}+') IF w <> '']) AS w FROM {source}),
hashed AS (SELECT doc_id, ('0x' || substr(md5(w), 17, 16))::UBIGINT AS h, count(*) AS c FROM tok GROUP BY 1, 2),
votes AS (
  SELECT doc_id, b, sum(CASE WHEN (h >> b::UBIGINT) & 1 = 1 THEN c ELSE -c END) AS s
  FROM hashed, range(64) AS r(b) GROUP BY 1, 2),
raw AS (
  SELECT doc_id, sum(CASE WHEN s > 0 THEN 1::HUGEINT << b::HUGEINT ELSE 0 END)::HUGEINT AS u FROM votes GROUP BY 1),
prints AS (
  SELECT d.doc_id, (CASE WHEN coalesce(u, 0) >= 9223372036854775808 THEN u - 18446744073709551616
                    ELSE coalesce(u, 0) END)::BIGINT AS fp
  FROM {source} d LEFT JOIN raw USING (doc_id))"""


# After prints: kept(doc_id) by scanning distinct fingerprints in order of their first row.
GREEDY = """firsts AS (SELECT fp, min(doc_id) AS doc_id FROM prints GROUP BY fp),
ordered AS (SELECT row_number() OVER (ORDER BY doc_id) AS rn, fp, doc_id FROM firsts),
scan AS (
  SELECT 0::BIGINT AS rn, []::BIGINT[] AS kept
  UNION ALL
  SELECT o.rn, CASE WHEN len([k FOR k IN s.kept IF bit_count(xor(k, o.fp)) <= 3]) = 0
               THEN list_append(s.kept, o.fp) ELSE s.kept END
  FROM scan s JOIN ordered o ON o.rn = s.rn + 1),
kept AS (
  SELECT doc_id FROM firsts WHERE fp IN (
    SELECT unnest(kept) FROM scan WHERE rn = (SELECT max(rn) FROM scan)))"""
