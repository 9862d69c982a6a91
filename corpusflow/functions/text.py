"""Column functions over text: cleaning, views, word pieces, reproducible uniforms."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

# Character classes written out, so that every regex engine reads them alike.
BLANK = r"[\p{Z}\t\r\x{1c}-\x{1f}\x{85}]"
SPACE = r"[\p{Z}\t-\r\x{1c}-\x{1f}\x{85}]"
WORD = r"[\p{L}\p{N}_]+"
WORD_OR_MARK = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\p{Z}\t-\r\x{1c}-\x{1f}\x{85}]"
# Runs that are not already one plain space.
BLANK_RUN = rf"{BLANK}{{2,}}|[{BLANK[1:-1]}&&[^ ]]"
SPACES = "".join(
    map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"

# Text made only of these characters is already in composed form, so it never leaves the JVM.
MAY_COMPOSE = (
    r"[^\x{0}-\x{2FF}\x{400}-\x{482}\x{48A}-\x{52F}\x{2010}-\x{2027}\x{2030}-\x{205E}"
    r"\x{3001}-\x{3029}\x{3041}-\x{3096}\x{30A1}-\x{30FA}\x{3400}-\x{9FFF}\x{AC00}-\x{D7A3}"
    r"\x{FF01}-\x{FF60}]"
)


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    An expression used inside a lambda is otherwise computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _composed(texts: pa.Array) -> pa.Array:
    # Arrow's own utf8_normalize does not compose, so the standard library does it.
    done = [None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()]
    return pa.array(done, pa.string())


@F.arrow_udf(T.StringType())
def _compose(texts: pa.Array) -> pa.Array:
    return _composed(texts)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _compose_each(lists: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(lists), 0)
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes).cast(pa.int32())])
    return pa.ListArray.from_arrays(offsets, _composed(lists.flatten()), mask=lists.is_null())


def nfc(text: Column) -> Column:
    """Canonical composition. Python sees only the rows that could change."""
    return F.coalesce(_compose(F.when(text.rlike(MAY_COMPOSE), text)), text)


def nfc_each(texts: Column) -> Column:
    """Canonical composition of every string of an array, under the same bypass."""
    needed = F.exists(texts, lambda t: F.coalesce(t.rlike(MAY_COMPOSE), F.lit(False)))
    return F.coalesce(_compose_each(F.when(needed, texts)), texts)


def strip(text: Column) -> Column:
    """Trim every kind of white space, line breaks included, from both ends."""
    return F.btrim(text, F.lit(SPACES))


def tidy(text: Column) -> Column:
    """The JVM part of cleaning: drop controls, one blank per run, keep line feeds, trim."""
    text = F.regexp_replace(text, CONTROL, "")
    return strip(F.regexp_replace(text, BLANK_RUN, " "))


def clean_text(text: Column) -> Column:
    return tidy(nfc(text))


def clean_conversations(messages: Column) -> Column:
    """Clean ``content`` and ``reasoning_content`` of every message, row-local."""
    content = nfc_each(F.transform(messages, lambda m: m["content"]))
    reasoning = nfc_each(F.transform(messages, lambda m: m["reasoning_content"]))
    # Python columns may feed a lambda's arrays but not appear inside the lambda, hence the zips.
    messages = F.zip_with(messages, content, lambda m, c: m.withField("content", tidy(c)))
    return F.zip_with(messages, reasoning, lambda m, r: m.withField("reasoning_content", tidy(r)))


def text_view(column: Column, dtype: T.DataType, mode: str = "join") -> Column:
    """Text of a column of any type: lists joined by one space, or dumped as JSON."""
    if isinstance(dtype, T.StringType):
        return column
    if isinstance(dtype, T.ArrayType) and mode == "join":
        nested = isinstance(dtype.elementType, (T.StructType, T.ArrayType, T.MapType))
        return F.array_join(
            F.transform(column, lambda x: F.to_json(x) if nested else x.cast("string")), " "
        )
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(column)
    return column.cast("string")


def tokens(text: Column) -> Column:
    """Non-empty pieces between white space."""
    return F.filter(F.split(text, rf"{SPACE}+"), lambda w: w != "")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def words_and_marks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD_OR_MARK})"), F.lit(1))


def occurrences(text: Column, tag: str) -> Column:
    """How often the literal ``tag`` occurs in ``text``."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(tag), F.lit("")))) / len(tag)).cast("int")


def hex_long(digits: Column) -> Column:
    """Up to 16 hexadecimal digits as a signed long."""
    return F.conv(digits, 16, -10).cast("long")


def hash_uniform(key: Column, seed: int, salt: str) -> Column:
    """Reproducible uniform in [0, 1) from the row key; independent of partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{salt}:"), key.cast("string")))
    return hex_long(F.substring(digest, 1, 8)) / F.lit(4294967296.0)


def shuffle_key(key: Column, seed: int, epoch: int = 0) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{epoch}:"), key.cast("string")))
