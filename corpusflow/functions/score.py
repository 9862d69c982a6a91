"""Rule rewards over response text, all row-local column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusflow.functions.text import WORD, bind, occurrences, strip, words_and_marks

NUMBER = r"[-+]?[0-9]+(?:\.[0-9]+)?"
_EDGE = r"[\p{L}\p{N}_.]"

# Fixed value: the frame the scorer's question is put into when there is a history.
QUESTION_FRAME = "\n以上是对话历史。我的新问题是：\n"


def rep_penalty(text: Column, n: int = 3, cap: float = 0.5) -> Column:
    """Share of repeated ``n``-grams of words and marks, doubled and capped."""

    def penalty(pieces):
        count = F.size(pieces) - (n - 1)
        grams = F.transform(
            F.when(count > 0, F.sequence(F.lit(0), count - 1)),
            lambda i: F.concat_ws("\u0001", *[F.get(pieces, i + k) for k in range(n)]),
        )
        repeated = count - F.size(F.array_distinct(grams))
        return F.when(count > 0, F.least(F.lit(cap), repeated * (cap * 2) / count)).otherwise(F.lit(0.0))

    return bind(words_and_marks(F.lower(text)), penalty)


def _within(text: Column, low: int, high: int, good: float, bad: float) -> Column:
    return F.when(F.length(text).between(low, high), F.lit(good)).otherwise(F.lit(bad))


def think_head(text: Column) -> Column:
    return F.substring_index(text, "</think>", 1)


def after_think(text: Column) -> Column:
    """What follows the first closing think tag, or the whole text; trimmed."""
    tail = F.substring(text, F.length(think_head(text)) + len("</think>") + 1, F.length(text))
    return strip(F.when(F.contains(text, F.lit("</think>")), tail).otherwise(text))


def format_score(text: Column, min_len: int = 20) -> Column:
    """Length, thinking length and single-close-tag scores."""
    thinks = F.contains(text, F.lit("</think>"))
    thought = _within(strip(think_head(text)), 20, 300, 1.0, -0.5)
    single = F.when(occurrences(text, "</think>") == 1, F.lit(0.25)).otherwise(F.lit(-0.25))
    return _within(strip(text), min_len, 800, 0.5, -0.5) + F.when(thinks, thought + single).otherwise(F.lit(0.0))


def answer_text(text: Column) -> Column:
    """The text the repetition penalty and the scorer look at."""
    return F.when(F.contains(text, F.lit("</think>")), after_think(text)).otherwise(text)


def tag_penalty(turns: Column, tag: str = "tool_call") -> Column:
    """Half a point per unbalanced tag, summed over the turns."""
    gaps = F.transform(turns, lambda t: F.abs(occurrences(t, f"<{tag}>") - occurrences(t, f"</{tag}>")))
    return F.aggregate(gaps, F.lit(0), lambda a, x: a + x) * 0.5


def stand_alone_numbers(text: Column) -> Column:
    found = F.regexp_extract_all(
        F.replace(text, F.lit(","), F.lit("")), F.lit(f"(?<!{_EDGE})({NUMBER})(?!{_EDGE})"), F.lit(1)
    )
    return F.transform(found, lambda x: x.cast("double"))


def verify_gt(text: Column, expected: Column) -> Column:
    """Distinct expected answers found in the text, as words or as a stand-alone number."""

    def among(known):
        def found(g):
            wanted = strip(g)
            plain = F.replace(wanted, F.lit(","), F.lit(""))
            value = F.when(plain.rlike(f"^{NUMBER}$"), plain.try_cast("double"))
            literal = (F.length(wanted) > 0) & F.contains(known["lowered"], F.lower(wanted))
            numeric = F.exists(known["numbers"], lambda n: F.coalesce(F.abs(value - n) < 1e-6, F.lit(False)))
            return F.coalesce(literal | numeric, F.lit(False))

        return F.filter(F.array_distinct(expected), found)

    return bind(F.struct(F.lower(text).alias("lowered"), stand_alone_numbers(text).alias("numbers")), among)


def clip_score(score: Column, bound: float = 3.0) -> Column:
    return F.greatest(F.least(score, F.lit(bound)), F.lit(-bound))


def rm_input(messages: Column) -> Column:
    """The question put to a scorer: earlier turns as lines, then the last message in its frame."""
    last = F.size(messages) - 1
    history = F.array_join(
        F.transform(
            F.slice(messages, F.lit(1), F.greatest(last, F.lit(0))),
            lambda m: F.concat(m["role"], F.lit(": "), m["content"]),
        ),
        "\n",
    )
    query = F.coalesce(F.get(messages, last)["content"], F.lit(""))
    return F.when(history != "", F.concat(history, F.lit(QUESTION_FRAME), query)).otherwise(query)


def tool_gap_score(valid: Column, expected: Column, made: Column) -> Column:
    """Half a point for an exact match of calls and expectations, else minus half per gap."""
    gap = F.abs(valid - expected) + F.greatest(made - valid, F.lit(0))
    return F.when(gap == 0, F.lit(0.5)).otherwise(gap * -0.5)


def truthy(value: Column) -> Column:
    """Whether a JSON value counts as given: not null, false, zero or empty.

    Works on the value's JSON text, which tells the string "0" from the number 0.
    """
    zero = value.rlike(r"^-?0+(\.0+)?([eE][-+]?[0-9]+)?$")
    return value.isNotNull() & ~value.isin("null", "false", '""', "[]", "{}") & ~zero


__all__ = [
    "NUMBER", "WORD", "after_think", "answer_text", "clip_score", "format_score", "rep_penalty", "rm_input",
    "stand_alone_numbers", "tag_penalty", "think_head", "tool_gap_score", "truthy", "verify_gt",
]
