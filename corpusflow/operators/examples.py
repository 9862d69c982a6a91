"""Training examples from texts and conversations: ids, labels, preference sides, prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.functions import chat
from corpusflow.functions.fence import fence
from corpusflow.functions.skew import ordered_index, with_lookback
from corpusflow.functions.text import hash_uniform
from corpusflow.operators.tokenizer import BOS, EOS, PAD, BpeModel, encode

IGNORE = -100


def pad_to(ids: Column, length: int) -> Column:
    """Cut to ``length`` and fill with pads on the right."""
    cut = F.slice(ids, 1, length)
    return F.concat(cut, F.array_repeat(F.lit(PAD), F.lit(length) - F.size(cut)))


def pretrain_examples(df: DataFrame, max_length: int = 512, ids: str = "ids") -> DataFrame:
    """Replace ``ids`` by ``input_ids`` between begin and end marks, and ``labels`` that ignore pads."""
    marked = F.concat(F.array(F.lit(BOS)), F.slice(F.col(ids), 1, max_length - 2), F.array(F.lit(EOS)))
    framed = df.withColumn("input_ids", pad_to(marked, max_length))
    labels = F.transform("input_ids", lambda x: F.when(x == PAD, F.lit(IGNORE)).otherwise(x))
    return framed.withColumn("labels", labels).drop(ids)


def answer_marks(model: BpeModel) -> tuple[list[int], list[int]]:
    """Id sequences that open and close an assistant turn."""
    return model.ids_of([chat.START, "assistant", "\n"]), model.ids_of([chat.END, "\n"])


def span_labels(df: DataFrame, model: BpeModel, ids: str = "input_ids") -> DataFrame:
    """Add ``labels``: the ids inside assistant turns, everything else ignored."""
    return df.withColumn("labels", chat.span_labels(F.col(ids), *answer_marks(model), IGNORE))


def sft_text(messages: Column, key: Column, ratio: float = 0.2, keep: float = 0.2, seed: int = 42, with_calls: bool = True) -> Column:
    """Rendered chat with a system prompt injected into some and empty thinking dropped from most."""
    injected = chat.inject_system(messages, key, ratio, seed)
    tools = chat.offered_tools(messages)
    return chat.strip_empty_think(chat.render_chat(injected, tools, with_calls=with_calls), key, keep, seed)


def sft_examples(
    df: DataFrame, model: BpeModel, max_length: int = 1024, key: str = "conv_id", seed: int = 42, **ratios
) -> DataFrame:
    text = sft_text(F.col("conversations"), F.col(key), seed=seed, **ratios)
    coded = fence(df, {"_text": text}, [key]).select(key, encode(F.col("_text"), model).alias("_ids"))
    return span_labels(fence(coded, {"input_ids": pad_to(F.col("_ids"), max_length)}, [key]), model)


def dpo_examples(
    df: DataFrame, model: BpeModel, max_length: int = 4096, key: str = "conv_id", seed: int = 42, keep: float = 0.2
) -> DataFrame:
    """Shifted ids and answer masks of the chosen and the rejected side."""
    sides = ("chosen", "rejected")

    def text(side):
        draw = F.concat(F.lit(f"{side}:"), F.col(key).cast("string"))
        return chat.strip_empty_think(chat.render_chat(F.col(side)), draw, keep, seed)

    out = fence(df, {s: text(s) for s in sides}, [key])
    out = out.select(key, *[encode(F.col(s), model).alias(s) for s in sides])
    out = fence(out, {s: pad_to(F.col(s), max_length) for s in sides})
    marks = answer_marks(model)
    out = out.withColumns({f"mask_{s}": chat.span_mask(F.col(s), *marks) for s in sides})
    shifted = {}
    for s in sides:
        shifted[f"x_{s}"] = F.slice(s, 1, max_length - 1)
        shifted[f"y_{s}"] = F.slice(s, 2, max_length - 1)
        shifted[f"mask_{s}"] = F.slice(f"mask_{s}", 2, max_length - 1)
    return out.select(key, *[c.alias(n) for n, c in shifted.items()])


def rlaif_prompts(
    df: DataFrame, thinking_ratio: float = 0.5, ratio: float = 0.2, key: str = "conv_id", seed: int = 42
) -> DataFrame:
    """Prompts that end on the generation mark; the last message of each conversation is left out."""
    injected = chat.inject_system(F.col("conversations"), F.col(key), ratio, seed)
    thinking = hash_uniform(F.col(key), seed, "thinking") < thinking_ratio
    prompt = chat.render_chat(
        chat.without_last(injected), generation_prompt=True, open_thinking=thinking
    )
    return df.select(key, prompt.alias("prompt"), F.lit("").alias("answer"))


def agent_samples(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """Messages without the last, the offered tools, and the expected answers."""
    conv = F.col("conversations")
    return df.select(key, chat.without_last(conv).alias("messages"), chat.offered_tools(conv).alias("tools"), "gt")


def history_context(
    df: DataFrame, n: int, include_current: bool = False, key: str = "conv_id", turn: str = "turn", min_rows: int = 200_000
) -> DataFrame:
    """Per turn, the messages a client would send: the last ``n`` before it, then the turn itself.

    With ``include_current`` the turn counts within ``n``. The frame is bounded, and hot
    conversations are cut into blocks, so no task holds a whole conversation.
    """
    before = max(n - 1, 0) if include_current else n
    indexed = ordered_index(df, [key], [turn], min_rows)
    rows, own = with_lookback(indexed, before, max(min_rows, before + 1))
    frame = Window.partitionBy(key, "_block").orderBy("_idx").rowsBetween(-before, 0)
    framed = rows.withColumn("context", F.collect_list(F.struct("role", "text")).over(frame))
    return framed.filter(own).drop("_block", "_idx", "_n")
