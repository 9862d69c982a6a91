"""Chat markup as column functions: rendering messages, reading them back, marking answer spans."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from corpusflow.functions.portions import portions
from corpusflow.functions.text import SPACE, bind, hash_uniform, hex_long, strip

# The chat markup.
START, END = "<|im_start|>", "<|im_end|>"
THINK, END_THINK = "<think>", "</think>"
EMPTY_THINK = "<think>\n\n</think>\n\n"
TOOLS_INTRO = (
    "# Tools\n\nYou may call one or more functions to assist with the user query.\n\n"
    "You are provided with function signatures within <tools></tools> XML tags:\n<tools>"
)
TOOLS_OUTRO = (
    "\n</tools>\n\nFor each function call, return a json object with function name and arguments "
    "within <tool_call></tool_call> XML tags:\n<tool_call>\n"
    '{"name": <function-name>, "arguments": <args-json-object>}\n</tool_call><|im_end|>\n'
)

# The system prompts to draw from; ``{name}`` is the assistant's name.
SYSTEM_PROMPTS = (
    "你是一个知识丰富的AI，尽力为用户提供准确的信息。",
    "你是{name}，一个小巧但有用的语言模型。",
    "你是一个专业的AI助手，请提供有价值的回答。",
    "你是{name}，请尽力帮助用户解决问题。",
    "你是一个可靠的AI，请给出准确的回答。",
    "You are a helpful AI assistant.",
    "You are {name}, a lightweight intelligent assistant.",
    "You are a friendly chatbot. Please answer the user's questions carefully.",
    "You are a knowledgeable AI. Try your best to provide accurate information.",
    "You are {name}, a small but useful language model.",
)


def system_prompts(name: str = "assistant") -> list[str]:
    return [p.replace("{name}", name) for p in SYSTEM_PROMPTS]


_CALLS = T.ArrayType(
    T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("arguments", T.StringType())]))
)
_CALLS_ARROW = pa.list_(pa.list_(pa.struct([("name", pa.string()), ("arguments", pa.string())])))


def _dump(value) -> str:
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _loaded(text: str):
    """The JSON value; null if it is malformed or nested too deeply, so one bad row does not end a job."""
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return None


@F.arrow_udf(_CALLS)
def _decode_calls(lists: pa.Array) -> pa.Array:
    """Raw tool-call JSON per message to (name, arguments) text; key order is kept."""

    def one(raw):
        found = []
        calls = _loaded(raw) if raw else []
        for call in calls if isinstance(calls, list) else []:
            call = (call.get("function") or call) if isinstance(call, dict) else None
            if not isinstance(call, dict):
                continue
            found.append({"name": _dump(call.get("name", "")), "arguments": _dump(call.get("arguments", {}))})
        return found

    rows = [None if row is None else [one(raw) for raw in row] for row in lists.to_pylist()]
    return pa.array(rows, _CALLS_ARROW)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _dump_each(texts: pa.Array) -> pa.Array:
    """A JSON list as one JSON text per element."""
    rows = [
        None if (found := None if text is None else _loaded(text)) is None
        else [json.dumps(x, ensure_ascii=False) for x in (found if isinstance(found, list) else [found])]
        for text in texts.to_pylist()
    ]
    return pa.array(rows, pa.list_(pa.string()))


def _trim_feeds(text: Column, left: bool = True, right: bool = True) -> Column:
    sides = [p for p, wanted in ((r"^\n+", left), (r"\n+\z", right)) if wanted]
    return F.regexp_replace(text, "|".join(sides), "")


def has_tools(messages: Column) -> Column:
    return F.exists(messages, lambda m: F.coalesce(F.length(m["tools"]) > 0, F.lit(False)))


def starts_with_system(messages: Column) -> Column:
    return F.coalesce(F.get(messages, F.lit(0))["role"] == "system", F.lit(False))


def inject_system(
    messages: Column, key: Column, ratio: float = 0.2, seed: int = 42, name: str = "assistant"
) -> Column:
    """Prepend one of the system prompts to a share of the tool-free, system-free conversations."""
    prompts = F.array(*[F.lit(p) for p in system_prompts(name)])
    pick = hex_long(F.substring(F.md5(F.concat(F.lit(f"{seed}:prompt:"), key.cast("string"))), 1, 8))
    nothing = F.lit(None).cast("string")
    system = F.struct(
        F.lit("system").alias("role"),
        F.get(prompts, (pick % len(SYSTEM_PROMPTS)).cast("int")).alias("content"),
        nothing.alias("reasoning_content"),
        nothing.alias("tools"),
        nothing.alias("tool_calls"),
    )
    chosen = ~has_tools(messages) & ~starts_with_system(messages) & (hash_uniform(key, seed, "system") < ratio)
    return F.when(chosen, F.concat(F.array(system), messages)).otherwise(messages)


def offered_tools(messages: Column) -> Column:
    """Raw tools JSON of the last system message that carries one, else null."""
    holders = F.filter(
        messages, lambda m: (m["role"] == "system") & F.coalesce(F.length(m["tools"]) > 0, F.lit(False))
    )
    return F.get(holders, F.size(holders) - 1)["tools"]


def without_last(messages: Column) -> Column:
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))


def render_chat(
    messages: Column,
    tools: Column | None = None,
    generation_prompt: bool = False,
    open_thinking: Column | bool = False,
    with_calls: bool = True,
) -> Column:
    """Messages as chat markup. ``tools`` is a raw JSON list; ``with_calls=False`` skips tool calls."""
    none = F.array().cast(_CALLS)
    calls = none
    if with_calls:
        raw = F.transform(messages, lambda m: m["tool_calls"])
        present = F.exists(messages, lambda m: F.coalesce(F.length(m["tool_calls"]) > 0, F.lit(False)))
        calls = F.coalesce(_decode_calls(F.when(present, raw)), none)
    listed = F.lit(False) if tools is None else F.coalesce(F.json_array_length(tools) > 0, F.lit(False))

    def turn(role, body):
        return F.concat(F.lit(START), role, F.lit("\n"), body, F.lit(f"{END}\n"))

    def answer(m, content, made):
        given = m["reasoning_content"].isNotNull()
        inline = ~given & F.contains(content, F.lit(END_THINK))
        before = _trim_feeds(F.substring_index(content, END_THINK, 1), left=False)
        reasoning = F.when(given, m["reasoning_content"]).when(
            inline, F.substring_index(before, THINK, -1)
        ).otherwise(F.lit(""))
        rest = F.when(inline, _trim_feeds(F.substring_index(content, END_THINK, -1), right=False)).otherwise(content)
        mine = F.transform(
            made,
            lambda c: F.concat(
                F.lit('<tool_call>\n{"name": "'), c["name"], F.lit('", "arguments": '),
                c["arguments"], F.lit("}\n</tool_call>"),
            ),
        )
        gap = F.when((F.length(rest) > 0) & (F.size(mine) > 0), F.lit("\n")).otherwise(F.lit(""))
        body = F.concat(
            F.lit(f"{THINK}\n"), _trim_feeds(reasoning), F.lit(f"\n{END_THINK}\n\n"),
            _trim_feeds(rest, right=False), F.coalesce(F.concat(gap, F.array_join(mine, "\n")), F.lit("")),
        )
        return turn(m["role"], body)

    def observation(content, before, after):
        return F.concat(
            F.when(before, F.lit("")).otherwise(F.lit(f"{START}user")),
            F.lit("\n<tool_response>\n"), content, F.lit("\n</tool_response>"),
            F.when(after, F.lit("")).otherwise(F.lit(f"{END}\n")),
        )

    def piece(all_pairs):
        def is_tool(i):
            return F.coalesce(F.get(all_pairs, i)["m"]["role"] == "tool", F.lit(False))

        def one(pair, i):
            m = pair["m"]
            content = F.coalesce(m["content"], F.lit(""))
            return (
                F.when((m["role"] == "system") & (i == 0) & listed, F.lit(""))
                .when(m["role"].isin("user", "system"), turn(m["role"], content))
                .when(m["role"] == "assistant", answer(m, content, pair["calls"]))
                .when(m["role"] == "tool", observation(content, is_tool(i - 1), is_tool(i + 1)))
                .otherwise(F.lit(""))
            )

        return F.transform(all_pairs, one)

    # Python columns may feed a lambda's arrays but not appear inside the lambda.
    pairs = F.zip_with(messages, calls, lambda m, c: F.struct(m.alias("m"), c.alias("calls")))
    body = F.array_join(bind(pairs, piece), "")
    if tools is not None:
        lead = F.when(
            starts_with_system(messages),
            F.concat(F.coalesce(F.get(messages, F.lit(0))["content"], F.lit("")), F.lit("\n\n")),
        ).otherwise(F.lit(""))
        header = F.concat(
            F.lit(f"{START}system\n"), lead, F.lit(TOOLS_INTRO),
            F.array_join(F.transform(_dump_each(tools), lambda t: F.concat(F.lit("\n"), t)), ""), F.lit(TOOLS_OUTRO),
        )
        body = F.concat(F.when(listed, header).otherwise(F.lit("")), body)
    if generation_prompt:
        thinking = open_thinking if isinstance(open_thinking, Column) else F.lit(open_thinking)
        body = F.concat(
            body, F.lit(f"{START}assistant\n"),
            F.when(thinking, F.lit(f"{THINK}\n")).otherwise(F.lit(EMPTY_THINK)),
        )
    return body


def strip_empty_think(text: Column, key: Column, keep: float = 0.2, seed: int = 42) -> Column:
    """Drop empty think blocks from all but a ``keep`` share of the texts."""
    return F.when(
        hash_uniform(key, seed, "think") > keep, F.replace(text, F.lit(EMPTY_THINK), F.lit(""))
    ).otherwise(text)


def parse_chat(prompt: Column) -> Column:
    """Chat markup back to ``array<struct<role, content>>``; tool turns are not messages of their own."""
    pattern = F.lit(rf"(?s)<\|im_start\|>(system|user|assistant){SPACE}+(.*?)<\|im_end\|>")
    roles = F.regexp_extract_all(prompt, pattern, F.lit(1))
    contents = F.regexp_extract_all(prompt, pattern, F.lit(2))
    return F.zip_with(
        roles, contents, lambda r, c: F.struct(r.alias("role"), strip(c).alias("content"))
    )


def _marked(ids: np.ndarray, ends_at: np.ndarray, sequence: list[int]) -> np.ndarray:
    """Places right after an occurrence of ``sequence``; ``ends_at`` is where each place's array ends."""
    found = np.ones(max(len(ids) - len(sequence), 0), bool)
    for k, one in enumerate(sequence):
        found &= ids[k : len(ids) - len(sequence) + k] == one
    after = np.flatnonzero(found) + len(sequence)
    return after[after < ends_at[after - len(sequence)]]


def _inside(lists: pa.ListArray, bos: list[int], eos: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The arrays' ids one after the other, which of them lie in spans, and where the arrays begin and end.

    Both marks are matched in one go over the batch: a place is inside if the last opening that has ended
    by then is in its array, and later than the start of the last closing that has.
    """
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.concatenate([[0], sizes]))
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    begin, stop = np.repeat(ends[:-1], sizes), np.repeat(ends[1:], sizes)
    opened, closed = np.full(len(ids), -1), np.full(len(ids), -1)
    after = _marked(ids, stop, bos)
    opened[after] = after
    after = _marked(ids, stop, eos)
    closed[after] = after - len(eos)
    if len(ids):
        opened, closed = np.maximum.accumulate(opened), np.maximum.accumulate(closed)
    return ids, (opened >= begin) & (closed < opened), ends


def _span_udf(bos: list[int], eos: list[int], give: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Callable[[Column], Column]:
    """A function of an id array, which ``give`` makes from the ids and their being inside of spans.

    The opening id of each sequence must occur only at its start, as special ids do; then spans cannot overlap.
    """
    if bos[0] in bos[1:] + eos or eos[0] in eos[1:] + bos:
        raise ValueError("bos and eos sequences must open with ids that occur nowhere else in them")

    def of_portion(lists: pa.Array) -> pa.Array:
        ids, inside, ends = _inside(lists, bos, eos)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(give(ids, inside).astype(np.int32)), mask=lists.is_null())

    @F.arrow_udf("array<int>")
    def spans(lists: pa.Array) -> pa.Array:
        return pa.concat_arrays([of_portion(part) for part in portions(lists)])

    return spans


def span_mask(ids: Column, bos: list[int], eos: list[int]) -> Column:
    """1 from after each ``bos`` through the next ``eos`` (or the end of the array), else 0; null for null."""
    return _span_udf(bos, eos, lambda _, inside: inside)(ids)


def span_labels(ids: Column, bos: list[int], eos: list[int], ignore: int) -> Column:
    """The ids within spans as of :func:`span_mask`, and ``ignore`` elsewhere."""
    return _span_udf(bos, eos, lambda ids, inside: np.where(inside, ids, ignore))(ids)
