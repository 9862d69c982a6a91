import json
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import chat, parse, score, text as tx
from corpusflow.operators import rewards, schema_ops
from corpusflow.schemas import MESSAGES


def column(spark, values, fn, dtype="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {dtype}")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


CLEANED = {
    "": "",
    "  ": "",
    "plain": "plain",
    "a\tb": "a b",
    "a \u00a0\u3000 b": "a b",
    "line\r\nnext": "line \nnext",
    "x\u0000y\u0007z": "xyz",
    "e\u0301 o\u0308": "\u00e9 \u00f6",
    "\u1100\u1161 \uac00\u11a8": "\uac00 \uac01",
    "emoji \U0001f600  end\n\n": "emoji \U0001f600 end",
    "\u2003em\u2028sep": "em sep",
    "\n a \n b \n": "a \n b",
    "tab\t\ttab": "tab tab",
    "\u212b and \u2126": "\u00c5 and \u03a9",
    "1\x1c2": "12",
    "\x85next\x85": "next",
}


def test_clean_text_follows_the_rule_and_is_idempotent(spark):
    once = column(spark, list(CLEANED), tx.clean_text)
    assert once == list(CLEANED.values())
    assert column(spark, once, tx.clean_text) == once


def test_cleaning_leaves_null_alone(spark):
    assert column(spark, [None, "a"], tx.clean_text) == [None, "a"]


def test_letters_that_skip_python_cannot_change():
    ranges = re.findall(r"\\x\{([0-9A-F]+)\}-\\x\{([0-9A-F]+)\}", tx.MAY_COMPOSE)
    safe = {c for a, b in ranges for c in range(int(a, 16), int(b, 16) + 1)}
    assert all(unicodedata.normalize("NFC", chr(c)) == chr(c) and not unicodedata.combining(chr(c)) for c in safe)
    seconds = set()
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            seconds.add(int(parts[1], 16))
    assert not seconds & safe


def message(role, content=None, reasoning=None, tools=None, calls=None):
    return (role, content, reasoning, tools, calls)


def render(spark, messages, **options):
    df = spark.createDataFrame([(messages,)], f"m {MESSAGES.simpleString()}")
    tools = chat.offered_tools(F.col("m"))
    return df.select(chat.render_chat(F.col("m"), tools, **options).alias("o")).first().o


def test_consecutive_tool_turns_share_one_user_turn(spark):
    out = render(spark, [message("user", "q"), message("tool", "a"), message("tool", "b"), message("assistant", "c")])
    assert out == (
        "<|im_start|>user\nq<|im_end|>\n<|im_start|>user\n<tool_response>\na\n</tool_response>\n<tool_response>\nb\n"
        "</tool_response><|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\nc<|im_end|>\n"
    )


def test_reasoning_is_taken_from_its_field_or_from_the_content(spark):
    out = render(spark, [message("assistant", "<think>\nwhy\n</think>\n\nso"), message("assistant", "a</think>b", "\nr\n")])
    assert "<think>\nwhy\n</think>\n\nso<|im_end|>" in out and "<think>\nr\n</think>\n\na</think>b<|im_end|>" in out


def test_tool_calls_keep_key_order_and_text_arguments(spark):
    calls = '[{"name": "f", "arguments": {"b": 1, "a": "é"}}, {"function": {"name": "g", "arguments": "{\\"x\\":1}"}}]'
    out = render(spark, [message("assistant", "", calls=calls)])
    assert '</think>\n\n<tool_call>\n{"name": "f", "arguments": {"b": 1, "a": "é"}}\n</tool_call>\n<tool_call>' in out
    assert '{"name": "g", "arguments": {"x":1}}\n</tool_call><|im_end|>' in out


def test_tools_header_and_generation_prompt(spark):
    tools = json.dumps([{"z": 1, "a": 2}])
    out = render(spark, [message("system", "be brief", tools=tools), message("user", None)], generation_prompt=True)
    assert out.startswith("<|im_start|>system\nbe brief\n\n# Tools\n") and '\n<tools>\n{"z": 1, "a": 2}\n</tools>' in out
    assert out.endswith("<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\n")
    assert render(spark, [message("user", "x")], generation_prompt=True, open_thinking=True).endswith("assistant\n<think>\n")


def test_rendered_messages_read_back(spark):
    out = render(spark, [message("system", "s"), message("user", " u\nv ")])
    df = spark.createDataFrame([(out,)], "t string")
    back = df.select(chat.parse_chat(F.col("t")).alias("m")).first().m
    assert [(m.role, m.content) for m in back] == [("system", "s"), ("user", "u\nv")]


@pytest.mark.parametrize(
    "ids,mask",
    [
        ([], []),
        ([1, 7], [0, 0]),
        ([1, 7, 5, 2, 9, 1, 7, 6], [0, 0, 1, 1, 1, 0, 0, 1]),
        ([1, 7, 1, 7, 5, 2, 9, 4], [0, 0, 1, 1, 1, 1, 1, 0]),
        ([2, 9, 1, 7, 2], [0, 0, 0, 0, 1]),
        ([5, 1, 7, 2, 9, 2, 9, 1, 7], [0, 0, 0, 1, 1, 0, 0, 0, 0]),
    ],
)
def test_span_mask(spark, ids, mask):
    df = spark.createDataFrame([(ids,)], "x array<int>")
    assert df.select(chat.span_mask(F.col("x"), [1, 7], [2, 9]).alias("m")).first().m == mask


def test_spans_of_a_batch_stay_in_their_arrays(spark):
    rng = random.Random(4)
    rows = [[rng.choice([1, 7, 2, 9, 5]) for _ in range(rng.randrange(9))] for _ in range(300)] + [None, [], [1], [7], [5, 1, 7], [2], [9, 5]]

    def brute(ids):
        out = [0] * len(ids)
        for p in range(len(ids) - 1):
            if ids[p : p + 2] == [1, 7]:
                end = next((e + 2 for e in range(p + 2, len(ids) - 1) if ids[e : e + 2] == [2, 9]), len(ids))
                out[p + 2 : end] = [1] * (end - p - 2)
        return out

    df = spark.createDataFrame(list(enumerate(rows)), "i int, x array<int>").coalesce(1)
    both = df.select("i", "x", chat.span_mask(F.col("x"), [1, 7], [2, 9]).alias("m"), chat.span_labels(F.col("x"), [1, 7], [2, 9], -100).alias("l"))
    for r in both.collect():
        assert r.m == (None if r.x is None else brute(r.x)), r.x
        assert r.l == (None if r.x is None else [v if m else -100 for v, m in zip(r.x, r.m)])


def test_span_mask_refuses_ambiguous_marks():
    with pytest.raises(ValueError):
        chat.span_mask(F.col("x"), [1, 2], [2, 1])


CALLS = [
    ('<tool_call>{"name": "f", "arguments": {"a": 1}}</tool_call>', 1),
    ('<tool_call>{"name": "f"} junk</tool_call>', 0),
    ("<tool_call>{'name': 'f'}</tool_call>", 0),
    ("<tool_call>\n{\"name\": \"f\"}\n</tool_call> x <tool_call>bad</tool_call><tool_call>{}</tool_call>", 2),
    ("<tool_call>{}", 0),
    ("none", 0),
]


def test_tool_calls_are_read_strictly(spark):
    found = column(spark, [t for t, _ in CALLS], parse.parse_tool_calls)
    assert [len(f) for f in found] == [n for _, n in CALLS]
    assert [c.position for c in found[3]] == [0, 2]


def test_string_arguments_are_decoded(spark):
    bad = '<tool_call>{"name": "f", "arguments": "oops"}</tool_call>'
    good = '<tool_call>{"name": "f", "arguments": "{\\"a\\": 0}"}</tool_call>'
    found = column(spark, [bad, good], parse.parse_tool_calls)
    assert [f[0].decoded for f in found] == ["{}", '{"a": 0}'] and found[0][0].arguments == '"oops"'


TRUTH = ['""', '"0"', "0", "0.0", "1", "false", "true", "null", "[]", "[0]", "{}", '{"a": 1}', '"x"', "-0", "1e-9"]


def test_arguments_count_as_given_like_python_values(spark):
    spec = (rewards.ToolSpec("f", ("v",)), rewards.ToolSpec("g", (), ("v",)))
    texts = [f'<tool_call>{{"name": "{n}", "arguments": {{"v": {v}}}}}</tool_call>' for n in "fg" for v in TRUTH]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select(
        "i", parse.parse_tool_calls(F.col("t")).alias("calls"), F.array(F.lit("f"), F.lit("g")).alias("offered")
    )
    got = [r.n_valid for r in rewards.validate_calls(df, spec).orderBy("i").collect()]
    assert got[: len(TRUTH)] == [int(bool(json.loads(v))) for v in TRUTH]
    assert got[len(TRUTH) :] == [int(json.loads(v) is not None) for v in TRUTH]


def test_split_response(spark):
    texts = ["<think>a</think>\n b", "a </think> b", "x", '<think>t</think><tool_call>{"name": "f"}</tool_call> y']
    got = column(spark, texts, parse.split_response)
    assert [(r.reasoning, r.content, r.finish_reason) for r in got] == [
        ("a", "b", "stop"), ("a", "b", "stop"), (None, "x", "stop"), ("t", "y", "tool_calls"),
    ]


def test_repetition_penalty(spark):
    expected = {
        "": 0.0,
        "a b": 0.0,
        "a b c": 0.0,
        "a b c d a b c": 0.2,  # one of five three-grams repeats
        "a b c a b c a b c": 0.5,  # four of seven, capped
        "\u00dcn\u00ef \u00dcn\u00ef \u00fcn\u00ef \u00dcN\u00cf": 0.5,
        "!? !? !?": 0.5,
        "x y, x y, z": 0.2,  # seven pieces, commas included: one of five repeats
    }
    assert column(spark, list(expected), score.rep_penalty) == pytest.approx(list(expected.values()))


def test_verified_answers(spark):
    cases = [
        # "234" counts because it occurs as text; "23.5" occurs neither as text nor as a number.
        ("It is 1,234.5 now", ["1234.5", "1,234.50", "234", "23.5"], 3), ("v2.0 x3", ["2.0", "3"], 2), ("a -5 b", ["-5.0", "5.0"], 1),
        ("PARIS", ["paris", "", None], 1), ("7 7", ["7", "7"], 1), ("3.14.", ["3.140"], 0),
    ]
    df = spark.createDataFrame([(i, t, g) for i, (t, g, _) in enumerate(cases)], "i int, t string, g array<string>")
    got = [r.n for r in df.select("i", F.size(score.verify_gt(F.col("t"), F.col("g"))).alias("n")).orderBy("i").collect()]
    assert got == [n for _, _, n in cases]


def test_schema_renames_and_required_fields(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), (None, None)], "content string, text string")
    named = schema_ops.normalize_schema(df, "pretrain")
    assert named.columns == ["text"] and sorted(r.text for r in schema_ops.validate_schema(named, "pretrain").collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        schema_ops.validate_schema(df.select("content"), "pretrain", strict=True)
    assert schema_ops.detect_kind(df) == "pretrain"
