import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers

from corpusflow.functions import chat
from corpusflow.functions.portions import portions
from corpusflow.operators import examples, rollouts, tokenizer as tk
from corpusflow.plans.registry import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return table(spark, SF, "documents").select("doc_id", "text")


@pytest.fixture(scope="module")
def model(spark, texts):
    return tk.train_bpe(tk.word_counts(texts), 380)


@pytest.fixture(scope="module")
def public(texts):
    """The public tokenizers library, trained on the same texts."""
    public = Tokenizer(models.BPE())
    public.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    public.decoder = decoders.ByteLevel()
    trainer = trainers.BpeTrainer(
        vocab_size=380, initial_alphabet=pre_tokenizers.ByteLevel.alphabet(), special_tokens=list(tk.ALL_SPECIAL), show_progress=False
    )
    public.train_from_iterator([r.text for r in texts.collect()], trainer)
    return public


def test_special_ids():
    assert len(tk.ALL_SPECIAL) == tk.N_SPECIAL and len(tk.SPECIAL) == 21
    assert (tk.ALL_SPECIAL[0], tk.ALL_SPECIAL[1], tk.ALL_SPECIAL[2]) == ("<|endoftext|>", "<|im_start|>", "<|im_end|>")


def test_merges_equal_one_at_a_time_training(model, public):
    vocabulary = public.get_vocab()
    assert len(model.tokens) == len(vocabulary) == 380
    by_id = {i: t for t, i in vocabulary.items()}
    shown = {by_id[i]: bytes([b]) for b, i in enumerate(tk.BYTE_IDS)}
    for token, i in vocabulary.items():
        if i >= tk.N_SPECIAL:
            assert b"".join(shown[c] for c in token) == model.tokens[i]


SAMPLES = [
    "Hello, it's 2024!  Two  spaces\n\nand lines", "naïve café — 北京 \U0001f600", " lead and trail ", "<|im_start|>assistant\nHi <|im_end|>\n",
    "a <think>b</think>", "\t\ttabs", "", "don't we'll they're I'd", "x   \n  y", "100% <tool_call>{}</tool_call>",
]


def test_encoding_equals_the_public_library(spark, model, public):
    df = spark.createDataFrame(list(enumerate(SAMPLES)), "i int, t string")
    got = [list(r.ids) for r in df.select("i", tk.encode(F.col("t"), model).alias("ids")).orderBy("i").collect()]
    assert got == [public.encode(s).ids for s in SAMPLES]


def test_round_trip(spark, model):
    df = spark.createDataFrame(list(enumerate(SAMPLES)), "i int, t string").withColumn("ids", tk.encode(F.col("t"), model))
    back = df.select("i", "t", tk.decode(F.col("ids"), model).alias("d")).collect()
    assert all(r.t == r.d for r in back)


def test_encoding_runs_as_one_arrow_stage(spark, model, texts):
    plan = texts.select(tk.encode(F.col("text"), model))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_long_discounted_sums_do_not_underflow(spark):
    n, c = 20_000, 0.95
    df = spark.range(n).select(
        F.lit(1).alias("sample_id"), F.col("id").cast("int").alias("pos"),
        F.when(F.col("id") == n - 1, 5.0).otherwise(0.0).alias("token_reward"), ((F.col("id") % 11) / 10.0).alias("value"),
    )
    rows = {r.pos: r for r in rollouts.gae(df).collect()}
    # Every advantage is its own error plus the discounted next one; the last is its error alone.
    worst = max(
        abs(rows[t].advantage - (rows[t + 1].value - rows[t].value + c * rows[t + 1].advantage)) for t in range(n - 1)
    )
    assert worst < 1e-9 and abs(rows[n - 1].advantage - (5.0 - rows[n - 1].value)) < 1e-12


def test_top_p_keeps_the_crossing_candidate_and_the_best(spark):
    df = spark.createDataFrame([("a", "x", 2.0), ("a", "y", 1.0), ("a", "z", 0.0), ("b", "w", 9.0)], "k string, token string, logit double")
    kept = {(r.k, r.token) for r in rollouts.top_p(df, ["k"], 0.7, min_rows=1).collect()}
    assert kept == {("a", "x"), ("a", "y"), ("b", "w")}
    ties = spark.createDataFrame([("a", "x", 2.0), ("a", "y", 1.0), ("a", "z", 1.0)], "k string, token string, logit double")
    assert rollouts.top_k(ties, ["k"], 2).count() == 3


def test_pretrain_labels_ignore_every_pad(spark):
    df = spark.createDataFrame([([5, 0, 6],), ([7] * 9,)], "ids array<int>")
    rows = examples.pretrain_examples(df, 8).collect()
    assert rows[0].input_ids == [1, 5, 0, 6, 2, 0, 0, 0] and rows[0].labels == [1, 5, -100, 6, 2, -100, -100, -100]
    assert rows[1].input_ids == [1, 7, 7, 7, 7, 7, 7, 2]


def test_a_partition_gives_one_row_per_pair(spark):
    words = ["aab", "aaaa", "ba", "x", "\u00e9a"] * 30
    state = spark.createDataFrame([("".join(tk._symbol(i) for i in w.encode()), k + 1) for k, w in enumerate(words)], "s string, n long")
    rows = tk._pairs(state.filter(F.length("s") > 1).coalesce(1)).collect()
    want = {}
    for k, w in enumerate(words):
        for pair in zip(w.encode(), w.encode()[1:]):
            want[pair] = want.get(pair, 0) + k + 1
    assert {tuple(ord(c) - tk._SYMBOLS for c in r.p): r.n for r in rows} == want and len(rows) == len(want)


def test_portions_are_bounded_and_whole():
    rows = [[1, 2], None, [], [3] * 9, [4], [5, 6, 7], None]
    lists = pa.array([[0], *rows], pa.list_(pa.int32())).slice(1)
    cut = list(portions(lists, 4))
    assert pa.concat_arrays(cut).to_pylist() == rows
    assert all(len(p.flatten()) <= 4 or len(p) == 1 for p in cut) and len(cut) == 3
    assert [len(p) for p in portions(lists.slice(0, 0))] == [0]


def test_long_batches_are_taken_in_portions(spark, monkeypatch):
    taken = []
    whole = tk.portions

    def watched(lists):
        return whole(lists, 5)

    monkeypatch.setattr(tk, "portions", watched)
    monkeypatch.setattr(chat, "portions", watched)
    monkeypatch.setattr(chat, "_inside", lambda lists, *marks, f=chat._inside: taken.append(len(lists.flatten())) or f(lists, *marks))
    lists = pa.array([[1, 9, 1, 9, 2], None, [1], [9, 9, 2, 9], []], pa.list_(pa.int32()))
    spans = chat.span_mask.__globals__["_span_udf"]([1], [2], lambda ids, inside: inside)
    assert spans.func(lists).to_pylist() == [[0, 1, 1, 1, 1], None, [0], [0, 0, 0, 0], []]
    assert max(taken) <= 5 and len(taken) > 1
