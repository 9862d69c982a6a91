"""What the pipeline's Python work leaves in a worker, and takes of a batch at a time."""

import gc
import tracemalloc
import weakref

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from corpusflow.functions import memory
from corpusflow.functions.portions import row_portions, text_portions
from corpusflow.llm import near_dups, toxicity, transducer

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_tables_of_the_encoder_go_when_a_worker_does_other_work():
    made = transducer.encoder(RANKS)
    ids = made.encode("some words, and sömé others")
    left = weakref.ref(made.pieces.transducer)
    del made
    assert transducer.encoder(RANKS).encode("some words, and sömé others") == ids and left() is not None  # kept between tasks
    batches = [pa.record_batch([pa.array(["x"])], ["text"])]
    assert list(memory.tidy(lambda some: some)(iter(batches))) == batches
    gc.collect()
    assert left() is None
    assert transducer.encoder(RANKS).encode("some words, and sömé others") == ids  # made anew
    memory.other_work()


def test_a_batch_of_long_texts_is_taken_in_portions():
    texts = pa.array(["1 " * 500_000] * 30 + [None])
    batch = pa.record_batch([texts, pa.array([1] * 31), pa.array([1.0] * 31)], ["text", "label", "weight"]).slice(0, 30)
    tracemalloc.start()
    try:
        toxicity.fit_rows(iter([batch]), toxicity.Training())
        assert tracemalloc.get_traced_memory()[1] < 10_000_000  # 30 MB of texts
    finally:
        tracemalloc.stop()


def test_portions_are_the_rows_in_order():
    texts = pa.array(["a" * 700, None, "é" * 600, "", "b" * 5000, "c"])
    parts = list(text_portions(texts, most=1000))
    assert [t for p in parts for t in p.to_pylist()] == texts.to_pylist() and len(parts) == 5
    assert list(text_portions(texts.slice(0, 0))) == []
    batch = pa.record_batch([pa.array([1, 2, 3, 4]), pa.array(["x" * 10, None, "y", "z"]), pa.array(["x", "u" * 9, None, "w"])], ["a", "s", "t"])
    assert [p.column(0).to_pylist() for p in row_portions(batch.slice(1), 1, 2, most=9)] == [[2], [3, 4]]


def test_rows_over_several_portions_give_what_they_give_alone(spark):
    texts = [f"Wörd{i} and more. " * 40_000 for i in range(4)] + [None, "", "an end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in transducer.with_round_trip(df, RANKS).collect()}
    alone = transducer.Encoder(transducer.read_ranks(RANKS))
    assert {i: r.ids for i, r in got.items()} == {i: alone.encode(t) if t else [] for i, t in enumerate(texts)}
    assert {i: r.decoded for i, r in got.items()} == {i: t or "" for i, t in enumerate(texts)}
    scores = toxicity.with_toxicity(df, toxicity.no_model()).agg(F.count("score"), F.max("score")).first()
    assert scores[0] == 7 and scores[1] < 0.01
    twice = df.unionByName(df.withColumn("doc_id", F.col("doc_id") + 10)).coalesce(1)
    near = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dups.near_duplicates(twice).collect()}
    assert near == {i + k: (n, c if c is not None else i + k) for i, t in enumerate(texts) for k in (0, 10) for n, c in [(3 if i < 4 else int(bool(t)), i if t else None)]}
