import json

import pytest
from pyspark.sql import functions as F

from corpusflow.plans.registry import table
from corpusflow.sources import readers
from corpusflow.schemas import SCHEMAS
from corpusflow.streaming import jobs

SF = "/root/testdata/sf0.001"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "b.jsonl").write_text('{"content": "one"}\n{"content": null}\n')
    (tmp_path / "a.json").write_text(json.dumps([{"text": "two"}, {"text": "three"}]))
    (tmp_path / "c.csv").write_text('text,n\n"a, ""b""\nline",1\n')
    (tmp_path / "d.tsv").write_text("text\tn\nx,y\t2\n")
    (tmp_path / "e.md").write_text("first\n\n  second \u00a0\n")
    (tmp_path / "noext").write_bytes(b'{"text": "four"}\n')
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "z.jsonl").write_text('{"text": "nested"}\n')
    return tmp_path


def test_paths_and_formats(spark, folder):
    names = [p.rsplit("/", 1)[1] for p in readers.expand_paths(spark, str(folder))]
    assert names == ["a.json", "b.jsonl", "c.csv", "d.tsv", "e.md", "noext"]
    assert [p.rsplit("/", 1)[1] for p in readers.expand_paths(spark, f"{folder}/*.json*")] == ["a.json", "b.jsonl"]
    assert readers.expand_paths(spark, ["missing.bin", "missing.csv"]) == ["missing.csv"]
    formats = [readers.detect_format(spark, str(folder / n)) for n in names]
    assert formats == ["json", "json", "csv", "tsv", "text", "json"]


def test_mixed_folder_loads_as_one_table(spark, folder):
    texts = {r.text for r in readers.load_pretrain_data(spark, str(folder)).select("text").collect()}
    assert texts == {"one", "two", "three", 'a, "b"\nline', "x,y", "first", "second", "four"}


def test_no_files_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError):
        readers.load_sft_data(spark, f"{folder}/*.nothing")


def test_shuffle_is_a_seeded_permutation(spark, folder):
    load = lambda seed: [r.text for r in readers.load_pretrain_data(spark, str(folder), seed=seed).select("text").collect()]
    assert load(1) == load(1) and sorted(load(1)) == sorted(load(2))


def test_filters_and_columns_reach_the_scan(spark):
    docs = readers.read_parquet(spark, [f"{SF}/documents.parquet"])
    plan = docs.filter(F.col("n_chars") > 5).select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(n_chars), GreaterThan(n_chars,5)]" in plan and "text" not in plan.split("ReadSchema")[1]


def test_stream_equals_batch(spark, tmp_path):
    table(spark, SF, "documents").select("text").write.json(f"{tmp_path}/in")
    job = jobs.stream_curate(spark, f"{tmp_path}/in", "pretrain", f"{tmp_path}/out", f"{tmp_path}/ck", SCHEMAS["pretrain"])
    job.awaitTermination()
    batch = jobs.curated(spark.read.schema(SCHEMAS["pretrain"]).json(f"{tmp_path}/in"), "pretrain")
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.text for r in got.collect()) == sorted(r.text for r in batch.collect())
