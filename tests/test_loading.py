"""Files of different shapes load without losing or mixing rows."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusflow.functions.chat import render_chat
from corpusflow.operators import rollouts
from corpusflow.operators.schema_ops import is_valid_conversation
from corpusflow.sources import readers, sinks


def texts(df):
    return sorted(r.text for r in df.select("text").collect())


def test_parquet_files_with_different_columns(spark, tmp_path):
    spark.createDataFrame([("a1",), ("a2",)], "text string").write.parquet(f"{tmp_path}/x/a")
    spark.createDataFrame([("b1", 1), ("b2", 2)], "content string, n int").write.parquet(f"{tmp_path}/x/b")
    files = [str(p) for p in tmp_path.glob("x/*/*.parquet")]
    assert texts(readers.load_pretrain_data(spark, files)) == ["a1", "a2", "b1", "b2"]


def test_csv_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("text,n\nt1,1\n")
    (tmp_path / "b.csv").write_text("n,content\n2,t2\n")
    got = readers.load_pretrain_data(spark, str(tmp_path)).select("text", "n").collect()
    assert sorted((r.text, str(r.n)) for r in got) == [("t1", "1"), ("t2", "2")]


def test_cut_json_line_is_an_error_unless_told(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "one"}\n{"text": "tw')
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.load_pretrain_data(spark, str(tmp_path)).collect()
    kept = readers.load_pretrain_data(spark, str(tmp_path), mode="DROPMALFORMED")
    assert texts(kept) == ["one"] and kept.columns == ["text"]
    assert [r.value for r in readers.bad_json_lines(spark, [f"{tmp_path}/a.jsonl"]).collect()] == ['{"text": "tw']


def test_chat_files_with_missing_and_decoded_fields(spark, tmp_path):
    rows = [
        {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]},
        {"messages": [{"role": "system", "content": "s", "tools": [{"z": 1, "a": 2}]}, {"role": "user", "content": "q"}]},
    ]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, rows)))
    loaded = readers.load_sft_data(spark, str(tmp_path))
    assert loaded.filter(is_valid_conversation(F.col("conversations"))).count() == 2
    tools = [m.tools for r in loaded.collect() for m in r.conversations if m.tools]
    assert [json.loads(t) for t in tools] == [[{"z": 1, "a": 2}]] and tools[0].index("z") < tools[0].index('"a"')
    loaded.write.parquet(f"{tmp_path}/p")
    assert readers.load_sft_data(spark, f"{tmp_path}/p/*.parquet").count() == 2


def test_preferences_and_answers(spark, tmp_path):
    said = [{"role": "user", "content": "q"}]
    (tmp_path / "d.jsonl").write_text(json.dumps({"preferred": said, "rejected": said}))
    (tmp_path / "g.jsonl").write_text(json.dumps({"messages": said, "answer": "4"}))
    assert readers.load_dpo_data(spark, f"{tmp_path}/d.jsonl").first().chosen[0].content == "q"
    assert readers.load_agent_data(spark, f"{tmp_path}/g.jsonl").first().gt == ["4"]
    assert readers.load_rlaif_data(spark, f"{tmp_path}/g.jsonl").first().conversations[0].role == "user"


def test_other_epochs_stay(spark, tmp_path):
    for epoch in (0, 1):
        rows = spark.range(4).select((F.col("id") + 10 * epoch).alias("x"), F.col("id").alias("idx"), F.lit(epoch).alias("epoch"))
        sinks.write_examples(rows, f"{tmp_path}/e", 2)
    assert sorted(r.x for r in spark.read.parquet(f"{tmp_path}/e").collect()) == [0, 1, 2, 3, 10, 11, 12, 13]


def test_advantages_do_not_depend_on_where_positions_start(spark):
    df = spark.range(600).select(
        F.lit(1).alias("sample_id"), F.col("id").alias("pos"), (F.col("id") % 7 * 0.1).alias("token_reward"), (F.col("id") % 5 * 0.2).alias("value")
    )
    base = [r.advantage for r in rollouts.gae(df, 0.99).orderBy("pos").collect()]
    moved = [r.advantage for r in rollouts.gae(df.withColumn("pos", F.col("pos") * 3 + 300), 0.99).orderBy("pos").collect()]
    assert base == pytest.approx(moved)
    rest, want = 0.0, []
    rows = [(r.token_reward, r.value) for r in df.orderBy("pos").collect()]
    for i in range(599, -1, -1):
        after = rows[i + 1][1] if i < 599 else 0.0
        rest = rows[i][0] + 0.99 * after - rows[i][1] + 0.99 * 0.95 * rest
        want.append(rest)
    assert base == pytest.approx(want[::-1])


def test_malformed_tool_json_does_not_end_the_job(spark):
    schema = "conversations array<struct<role:string,content:string,reasoning_content:string,tools:string,tool_calls:string>>"
    rows = [([("system", "s", None, "[{", None), ("user", "q", None, None, None), ("assistant", "a", None, None, '[{"name": ')],)]
    df = spark.createDataFrame(rows, schema)
    assert "a" in df.select(render_chat(F.col("conversations")).alias("t")).first().t
