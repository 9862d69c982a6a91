"""Delimited and JSON-array files read by small byte ranges, against the standard library."""

import csv
import io
import json
import random

import pytest

from corpusflow.sources import ranges, readers


@pytest.fixture
def small_ranges(spark):
    """Files are cut every few dozen bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in zip(keys, ("64b", "1b", "1")):
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def table(rng, n):
    pieces = ['a', 'é', '"', '""', ',', '\n', '\r\n', ' ', 'word', '\n\n', '日本', '""\n",']
    cell = lambda: "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))
    return [[str(i), "x" + cell(), "y" + cell() * rng.choice([1, 1, 30])] for i in range(n)]


def write_csv(path, header, rows, end="\n"):
    with open(path, "w", encoding="utf-8", newline="") as f:
        csv.writer(f, lineterminator=end).writerows([header, *rows])


@pytest.mark.parametrize("broadcast", [0, 1000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_fields_across_ranges(spark, tmp_path, small_ranges, monkeypatch, broadcast, end):
    monkeypatch.setattr(ranges, "BROADCAST_RANGES", broadcast)
    rows = table(random.Random(broadcast + len(end)), 40)
    write_csv(tmp_path / "a.csv", ["id", "text", "more"], rows, end)
    assert spark.read.text(f"{tmp_path}/a.csv").rdd.getNumPartitions() > 5
    got = readers.read_csv(spark, [f"{tmp_path}/a.csv"])
    assert got.dtypes[0] == ("id", "int")
    assert sorted([str(r.id), r.text, r.more] for r in got.collect()) == sorted(rows)


def test_files_are_told_apart_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a b.csv").write_text("text,lang\nhello,en\n\n")
    (tmp_path / "c d.csv").write_text("lang,text\nfr,bonjour\n")
    (tmp_path / "e%20f+ü.csv").write_text('\ufeff"text",\'lang\'\n"ho, la",es\n')
    (tmp_path / "empty.csv").write_text("")
    got = readers.load_pretrain_data(spark, str(tmp_path), shuffle=False)
    assert sorted(r.text for r in got.collect()) == ["bonjour", "hello", "ho, la"]
    assert sorted(str(r.lang) for r in got.collect()) == ["None", "en", "fr"]


def test_lines_as_records_and_a_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text('text,n\nhe said "no,1\nplain,2\n')
    for multi in (True, False):
        got = readers.load_pretrain_data(spark, str(tmp_path), shuffle=False, multi_line=multi).select("text", "n")
        assert sorted(tuple(r) for r in got.collect()) == [('he said "no', 1), ("plain", 2)]
    typed = readers.read_csv(spark, [f"{tmp_path}/a.csv"], schema=readers.T.StructType.fromDDL("n double, other string, text string"))
    assert sorted(tuple(r) for r in typed.collect()) == [(1.0, None, 'he said "no'), (2.0, None, "plain")]


def test_a_record_of_another_width_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("text,n\none,1\ntwo\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv(spark, [f"{tmp_path}/a.csv"]).collect()


def test_csv_step_equals_the_standard_reader():
    step, rng = ranges.csv_step(","), random.Random(3)
    for _ in range(3000):
        rows = table(rng, 3)
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(rows)
        inside, found, held = False, [], []
        for line in out.getvalue()[:-1].split("\n"):
            inside, _ = step(line, inside)
            held.append(line)
            if not inside:
                found.append(next(csv.reader(io.StringIO("\n".join(held), newline=""))))
                held = []
        assert found == rows


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("broadcast", [0, 1000])
def test_arrays_across_ranges(spark, tmp_path, small_ranges, monkeypatch, indent, broadcast):
    monkeypatch.setattr(ranges, "BROADCAST_RANGES", broadcast)
    rng = random.Random(6)
    texts = ["}{", '"]', "\\", "\n}", "é", '\\"}', "plain " * 30, ""]
    rows = [{"text": rng.choice(texts) + rng.choice(texts), "n": i, "sub": [{"k": {"z": rng.choice(texts)}}, {"k": {"z": "["}}]} for i in range(40)]
    (tmp_path / "a.json").write_text("\ufeff" + "  \n" + json.dumps(rows, indent=indent, ensure_ascii=False) + "\n")
    (tmp_path / "b c.json").write_text(json.dumps([{"text": "one", "n": 100}]))
    (tmp_path / "none.json").write_text(" [ ]\n")
    (tmp_path / "lines.json").write_text('{"text": "line", "n": 101}\n')
    got = readers.read_json(spark, readers.expand_paths(spark, str(tmp_path)))
    want = [(r["n"], r["text"], [s["k"]["z"] for s in r["sub"]]) for r in rows] + [(100, "one", None), (101, "line", None)]
    assert sorted((r.n, r.text, r["sub"] and [s.k.z for s in r["sub"]]) for r in got.collect()) == want


def test_a_malformed_element_is_an_error_unless_told(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"text": "one"}, {"text": tw}, {"text": "three"}]')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.load_pretrain_data(spark, str(tmp_path)).collect()
    kept = readers.load_pretrain_data(spark, str(tmp_path), mode="DROPMALFORMED")
    assert sorted(r.text for r in kept.collect()) == ["one", "three"]
