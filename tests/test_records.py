"""Delimited files with line breaks in quoted fields, read in many splits, against whole files read by Python and DuckDB."""

import csv
import io
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from onomast.sources import readers, records, writers


@pytest.fixture
def split_bytes(spark):
    """Set the size of a split, with the old one restored."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.set(name, before)


def written(rows, path, end="\n"):
    with open(path, "w", newline="") as file:
        csv.writer(file, lineterminator=end).writerows(rows)


def random_rows(rng, number):
    pieces = ['"', "\n", "a", ",", "ñ", " ", "\n\n", '""', "b,c", "x" * 30]
    return [[str(i), "".join(rng.choices(pieces, k=rng.randrange(12))) or "-", rng.choice(["", "z", 'q"q', "m\nn"]) or "-"] for i in range(number)]


@pytest.mark.parametrize("size", [7, 40, 1_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_breaks_across_splits(spark, tmp_path, split_bytes, size, end):
    rng = random.Random(size)
    header, sent = ["id", "text", "more"], []
    for name in ("one.csv", "two.csv"):
        rows = random_rows(rng, 60)
        written([header, *rows], tmp_path / name, end)
        sent += rows
    split_bytes(max(size, 20))
    found = readers.scan_csv_strings(spark, str(tmp_path), multiline=True)
    assert found.columns == header
    lines = records.text_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 2 if size < 1_000 else True
    assert sorted(tuple(r) for r in found.collect()) == sorted(map(tuple, sent))
    typed = readers.scan_csv(spark, str(tmp_path), "id int, more string", multiline=True)
    assert sorted(tuple(r) for r in typed.collect()) == sorted((int(i), m) for i, _, m in sent)


def test_a_field_over_many_splits_agrees_with_duckdb(spark, tmp_path, split_bytes):
    rows = [["id", "text"], ["1", "short"], ["2", "line, \"quoted\"\n" * 400], ["3", "\n"], ["4", "end"], ["5", "\n\n\nlast"]]
    written(rows, tmp_path / "long.csv")
    split_bytes(200)
    found = readers.scan_csv(spark, str(tmp_path), "id long, text string", multiline=True)
    assert records.text_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    theirs = duckdb.sql(f"SELECT * FROM read_csv('{tmp_path}/long.csv', header = true, quote = '\"', escape = '\"', all_varchar = true)").fetchall()
    assert sorted((str(r["id"]), r["text"]) for r in found.collect()) == sorted(theirs) == sorted(map(tuple, rows[1:]))


def test_split_starts(spark, tmp_path, split_bytes):
    written([["id", "text"], ["1", "a\n" * 100], ["2", "b"]], tmp_path / "x.csv")
    split_bytes(50)
    flags = [(r["begins"], r["ends"]) for r in records.split_starts(records.text_lines(spark, str(tmp_path))).collect()]
    assert (0, 1) in flags and (1, 1) in flags and (1, 0) in flags


def test_sheets_with_breaks(spark, tmp_path, split_bytes):
    folder = tmp_path / "sheets"
    folder.mkdir()
    for name, rows in (("Hombres.csv", [["ANA\nMARÍA", "5"], ["LEO", "6"]]), ("Mujeres.csv", [["EVA", "7"], ['A "B"\n\nC', "8"]])):
        text = io.StringIO()
        csv.writer(text, lineterminator="\n").writerows([["note, with a\nbreak"], ["second"], ["name", "n"], *rows * 20])
        (folder / name).write_text(text.getvalue())
    split_bytes(60)
    found = readers.scan_tagged_sheets(spark, str(folder), "name string, n int", 2, {"Hombres": "M", "Mujeres": "F"}, "sex", multiline=True)
    one = [("ANA\nMARÍA", 5, "M"), ("LEO", 6, "M"), ("EVA", 7, "F"), ('A "B"\n\nC', 8, "F")]
    assert sorted(tuple(r) for r in found.collect()) == sorted(one * 20)


def test_errors(spark, tmp_path):
    cases = {"header": '"id","other"\n1,"x\ny"\n', "ragged": 'id,text\n1,"x\ny",z\n', "open": 'id,text\n1,"x\ny\n2,z\n'}
    for name, text in cases.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.csv").write_text('id,text\n1,"x\ny"\n')
        assert readers.scan_csv_strings(spark, str(folder), multiline=True).count() == 1
        (folder / "b.csv").write_text(text)
        with pytest.raises(Exception, match="header|MALFORMED|never closed"):
            readers.scan_csv_strings(spark, str(folder), multiline=True).collect()


def test_empty_and_headers_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n")
    (tmp_path / "b.csv").write_text("")
    assert readers.scan_csv_strings(spark, str(tmp_path), multiline=True).collect() == []


def test_written_texts_come_back(spark, tmp_path, split_bytes):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.concat("text", F.lit('\n"x", y\n')).alias("text"))
    writers.write_csv(docs.coalesce(1), str(tmp_path / "docs"))
    split_bytes(20_000)
    found = readers.scan_csv(spark, str(tmp_path / "docs"), docs.schema, multiline=True)
    assert records.text_lines(spark, str(tmp_path / "docs")).rdd.getNumPartitions() > 8
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
