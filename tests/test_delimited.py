"""CSV files cut into many tasks, against a reader that sees one file after another."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from modlens.sources import annotations, comments, delimited


@pytest.fixture
def small_ranges(spark):
    """Files are cut into ranges of a few hundred bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, header, rows, quoting=csv.QUOTE_MINIMAL, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, quoting=quoting, lineterminator=end)
        out.writerows([header, *rows])


def random_cell(rng):
    return "".join(rng.choice(['"', ",", "\n", "a", "é", " ", '""', "x\r\ny", "word ", "long " * 30]) for _ in range(rng.randrange(6)))


def one_after_another(folder):
    """Rows as dictionaries, by Python's reader; empty cells are None."""
    out = []
    for path in sorted(folder.iterdir()):
        with open(path, newline="", encoding="utf-8") as f:
            out += [{k: v or None for k, v in row.items() if k} for row in csv.DictReader(f)]
    return out


def as_set(rows, columns):
    return sorted(repr([r.get(c) or None for c in columns]) for r in rows)


@pytest.mark.parametrize("seed", range(4))
def test_equals_a_reader_of_whole_files(spark, tmp_path, small_ranges, seed):
    rng = random.Random(seed)
    for n in range(5):
        names = rng.sample(["text", "toxic", "slur", "other thing"], rng.randint(2, 4))
        rows = [["1" if i == 0 else random_cell(rng) for i in range(len(names))] for _ in range(rng.randrange(60))]
        write(tmp_path / f"f{n}.csv", names, rows, rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), rng.choice(["\n", "\r\n"]))
    got = delimited.read_csv(spark, str(tmp_path))
    want = one_after_another(tmp_path)
    assert set(got.columns) == {k for r in want for k in r} | {c for p in tmp_path.iterdir() for c in p.read_text().split("\n")[0].strip("\r").replace('"', "").split(",")}
    assert as_set([r.asDict() for r in got.collect()], got.columns) == as_set(want, got.columns)


def test_quotes_that_open_no_cell(spark, tmp_path, small_ranges):
    """A quote inside an unquoted cell is a character; counting quotes alone would take the rest of the file for one cell."""
    rows = "".join(f'{i},5" wide,"in ""a"" cell\n\n, {i}"\n' for i in range(200))
    (tmp_path / "a.csv").write_text("id,size,note\n" + rows)
    got = delimited.read_csv(spark, str(tmp_path)).orderBy(F.col("id").cast("int")).collect()
    assert [tuple(r) for r in got] == [(str(i), '5" wide', f'in "a" cell\n\n, {i}') for i in range(200)]


def test_a_cell_over_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f'line "{i}", and more of it' for i in range(300))
    write(tmp_path / "a.csv", ["id", "text"], [["1", "x"], ["2", long], ["3", "y\nz"]])
    assert sorted(map(tuple, delimited.read_csv(spark, str(tmp_path)).collect())) == [("1", "x"), ("2", long), ("3", "y\nz")]


def test_one_file_is_many_tasks(spark, tmp_path):
    write(tmp_path / "a.csv", ["id", "text"], [[i, "two\nlines " * 50] for i in range(8000)], csv.QUOTE_ALL)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")  # the file is smaller than what Spark would otherwise cut
    try:
        got = delimited.read_csv(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        sizes = [len(x) for x in got.select("id").rdd.glom().collect()]
        assert min(sorted(sizes)[-spark.sparkContext.defaultParallelism :]) > 0.5 * 8000 / spark.sparkContext.defaultParallelism
        assert got.agg(F.count_distinct("id"), F.min(F.length("text")), F.max(F.length("text"))).first() == (8000, 500, 500)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_odd_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿\"text\",n,,n\r\n\r\nx,1,2,3\r\nshort\r\n\"open, to\nthe end".encode())
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("N,text\n")
    got = delimited.read_csv(spark, str(tmp_path))
    assert got.columns == ["text", "n1", "_c2", "n3", "N"]
    rows = sorted([tuple(r) for r in got.collect()], key=repr)
    assert rows == [("open, to\nthe end", None, None, None, None), ("short", None, None, None, None), ("x", "1", "2", "3", None)]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "e.csv").write_text("\n\n")
    assert delimited.read_csv(spark, str(tmp_path / "d")).count() == 0
    changed = delimited.read_csv(spark, str(tmp_path / "a.csv"), path_column="file").select("file").distinct().collect()
    assert [r.file.rsplit("/", 1)[1] for r in changed] == ["a.csv"]


def test_readers_go_by_header(spark, tmp_path):
    """Annotators' columns stand in another order, and one lacks a label."""
    (tmp_path / "iaa_annotator_al.csv").write_text("text,toxic,slur,not_toxic\nhello is toxic,1,0,0\n")
    (tmp_path / "iaa_annotator_bo.csv").write_text("not_toxic,text,toxic\n0,hello is toxic,1\n")
    got = annotations.read_annotators(spark, str(tmp_path)).select("annotator", "text", "toxic", "slur", "not_toxic", "text_clean").collect()
    assert sorted(map(tuple, got)) == [("al", "hello is toxic", 1, 0, 0, "hello is toxic"), ("bo", "hello is toxic", 1, 0, 0, "hello is toxic")]
    files = [str(p) for p in sorted(tmp_path.iterdir())]
    assert sorted((r.text, r.toxic, r.slur) for r in comments.read_text_csv(spark, files).collect()) == [("hello is toxic", "1", ""), ("hello is toxic", "1", "0")]


def test_ranges_must_be_the_same(spark, tmp_path):
    write(tmp_path / "a.csv", ["id", "text"], [[i, "a\nb" * 99] for i in range(500)])
    got = delimited.read_csv(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        with pytest.raises(Exception, match="byte ranges"):
            got.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_partition_folders(spark, tmp_path, small_ranges):
    for part in ("a b", "c"):
        (tmp_path / f"split={part}").mkdir()
        write(tmp_path / f"split={part}" / "x.csv", ["id", "text"], [[f"{part}{i}", "two\nlines " * 9] for i in range(50)])
    got = delimited.read_csv(spark, str(tmp_path))
    assert got.columns == ["id", "text", "split"]
    assert {(r.split, r["count"]) for r in got.where("startswith(id, split) and length(text) = 90").groupBy("split").count().collect()} == {("a b", 50), ("c", 50)}


def test_few_lines_are_held_at_a_time(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(delimited, "HELD_LINES", 3)
    taken = []

    class Column:
        def __len__(self):
            return 8

        def slice(self, at, n):
            taken.append((at, n))
            return pa.array([f"{i}" for i in range(at, min(at + n, 8))])

    texts = delimited._texts(Column())
    assert next(texts) == "0" and taken == [(0, 3)]
    assert list(texts) == [f"{i}" for i in range(1, 8)] and len(taken) == 3
    monkeypatch.setattr(delimited, "HELD_CHARS", 20)
    rows = [(f"{i}", "x" * (i % 30) + '\n"y"') for i in range(200)]
    (tmp_path / "a.csv").write_text("id,text\n" + "".join('{},"{}"\n'.format(i, t.replace('"', '""')) for i, t in rows))
    assert sorted(map(tuple, delimited.read_csv(spark, str(tmp_path)).collect())) == sorted(rows)
