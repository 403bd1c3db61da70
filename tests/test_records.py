import csv
import random

import pytest

from shelfmark.sources import records, tables


@pytest.fixture
def small_splits(spark):
    """Files are cut after so many bytes, so that records lie across splits."""
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end).writerows(rows)


def mixed_rows(rng, n):
    parts = ["a", "b,c", 'say "so"', "line\nbreak", "\n", "é ü", "", '"', "\n\n", "x" * 40, "plain text of some length"]
    return [[str(i), *("".join(rng.choices(parts, k=rng.randint(0, 4))) for _ in range(3))] for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("files", [1, 4])
def test_records_across_splits(spark, small_splits, tmp_path, end, files):
    rng = random.Random(files + len(end))
    want = []
    for k in range(files):
        rows = mixed_rows(rng, 150)
        want += rows
        write(tmp_path / f"f{k}.csv", [["no", "a b", "c`d", "e"], *rows], end)
    assert records.lines_of(spark, str(tmp_path)).rdd.getNumPartitions() > 8
    got = tables.read_csv(spark, str(tmp_path), seq="n")
    assert got.columns == ["no", "a b", "c`d", "e", "n"]
    rows = sorted(got.collect(), key=lambda r: r["n"])
    assert [r["n"] for r in rows] == list(range(len(want)))
    assert [[x or "" for x in r[:4]] for r in rows] == want
    # As the whole-file reader has it.
    whole = spark.read.options(**tables.CSV, multiLine="true").csv(str(tmp_path))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, got.drop("n").collect()))


def test_a_record_over_many_splits(spark, small_splits, tmp_path):
    long = "\n".join(f"line {i} \"q\"" for i in range(500))
    write(tmp_path / "f.csv", [["a", "b"], ["1", "x"], ["2", long], ["3", "y"]])
    rows = tables.read_csv(spark, str(tmp_path / "f.csv"), seq="n").orderBy("n").collect()
    assert [(r["a"], r["b"]) for r in rows] == [("1", "x"), ("2", long), ("3", "y")]


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path):
    rows = [[str(i), f"two\nlines {i}" + "x" * 500] for i in range(20_000)]
    write(tmp_path / "f.csv", [["a", "b"], *rows])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        got = tables.read_csv(spark, str(tmp_path / "f.csv"))
        assert got.rdd.getNumPartitions() >= 8
        assert got.count() == len(rows) and got.filter("b like 'two\\nlines%'").count() == len(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_empty_lines_and_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n\n1,2\n\n3,\n")
    (tmp_path / "b.csv").write_text("a,b\n")
    (tmp_path / "c.csv").write_text('a,b\n"open, never closed\n4,5')
    got = tables.read_csv(spark, str(tmp_path), seq="n").orderBy("n").collect()
    assert [tuple(r)[:2] for r in got[:2]] == [("1", "2"), ("3", None)] and len(got) == 3
    assert got[2]["a"].startswith("open, never closed")
