"""Pages derived from tables, and queries that take their texts along."""

import re

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import packing
from shelfmark.plans import derived, registry
from shelfmark.plans.registry import QUERIES
from shelfmark.sources import sinks

TEXTS = ["first\nsecond, \"said\" & <done>", "one two " * 400, "", "é\tà ", None]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Parts, events and documents, a few of each; of a text there are several documents and many reviews."""
    folder = str(tmp_path_factory.mktemp("derived"))
    part = spark.range(40).select(
        F.col("id").alias("p_partkey"), F.concat(F.lit("a title "), "id").alias("p_name"), F.concat(F.lit("brand "), F.col("id") % 7).alias("p_brand")
    )
    part.write.parquet(f"{folder}/part.parquet")
    event = spark.range(300).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 5000).alias("ts"), (F.col("id") % 9).alias("user_id"),
        (F.col("id") % 25).cast("double").alias("value"), F.lit('{"k": 3}').alias("props"),
    )
    event.write.parquet(f"{folder}/events.parquet")
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(20)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    return folder


def test_markup_csv_holds_the_texts(spark, folder):
    back = QUERIES["markup_csv_round_trip"](spark, folder).select("review_url", "review_text")
    whole = QUERIES["flat_markup_reviews"](spark, folder).select("review_url", F.nullif("review_text", F.lit("")))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert {r.review_text for r in back.collect()} >= {TEXTS[0], TEXTS[1].strip(), None}


def test_texts_travel_packed(spark, folder):
    """The text of a document is packed before any shuffle and unpacked behind the last one."""
    for pages in (derived.state_pages(spark, folder), derived.markup_pages(spark, folder)):
        tree = pages._jdf.queryExecution().executedPlan().toString()
        steps = re.findall(r"ArrowEvalPython \[(\w+)\(|(REPARTITION_BY_COL)", tree)
        assert steps == [("texts", ""), ("", "REPARTITION_BY_COL"), ("packed", "")], tree


def test_packed_pages_are_the_same(spark, folder):
    for shape in (None, "edges", "state"):
        ours, plain = (derived.state_pages(spark, folder, shape, packed=p) for p in (True, False))
        assert ours.count() > 30 and ours.dtypes == plain.dtypes
        assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()


def test_packing_changes_nothing(spark):
    texts = [None, "", "a", "prose of some length, not much repeated, " + " ".join(map(str, range(200))), "again " * 100_000, "é\u0000\n\U0001f600"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    raw = df.union(spark.sql("SELECT 6, CAST(X'FF61FE' AS STRING)"))
    done = raw.withColumn("p", packing.pack(F.col("t"))).withColumn("back", packing.unpack("p"))
    assert done.filter("NOT CAST(back AS BINARY) <=> CAST(t AS BINARY)").isEmpty()
    sizes = {r.i: (r.n, r.m) for r in done.select("i", F.octet_length("p").alias("n"), F.octet_length("t").alias("m")).collect()}
    assert sizes[3][0] < 0.6 * sizes[3][1] and all(n * packing.MOST >= m for n, m in sizes.values() if m)
    lists = done.groupBy((F.col("i") % 2).alias("k")).agg(F.array_sort(F.collect_list(F.struct("i", "t", "p"))).alias("l"))
    lists = lists.union(spark.range(1).select(F.lit(9), F.lit(None).cast(lists.schema["l"].dataType)))
    lists = lists.withColumn("back", packing.unpack_list(F.col("l.p")))
    assert lists.count() == 3 and lists.filter(~F.col("back").eqNullSafe(F.col("l.t"))).isEmpty()


def test_markup_texts_are_joined_packed(spark, folder):
    """Texts read from markup are packed before they meet the books, and unpacked behind that join."""
    tree = QUERIES["flat_markup_reviews"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    steps = re.findall(r"ArrowEvalPython \[(text|packed|scan_pages)\(|(?<!\w)(Window|SortMergeJoin|BroadcastHashJoin) \[", tree)
    steps = [python or step for python, step in steps]
    scanned = steps.index("scan_pages")
    assert steps[0] == "text" and steps[1].endswith("Join") and steps[scanned - 2 : scanned] == ["Window", "packed"], steps


def test_list_order_is_written_packed(spark, folder, tmp_path, monkeypatch):
    """Compressed files of a few rows each still follow each other in the order asked for."""
    monkeypatch.setattr(registry, "work_folder", lambda spark, name: str(tmp_path / name))
    monkeypatch.setitem(sinks.PACKED_CSV, "maxRecordsPerFile", "7")
    got = QUERIES["list_order_written"](spark, folder).orderBy("n").collect()
    files = list((tmp_path / "list" / "reviews").glob("part-*"))
    assert len(files) > 10 and all(f.name.endswith(".csv.gz") for f in files)
    assert [r.n for r in got] == list(range(len(got))) and len(got) > 100
    order = [(r.book_seq, r.page, r.pos) for r in got]
    assert order == sorted(order)
