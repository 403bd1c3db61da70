"""What the physical plans must and must not contain."""

import io
import re
from contextlib import redirect_stdout

import pytest
from conftest import page_table
from pyspark.sql import functions as F

from shelfmark.operators import linking, pagecheck, paging, quality, report
from shelfmark.operators import reviews as rv
from shelfmark.operators.markupreviews import markup_reviews
from shelfmark.operators.pagestate import review_rows, with_reviews
from shelfmark.plans import derived, pipeline

STATE_PARSE = "StructField(props,"


def plan(df, mode="formatted"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "pages")
    pages = page_table(spark, "<p>a", "<p>b").withColumn("unused", F.lit("x")).withColumn("crawled", F.lit(1))
    pages.write.parquet(path)
    return spark.read.parquet(path)


def test_extraction_parses_the_state_once_and_does_not_shuffle(stored):
    for df in (
        review_rows(with_reviews(stored)),
        review_rows(with_reviews(stored)).filter("review_rating > 3"),
        pagecheck.quarantine(with_reviews(stored)),
        paging.with_page_count(stored).filter("page_count > 1"),
    ):
        text = plan(df, "simple")
        assert text.count(STATE_PARSE) == 1, text
        assert "Exchange" not in text


def test_filters_on_page_columns_and_columns_reach_the_scan(stored):
    text = plan(review_rows(with_reviews(stored)).filter("crawled = 1").select("page", "pos", "review_text"))
    assert "PushedFilters: [IsNotNull(crawled), EqualTo(crawled,1)]" in text
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "unused" not in schema and "page_url" not in schema


def test_markup_is_scanned_once(stored):
    text = plan(markup_reviews(stored).filter("review_rating > 3"), "simple")
    assert text.count("ArrowEvalPython") == 1
    assert "Exchange" not in text


def test_matching_needs_no_shuffle_beyond_the_join(spark):
    books = spark.range(5).select(F.col("id").cast("string").alias("book_id"), F.lit("t").alias("title"), F.lit("a").alias("author"))
    candidate = F.struct(*[F.lit("x").alias(n) for n in ("title", "author", "url", "catalogue_id")])
    text = plan(linking.with_best_match(books.withColumn("candidates", F.array(candidate))), "simple")
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1


def test_reviews_join_on_url_and_page(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        books = spark.createDataFrame([("1", "t", "a", "u", 2)], "book_id string, title string, author string, book_url string, page_count int")
        text = plan(rv.flat_reviews(paging.frontier(books), with_reviews(stored)), "simple")
        assert len(re.findall(r"hashpartitioning\(page_url#\d+, (?:cast\()?page#\d+", text)) == 2
        # The review arrays are shuffled, the page texts are not.
        for line in text.splitlines():
            if "Exchange hashpartitioning" in line:
                assert "html" not in line
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_book_table_reads_wanted_pages_and_parses_them_once(spark, stored, no_broadcast):
    books = spark.createDataFrame([("1", "t", "a", "u")], "book_id string, title string, author string, book_url string")
    text = plan(rv.reviews_of_books(books, stored), "simple")
    assert text.count(STATE_PARSE) == 1
    # The list of wanted URLs meets the pages below the parse.
    assert "BroadcastHashJoin" in text[text.index(STATE_PARSE) :]
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "html" not in line
    # The copies of a page are limited where they lie.
    assert "WindowGroupLimit" in text and "Partial" in text


def test_page_texts_of_copies_are_not_shuffled(spark, stored, no_broadcast):
    pages = stored.withColumn("saved_at", F.lit(1))
    books = spark.createDataFrame([("1", "t", "a", "u")], "book_id string, title string, author string, book_url string")
    search = stored.select(F.col("page_url").alias("search_key"), "html", F.lit(1).alias("saved_at"))
    for df in (
        rv.markup_reviews_of_books(books, pages),
        rv.nested_of_books(books, pages),
        rv.with_counts(books, pages),
        pipeline.link(spark, books.drop("book_url"), search),
    ):
        for line in plan(df, "extended").split("== Physical Plan ==")[1].splitlines():
            assert not re.search(r"Exchange hashpartitioning\(.*html", line)


def test_pages_of_one_book_come_from_many_tasks(spark):
    books = spark.createDataFrame([("1", "u", 100_000), ("2", "v", 1)], "book_id string, book_url string, page_count bigint")
    per_task = paging.frontier(books).groupBy(F.spark_partition_id()).count()
    counts = [r["count"] for r in per_task.collect()]
    assert sum(counts) == 100_001 and len(counts) > 4 and max(counts) < 40_000


def test_violations_are_limited_before_the_shuffle(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("book_id"), F.lit(9.0).alias("review_rating"))
    text = plan(quality.first_broken(df, "subset", ["book_id"]), "simple")
    assert "WindowGroupLimit" in text and "Partial" in text


def test_suite_is_one_aggregation_without_distinct(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("book_id"), F.lit(9.0).alias("review_rating"))
    text = plan(quality.run_suite(df, "release"), "simple")
    assert text.count("Aggregate(") == 2 and text.count("Exchange") == 1 and "Expand" not in text


def test_samples_are_top_k(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.lit("t").alias("review_text"))
    assert "TakeOrderedAndProject" in plan(report.sample_reviews(df, ["k"]), "simple")
    assert "TakeOrderedAndProject" in plan(report.first_reviews(df, ["k"]), "simple")


def test_no_join_is_forced_or_crossed(spark):
    import pathlib

    import shelfmark

    top = pathlib.Path(shelfmark.__file__).parent
    for path in top.rglob("*.py"):
        text = path.read_text()
        for word in ("crossJoin", "localCheckpoint", "toPandas", ".rdd"):
            assert word not in text, (path, word)
        if path.relative_to(top).parts[0] == "llm":
            continue  # there, what is collected or broadcast is bounded by a parameter
        # One narrow row for each split of a file is collected, and sent to the tasks.
        assert text.count(".collect(") == (path.name == "records.py"), path
        # The other hint is for a filter of bounded size.
        assert text.count("broadcast(") == (path.name in ("records.py", "keyfilter.py")), path


@pytest.fixture(scope="module")
def tables_folder(spark, tmp_path_factory):
    """Tables of the derived rows, a few of each."""
    folder = str(tmp_path_factory.mktemp("tables"))
    part = spark.range(40).select(
        F.col("id").alias("p_partkey"), F.concat(F.lit("a title "), "id").alias("p_name"), F.concat(F.lit("brand "), F.col("id") % 7).alias("p_brand")
    )
    part.write.parquet(f"{folder}/part.parquet")
    event = spark.range(300).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 5000).alias("ts"), (F.col("id") % 9).alias("user_id"),
        (F.col("id") % 25).cast("double").alias("value"), F.lit('{"k": 3}').alias("props"),
    )
    event.write.parquet(f"{folder}/events.parquet")
    spark.range(20).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 300).alias("text")).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_search_results_are_not_sent_through_the_driver(spark, tables_folder):
    """Ten rows for each part, and a key for each query: the planner takes both for small tables."""
    text = plan(derived.keyed_search_pages(spark, tables_folder), "simple")
    assert text.count("SortMergeJoin") == 2 and "Broadcast" not in text


def test_texts_of_derived_pages_are_dealt_once(spark, tables_folder):
    """The copies of a page are brought together where the page was written."""
    text = plan(rv.latest_extracted(derived.saved_pages(spark, tables_folder)), "simple")
    dealt = [line for line in text.splitlines() if re.search(r"Exchange hashpartitioning\((page_url|book_no|page)#", line)]
    assert len(dealt) == 1 and "REPARTITION_BY_COL" in dealt[0], text
    assert "Window" in text


def test_lists_per_book_are_dealt_once(spark):
    nested = spark.createDataFrame(
        [("1", "t", "a", "u", page, [("x", 4.0, "r", "n", 0, "", "")]) for page in (1, 101, 102, 102)],
        f"book_id string, title string, author string, book_url string, page int, reviews array<{rv.REVIEW}>",
    )
    listed = rv.reviews_per_book(nested)
    assert plan(listed, "simple").count("Exchange hashpartitioning") == 1
    assert sorted((r.chunk, len(r.reviews)) for r in listed.collect()) == [(0, 1), (1, 2), (1, 2)]


def test_markup_reviews_are_dealt_by_page_only(spark, stored):
    books = spark.createDataFrame([("1", "t", "a", "https://books.example.org/b")], "book_id string, title string, author string, book_url string")
    text = plan(rv.markup_reviews_of_books(books, stored.select("page_url", "page", "html")), "simple")
    assert not re.search(r"hashpartitioning\(page_url#\d+, page#\d+, _digest", text)
    assert text.count("SortAggregate") == 0
