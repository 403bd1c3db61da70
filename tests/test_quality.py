import pytest

from pyspark.sql import functions as F

from shelfmark.operators import quality as q
from shelfmark.schema import RAW_RATING, required_columns

SCHEMA = (
    "book_id string, title string, author string, book_url string, review_text string, review_rating double,"
    "reviewer_id string, reviewer_name string, review_upvotes long, review_date string"
)


def row(**changes):
    good = {
        "book_id": "1", "title": "T", "author": "A", "book_url": "u", "review_text": "fine", "review_rating": 4.0,
        "reviewer_id": "123", "reviewer_name": "N", "review_upvotes": 1, "review_date": "2023-01-15T00:00:00",
    }
    return tuple({**good, **changes}.values())


def run(spark, suite, *rows, drop=()):
    df = spark.createDataFrame(list(rows), SCHEMA).drop(*drop)
    report = q.run_suite(df, suite)
    return {r.rule: r.violations for r in report.collect() if r.violations}, q.suite_passed(report)


OTHER = row(book_id="2")


@pytest.mark.parametrize("suite", q.SUITES)
def test_good_rows_pass(spark, suite):
    # Two contracts do not ask for the reviewer's name, and say what else is there.
    extra = {"extra_columns": 1} if suite in ("format", "sample") else {}
    assert run(spark, suite, row(), OTHER) == (extra, True)


@pytest.mark.parametrize(
    "change, broken",
    [
        ({"review_rating": None}, {"null_review_rating": 1, "rating_range": 1}),
        ({"review_rating": 4.5}, {}),
        ({"review_rating": 6.0}, {"rating_range": 1}),
        ({"review_rating": 0.0}, {"rating_range": 1}),
        ({"review_date": "2023-01-15"}, {"date_form": 1}),
        ({"review_date": "2023-01-15T00:00:00Z"}, {"date_form": 1}),
        ({"review_date": "2023-13-99T00:00:00"}, {}),
        ({"review_date": None}, {"date_form": 1}),
        ({"book_id": None}, {"null_book_id": 1}),
        ({"review_text": None}, {"null_review_text": 1}),
        ({"review_text": ""}, {}),
        ({"review_text": "Mock review 1"}, {"mock_text_start": 1}),
        ({"review_text": "a Mock review"}, {}),
        ({"reviewer_id": "mock_user_1"}, {"mock_user": 1}),
    ],
)
def test_subset_suite(spark, change, broken):
    assert run(spark, "subset", row(**change), OTHER) == (broken, not broken)


@pytest.mark.parametrize(
    "change, broken, passed",
    [
        ({"review_rating": None}, {"null_review_rating": 1}, True),
        ({"review_rating": 4.5}, {"rating_whole": 1}, True),
        ({"review_text": ""}, {"empty_text": 1}, True),
        ({"review_text": None}, {"null_review_text": 1, "empty_text": 1}, True),
        ({"review_text": "a Mock review"}, {"mock_text_inside": 1}, False),
        ({"review_date": None}, {}, True),
    ],
)
def test_release_suite(spark, change, broken, passed):
    assert run(spark, "release", row(**change), OTHER) == (broken, passed)


def test_few_books_only_warns(spark):
    assert run(spark, "release", row(), row()) == ({"few_books": 1}, True)
    assert run(spark, "release", row(book_id=None), row(book_id=None))[0]["few_books"] == 1


def test_empty_tables(spark):
    assert run(spark, "subset") == ({}, True)
    assert run(spark, "subset", drop=["author"]) == ({}, True)
    assert run(spark, "release") == ({"not_empty": 1, "few_books": 1}, False)
    assert run(spark, "sample") == ({"not_empty": 1, "extra_columns": 1}, True)
    assert run(spark, "contract", drop=["author"]) == ({"not_empty": 1, "required_columns": 1}, False)


def test_missing_columns(spark):
    assert run(spark, "sample", row(), drop=["author", "review_date"]) == ({"required_columns": 2, "extra_columns": 1}, False)
    assert run(spark, "sample", row(), drop=["reviewer_name"]) == ({}, True)
    assert run(spark, "release", row(), OTHER, drop=["reviewer_name"]) == ({"required_columns": 1}, False)
    assert run(spark, "format", row(review_rating=9.0), drop=["title"]) == (
        {"required_columns": 1, "extra_columns": 1, "rating_range": 1}, True,
    )


def test_missing_and_extra(spark):
    df = spark.createDataFrame([row()], SCHEMA).drop("title")
    assert q.missing_and_extra(df, required_columns()) == (["title"], ["reviewer_name"])


def test_first_broken_values_per_rule(spark):
    rows = [row(book_id=str(i), review_rating=10.0 + i, review_date=None if i == 3 else "bad") for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = q.first_broken(df, "subset", ["review_rating"]).collect()
    ratings = sorted((r.n, r.value) for r in found if r.rule == "rating_range")
    assert ratings == [(i + 1, str(10.0 + i)) for i in range(5)]
    assert [r.value for r in sorted(found, key=lambda r: r.n) if r.rule == "date_form"] == ["bad", "bad", "bad", None, "bad"]


def test_ratings_as_written(spark):
    df = spark.createDataFrame([row(), OTHER, row(review_rating=None), row(review_rating=None)], SCHEMA)
    written = [None if i == 2 else "five" if i == 3 else "4" for i in range(4)]
    numbered = df.coalesce(1).withColumn("i", F.monotonically_increasing_id().cast("int"))
    df = numbered.withColumn(RAW_RATING, F.get(F.array(*[F.lit(w) for w in written]), F.col("i"))).drop("i")
    report = {r.rule: r.violations for r in q.run_suite(df, "release").collect()}
    assert (report["null_review_rating"], report["rating_whole"]) == (1, 1)
    assert {r.rule: r.violations for r in q.run_suite(df, "sample").collect()}["rating_range"] == 2
    assert [r.value for r in q.first_broken(df, "sample", ["book_id"]).filter("rule = 'rating_range'").collect()].count("five") == 1


def test_several_suites_in_one_pass(spark):
    df = spark.createDataFrame([row(), row(book_id="2", review_text=None), row(review_text="Mock review")], SCHEMA)
    both = q.run_suites(df, ["sample", "release"])
    apart = [q.run_suite(df, name).withColumn("suite", F.lit(name)) for name in ("sample", "release")]
    assert both.columns == apart[0].columns
    assert sorted(both.collect()) == sorted(apart[0].union(apart[1]).collect())
    assert q.run_suites(df.limit(0), ["sample"]).count() == q.run_suite(df, "sample").count()
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
