import pytest
from conftest import PAGE_SCHEMA, page
from pyspark.sql import functions as F

from shelfmark.operators import keyfilter, report
from shelfmark.operators import reviews as rv
from shelfmark.schema import review_table

URL = "https://books.example.org/book/show/{}"


def reviews_page(texts, total=None):
    state = {f"Review:{t}": {"text": t, "rating": i, "userId": t} for i, t in enumerate(texts)}
    if total is not None:
        state["ROOT_QUERY"] = {"book(1)": {"reviews": {"edges": [], "pageInfo": {"totalPages": total}}}}
    return page(apolloState=state)


@pytest.fixture(scope="module")
def store(spark):
    one, two = URL.format(1) + "/reviews", URL.format(2) + "/reviews"
    rows = [
        (one, None, reviews_page(["unused"], 3)),
        (one, 1, reviews_page(["a", "b"])),
        (one, 2, reviews_page(["a"])),
        (one, 3, reviews_page([])),
        (one, 4, reviews_page(["beyond the count"])),
        (two, 1, reviews_page(["c"])),
        (two, 2, reviews_page(["not counted"])),
    ]
    return spark.createDataFrame(rows, PAGE_SCHEMA)


@pytest.fixture(scope="module")
def books(spark):
    rows = [("1", "One", "A", URL.format(1) + "/"), ("2", "Two", "B", URL.format(2)), ("3", "Three", "C", None),
            ("4", "Four", "D", ""), ("5", "Five", "E", URL.format(5))]
    return spark.createDataFrame(rows, "book_id string, title string, author string, book_url string")


def texts(df):
    return sorted((r.book_id, r.page, r.pos, r.review_text) for r in df.collect())


def test_flat_reviews_follow_the_store_and_the_cap_and_keep_repeats(books, store):
    flat = rv.reviews_of_books(books, store)
    assert [f.name for f in review_table().fields if f.name not in flat.columns] == []
    assert texts(flat) == [
        ("1", 1, 0, "a"), ("1", 1, 1, "b"), ("1", 2, 0, "a"), ("1", 4, 0, "beyond the count"),
        ("2", 1, 0, "c"), ("2", 2, 0, "not counted"),
    ]
    assert rv.reviews_of_books(books, store, max_pages=1).count() == 3


def test_pages_without_a_first_page_are_extracted(books, store):
    assert texts(rv.reviews_of_books(books, store.filter("page > 1"))) == [
        ("1", 2, 0, "a"), ("1", 4, 0, "beyond the count"), ("2", 2, 0, "not counted"),
    ]


def test_one_copy_of_each_page(spark, books, store):
    rows = [(r.page_url, r.page, r.html, r.page) for r in store.collect()]
    one = URL.format(1) + "/reviews"
    rows += rows + [(one, 2, reviews_page(["undated"]), None), (one, 1, reviews_page([]), 9), (one, 1, reviews_page([]), 9)]
    copies = spark.createDataFrame(rows, PAGE_SCHEMA + ", saved_at int").repartition(4)
    assert texts(rv.reviews_of_books(books, copies)) == texts(rv.reviews_of_books(books, store))[2:]
    assert rv.reviews_of_books(books, copies.drop("saved_at").dropDuplicates().union(copies.drop("saved_at"))).groupBy(
        "book_id", "page", "pos"
    ).count().filter("count > 1").isEmpty()


def test_only_listed_books_are_read_however_the_list_is(books, store, monkeypatch):
    want = texts(rv.reviews_of_books(books.filter("book_id = 2"), store))
    assert len(want) == 2
    monkeypatch.setattr(keyfilter, "MOST_BLOCKS", 1)
    assert texts(rv.reviews_of_books(books.filter("book_id = 2"), store)) == want


def test_pages_of_other_books_are_not_parsed(spark):
    """The filter of a long list lets its own pages pass, and few others."""
    listed = spark.range(300_000).select(F.concat(F.lit("https://b/"), F.col("id").cast("string")).alias("page_url"))
    store = spark.range(250_000, 350_000, numPartitions=4).select(F.concat(F.lit("https://b/"), F.col("id").cast("string")).alias("page_url"), "id")
    passed = keyfilter.possibly_in(store, "page_url", listed)
    n = passed.filter("id < 300000").count(), passed.filter("id >= 300000").count()
    assert n[0] == 50_000 and n[1] < 0.03 * 50_000
    assert passed.columns == ["page_url", "id"]
    keys = spark.createDataFrame([(None,), ("x",), ("x",)], "page_url string")
    held = spark.createDataFrame([(None, 1), ("x", 2), ("y", 3)], "page_url string, id int")
    assert [r.id for r in keyfilter.possibly_in(held, "page_url", keys).filter("id < 3").collect()] == [2]
    assert keyfilter.possibly_in(held, "page_url", keys.filter("false")).count() == 0


def test_lists_per_book(books, store, monkeypatch):
    def lists(df):
        rows = rv.reviews_per_book(df).orderBy("book_id", "chunk").collect()
        return [(r.book_id, r.chunk, [x.review_text for x in r.reviews]) for r in rows]

    nested = rv.nested_of_books(books, store)
    assert lists(nested) == [("1", 0, ["a", "b", "a", "beyond the count"]), ("2", 0, ["c", "not counted"]), ("3", 0, []), ("4", 0, []), ("5", 0, [])]
    monkeypatch.setattr(rv, "PAGES_PER_LIST", 2)
    assert lists(nested)[:2] == [("1", 0, ["a", "b", "a"]), ("1", 1, ["beyond the count"])]
    twice = rv.nested_of_books(books.union(books), store)
    assert len(lists(twice)) == 2 * len(lists(nested)) and lists(twice)[0] == lists(nested)[0]


def test_failed_answers_and_captchas_are_left_out(books, store):
    answers = store.withColumn("status", F.when(F.col("page") == 2, 500).otherwise(200))
    asks = F.when(F.col("page") == 4, F.concat(F.lit("<p>CAPTCHA"), "html")).otherwise(F.col("html"))
    assert texts(rv.reviews_of_books(books, answers.withColumn("html", asks))) == [
        ("1", 1, 0, "a"), ("1", 1, 1, "b"), ("2", 1, 0, "c"),
    ]


def test_nested_reviews_keep_every_book(books, store):
    rows = rv.nested_of_books(books, store).collect()
    found = sorted((r.book_id, r.page or 0, [x.review_text for x in r.reviews]) for r in rows)
    assert found == [("1", 1, ["a", "b"]), ("1", 2, ["a"]), ("1", 3, []), ("1", 4, ["beyond the count"]), ("2", 1, ["c"]),
                     ("2", 2, ["not counted"]), ("3", 0, []), ("4", 0, []), ("5", 0, [])]


def test_reviews_of_one_url(store):
    rows = rv.reviews_of_url(URL.format(1) + "//", store).orderBy("page", "pos").collect()
    assert [r.review_text for r in rows] == ["a", "b", "a", "beyond the count"]
    assert [r.review_text for r in rv.reviews_of_url(URL.format(2), store).orderBy("page").collect()] == ["c", "not counted"]
    assert rv.reviews_of_url(URL.format(99), store).count() == 0


BOX = '<div class="review" id="review_{0}"><span class="readable"><span>{0}</span></span><div class="shelves">Shelves: x, y</div></div>'


def test_markup_book_table(spark, books):
    def markup(*texts):
        return "<div>" + "".join(BOX.format(t) for t in texts) + "</div>"

    one, two = URL.format(1) + "/reviews", URL.format(2) + "/reviews"
    rows = [
        (one, 1, markup("old", "gone"), 1), (one, 1, markup("a"), 2), (one, 1, markup("a"), 2),
        (one, 2, markup("b", "b"), None), (two, 1, markup("c"), 1), (two, 1, markup(), 2), (one, None, markup("x"), 3),
    ]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA + ", saved_at int")
    found = rv.markup_reviews_of_books(books, pages)
    assert texts(found) == [("1", 1, 0, "a"), ("1", 2, 0, "b"), ("1", 2, 1, "b")]
    assert found.first().shelves == ["x", "y"] and found.first().review_downvotes == 0
    assert rv.markup_reviews_of_books(books, pages, max_pages=1).count() == 1


def test_equal_books_each_get_the_reviews(spark, books, store):
    twice = books.filter("book_id = 2").union(books.filter("book_id = 2"))
    assert rv.reviews_of_books(twice, store).count() == 4


def test_count_of_an_unnumbered_page_comes_before_that_of_page_one(spark, books, store):
    one = URL.format(1) + "/reviews"
    first = spark.createDataFrame([(one, 1, reviews_page(["x"], 2))], PAGE_SCHEMA)
    both = store.filter("page IS NULL").unionByName(first)
    assert rv.with_counts(books.filter("book_id = 1"), both).first().page_count == 3
    assert rv.with_counts(books.filter("book_id = 1"), first).first().page_count == 2


def test_clean_rating(spark):
    ratings = [0.0, 0.99, 1.0, 4.5, 5.0, 5.1, None, float("nan")]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(ratings)], "i int, x double")
    rows = df.select("i", rv.clean_rating(F.col("x")).alias("r")).orderBy("i").collect()
    assert [r.r for r in rows] == [None, None, 1, 4, 5, None, None, None]


def test_report_figures(spark):
    rows = [("1", "u", 5), ("1", "v", 4), ("2", "u", None), (None, None, 4)]
    df = spark.createDataFrame(rows, "book_id string, reviewer_id string, review_rating int")
    assert report.review_summary(df).first() == (4, 2, 2, 4.33)
    assert report.review_summary(df, approximate=True).first() == (4, 2, 2, 4.33)
    assert [tuple(r) for r in report.rating_distribution(df).collect()] == [(4, 2, 50.0), (5, 1, 25.0)]
    books = spark.createDataFrame([("1",), ("2",), ("3",)], "book_id string")
    assert report.review_coverage(books, df.filter("book_id IS NOT NULL")).first() == (3, 2, 66.7, 3, 1.5)
    assert report.review_coverage(books, df.limit(0)).first() == (3, 0, 0.0, 0, None)
    linked = spark.createDataFrame([("u",), (None,), (None,)], "book_url string")
    assert report.link_coverage(linked).first() == (3, 1, 33.3)
    assert report.link_coverage(linked.limit(0)).first() == (0, 0, None)


def test_sample_is_repeatable_and_shows_defaults(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("review_url"), F.repeat(F.lit("x"), 150).alias("review_text"))
    one = report.sample_reviews(df, ["review_url"]).collect()
    assert one == report.sample_reviews(df.repartition(7), ["review_url"]).collect()
    assert len(one) == 5 and one[0].title_shown == "Unknown" and one[0].text_preview == "x" * 100 + "..."
    assert len(report.sample_reviews(df.limit(3), ["review_url"]).collect()) == 3
