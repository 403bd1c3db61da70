import pytest
from conftest import page, page_table
from pyspark.sql import functions as F

from shelfmark.operators import paging


def count(spark, html):
    return paging.with_page_count(page_table(spark, html)).first().page_count


def book(**reviews):
    return {"reviews": reviews}


def test_count_by_review_total(spark):
    # Fixed value: so many reviews make 111 pages.
    stats = {"books": {"current": {"reviewStats": {"totalReviews": 3329}}}}
    assert count(spark, page(initialState=stats)) == 111


@pytest.mark.parametrize("total, pages", [(0, 0), (1, 1), (30, 1), (31, 2), (60, 2)])
def test_ceiling_division(spark, total, pages):
    assert spark.range(1).select(paging.pages_for(F.lit(total))).first()[0] == pages


PAGER = (
    '<div class="pagination"><a>Previous</a><a> 2 </a><a>17</a><span>99</span></div>'
    '<p class="pagination"><a>50</a></p>'
)


@pytest.mark.parametrize(
    "props, expected",
    [
        ({"apolloState": {"ROOT_QUERY": {"book(1)": book(pageInfo={"totalPages": 4})}}}, 4),
        (
            {
                "apolloState": {
                    "ROOT_QUERY": {
                        "book(1)": book(pageInfo={"totalPages": 4}),
                        "book(2)": book(pageInfo={"totalPages": 6}),
                        "book(3)": {"title": "without reviews"},
                        "other(4)": book(pageInfo={"totalPages": 8}),
                    }
                }
            },
            6,
        ),
        ({"apolloState": {"ROOT_QUERY": {"book(1)": book(pageInfo={"hasNext": True})}}}, 1),
        # The last one has no page info, so the earlier one does not count.
        (
            {
                "apolloState": {"ROOT_QUERY": {"book(1)": book(pageInfo={"totalPages": 4}), "book(2)": book(edges=[])}},
                "initialState": {"books": {"current": {"reviewStats": {"totalReviews": 61}}}},
            },
            3,
        ),
        ({"initialState": {"books": {"current": {"reviewStats": {"other": 1}}}}}, 0),
        (
            {
                "initialState": {"books": {"current": {"reviewStats": {}}}},
                "dehydratedState": {
                    "queries": [
                        {"state": {"data": {"book": book(pageInfo={"totalPages": 2})}}},
                        {"state": {"data": {"book": book(pageInfo={"totalPages": 9})}}},
                        {"state": {"data": {"user": {}}}},
                    ]
                },
            },
            9,
        ),
        ({}, 17),
    ],
)
def test_count_sources(spark, props, expected):
    assert count(spark, page(**props) + PAGER) == expected


def test_counts_of_any_size(spark):
    many = {"apolloState": {"ROOT_QUERY": {"book(1)": book(pageInfo={"totalPages": 3_000_000_000})}}}
    assert count(spark, page(**many)) == 3_000_000_000
    stats = {"books": {"current": {"reviewStats": {"totalReviews": 2**62}}}}
    assert count(spark, page(initialState=stats)) == -(-(2**62) // 30)
    assert count(spark, page() + '<div class="pagination"><a>5000000000</a></div>') == 5_000_000_000
    html = '<div class="pagination"><a>5000000000</a></div>'
    assert paging.with_markup_page_count(page_table(spark, html)).first().page_count == 5_000_000_000


def test_failed_answer_counts_one(spark):
    html = page(initialState={"books": {"current": {"reviewStats": {"totalReviews": 3329}}}})
    rows = [(1, html, 200), (2, html, 404), (3, html, None)]
    df = spark.createDataFrame(rows, "i int, html string, status int")
    assert [r.page_count for r in paging.with_page_count(df, status="status").orderBy("i").collect()] == [111, 1, 1]


def test_frontier_of_odd_counts(spark):
    rows = [("1", "u", 3_000_000_000), ("2", "u", 2**63 - 1), ("3", "u", -5), ("4", "u", None), ("5", "u", 2500)]
    df = spark.createDataFrame(rows, "book_id string, book_url string, page_count bigint")
    got = paging.frontier(df, max_pages=2500).groupBy("book_id").agg(F.count("*").alias("n"), F.countDistinct("page").alias("d"), F.max("page").alias("m"))
    assert sorted(tuple(r) for r in got.collect()) == [(i, 2500, 2500, 2500) for i in "125"]
    assert paging.frontier(df, keep_all=True, max_pages=1).count() == 5
    large = paging.frontier(df.filter("book_id = 1")).limit(3)
    assert large.count() == 3


def test_count_without_state_is_one(spark):
    assert count(spark, PAGER) == 1
    assert count(spark, page()) == 1
    assert count(spark, page().replace("}}}", "}") + PAGER) == 1
    assert count(spark, page(apolloState=[1]) + PAGER) == 1
    assert count(spark, '<script id="__NEXT_DATA__">{"other": 1}</script>' + PAGER) == 17


def test_markup_count_uses_all_div_pagers_else_any(spark):
    both = '<div class="x pagination"><a>3</a></div><div class="pagination"><p><a>6</a></div><p class="pagination"><a>9</a></p>'
    only_p = '<p class="pagination"><a>9</a></p>'
    rows = [(1, both, 200), (2, only_p, 200), (3, "<p>", 200), (4, both, 404), (5, None, 200)]
    df = spark.createDataFrame(rows, "i int, html string, status int")
    counted = paging.with_markup_page_count(df, status="status").orderBy("i").collect()
    assert [r.page_count for r in counted] == [6, 9, 1, 0, 0]


@pytest.fixture(scope="module")
def books(spark):
    rows = [("1", "https://x.org/1//", 3), ("2", None, 3), ("3", "", 3), ("4", "https://x.org/4", 0), ("5", "https://x.org/5", 1)]
    return spark.createDataFrame(rows, "book_id string, book_url string, page_count int")


def test_frontier(spark, books):
    def pages(**options):
        return sorted((r.book_id, r.page or 0) for r in paging.frontier(books, **options).collect())

    assert pages() == [("1", 1), ("1", 2), ("1", 3), ("5", 1)]
    assert pages(max_pages=2) == [("1", 1), ("1", 2), ("5", 1)]
    assert pages(max_pages=0) == []
    assert pages(keep_all=True) == [("1", 1), ("1", 2), ("1", 3), ("2", 0), ("3", 0), ("4", 0), ("5", 1)]
    first = paging.frontier(books).orderBy("book_id", "page").first()
    assert (first.page_url, first.page_key) == ("https://x.org/1/reviews", "x.org_1_reviews_page=1")


def test_stored_and_missing(spark, books):
    needed = paging.frontier(books)
    store = spark.createDataFrame([("x.org_1_reviews_page=2",)] * 3 + [("other",)], "page_key string")
    assert [r.page for r in paging.stored_pages(needed, store).collect()] == [2]
    assert paging.missing_pages(needed, store).count() == 3
    assert paging.missing_pages(needed, store, refresh=True).count() == 4


def test_failed_answers_are_no_stored_pages(spark, books):
    needed = paging.frontier(books)
    rows = [("x.org_1_reviews_page=1", 200), ("x.org_1_reviews_page=2", 429), ("x.org_1_reviews_page=3", None), ("x.org_5_reviews_page=1", 500)]
    store = spark.createDataFrame([*rows, ("x.org_5_reviews_page=1", 200)], "page_key string, status int")
    assert [r.page_key for r in paging.missing_pages(needed, store).orderBy("page").collect()] == [rows[1][0], rows[2][0]]
    assert paging.stored_pages(needed, store).count() == 2
    asks = store.filter("status = 200").withColumn("html", F.when(F.col("page_key").endswith("page=1"), "a Captcha").otherwise("<p>"))
    assert paging.stored_pages(needed, asks).count() == 0


def test_a_probe_moves_neither_the_store_nor_its_keys(spark, books, tmp_path):
    needed = paging.frontier(books)
    store = spark.createDataFrame([("x.org_1_reviews_page=2", 200), ("x.org_1_reviews_page=3", 500)], "page_key string, status int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = paging.write_keys(store, "probed_keys", str(tmp_path / "keys"), buckets=8)
        for df, n in ((paging.stored_pages(needed, keys), 1), (paging.missing_pages(needed, keys), 3)):
            text = df._jdf.queryExecution().executedPlan().toString()
            # The keys are the join's last child: scanned from their buckets, without an exchange.
            above = text[: text.index("Bucketed: true")].splitlines()[-4:-1]
            assert "SortMergeJoin" in text and "Bucketed: true" in text
            assert text.count("Exchange hashpartitioning(page_key") == 1 and not any("Exchange" in line for line in above), text
            assert df.count() == n
        more = spark.createDataFrame([("x.org_1_reviews_page=3", 200)], "page_key string, status int")
        keys = paging.write_keys(more, "probed_keys", str(tmp_path / "keys"), buckets=8, append=True)
        assert paging.missing_pages(needed, keys).count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS probed_keys")
