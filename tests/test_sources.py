import pytest
from conftest import PAGE_SCHEMA, page, page_table
from pyspark.sql import functions as F

from shelfmark.operators import copies, quality
from shelfmark.operators.linking import search_page_key
from shelfmark.operators.pagestate import with_reviews
from shelfmark.plans import pipeline
from shelfmark.schema import RAW_RATING
from shelfmark.schema import page_table as page_schema
from shelfmark.schema import required_columns, review_table
from shelfmark.sources import pagefiles, sinks, tables


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
    return str(path)


def test_book_list_headers(spark, tmp_path):
    path = write(tmp_path, "b.csv", 'Author,Book ID,Title,Note\nJ. A.,007,"Pride, ""and""\nPrejudice",x\n,2,Emma,\n')
    df = tables.unlinked(tables.read_book_list(spark, path))
    assert df.columns == ["author", "book_id", "title", "Note", "book_url"]
    assert [tuple(r) for r in df.collect()] == [
        ("J. A.", "007", 'Pride, "and"\nPrejudice', "x", None), (None, "2", "Emma", None, None),
    ]
    with pytest.raises(ValueError, match="author"):
        tables.read_book_list(spark, write(tmp_path, "c.csv", "book_id,title\n1,2\n"))


def test_large_lists_without_line_breaks_are_split(spark, tmp_path):
    rows = "".join(f'{i},"T, {i}",A\n' for i in range(20000))
    path = write(tmp_path, "b.csv", "book_id,title,author\n" + rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    df = tables.read_book_list(spark, path, multi_line=False)
    parts = df.groupBy(F.spark_partition_id()).count().count()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert parts > 3 and df.count() == 20000 and df.filter("title = 'T, 7'").first().book_id == "7"


def test_linked_list_from_table_or_path(spark, tmp_path):
    path = write(tmp_path, "b.csv", "book_id,title,author,book_url\n1,T,A,u\n2,T,A,\n")
    df = tables.linked_books(spark, path)
    assert [r.book_url for r in df.collect()] == ["u", None]
    assert tables.linked_books(spark, df) is df
    with pytest.raises(ValueError, match="book_url"):
        tables.linked_books(spark, df.drop("book_url"))


def test_saved_page_files(spark, tmp_path):
    write(tmp_path, "x.org_1_reviews_page=1.html", page(apolloState={"Review:1": {"text": "é"}}))
    write(tmp_path, "x.org_1_reviews_page=12.html", b"No reviews yet \xff\xfe ok")
    write(tmp_path, "x.org_1_reviews.html", "first é")
    write(tmp_path, "notes.txt", "no")
    rows = {r.page_key: r for r in tables.read_saved_pages(spark, str(tmp_path)).collect()}
    assert {k: r.page for k, r in rows.items()} == {
        "x.org_1_reviews_page=1": 1, "x.org_1_reviews_page=12": 12, "x.org_1_reviews": None,
    }
    assert rows["x.org_1_reviews"].html == "first é" and rows["x.org_1_reviews_page=12"].html.endswith("ok")
    only_first = tables.read_saved_pages(spark, str(tmp_path), "*reviews_page=1.html")
    assert only_first.count() == 1
    keyed = tables.keyed_pages(spark.createDataFrame([("https://x.org/1/reviews", 1, ""), ("https://x.org/1/reviews", None, "")], PAGE_SCHEMA))
    assert keyed.join(tables.read_saved_pages(spark, str(tmp_path)), "page_key").count() == 2


def test_pages_are_written_as_files_in_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pagefiles, "PER_FOLDER", 5)
    keys = [f"x.org_{i}_page={i}" for i in range(12)] + ["_hidden%2B+é &#_page=7", ".dot", "007", "twice", "twice", None, ""]
    rows = [(k, f"text {i} é\n" if i % 2 else None) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "page_key string, html string").coalesce(1)
    pagefiles.write_pages(df, str(tmp_path / "pages"))
    folders = sorted(p.name for p in (tmp_path / "pages").iterdir())
    assert folders == [f"shard=s00000-{i:04d}" for i in range(4)]
    files = [p.name for p in (tmp_path / "pages").rglob("*.html")]
    assert len(files) == 17
    got = {r.page_key: (r.page, r.html) for r in tables.read_saved_pages(spark, str(tmp_path / "pages")).collect()}
    assert got.pop("twice") == (None, "text 15 é\n\n\n")
    texts = {k: f"{t or ''}\n" for k, t in rows[:15]}
    assert {k: h for k, (_, h) in got.items() if k is not None} == texts
    assert got["_hidden%2B+é &#_page=7"][0] == 7 and got["x.org_3_page=3"][0] == 3
    assert got[None] == (None, "text 17 é\n\n\n")
    with pytest.raises(FileExistsError):
        pagefiles.write_pages(df, f"file:{tmp_path}/pages")


def test_many_small_pages_are_read_by_few_tasks(spark, tmp_path):
    df = spark.range(600).select(F.concat(F.lit("k_page="), "id").alias("page_key"), F.col("id").cast("string").alias("html"))
    pagefiles.write_pages(df, str(tmp_path / "pages"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    back = tables.read_saved_pages(spark, str(tmp_path / "pages"))
    n = back.rdd.getNumPartitions()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert n == 16 * spark.sparkContext.defaultParallelism
    assert sorted((r.page, r.html) for r in back.collect()) == [(i, f"{i}\n") for i in range(600)]


def test_no_pages_are_written(spark, tmp_path):
    pagefiles.write_pages(spark.createDataFrame([], "page_key string, html string"), str(tmp_path / "none"))
    assert tables.read_saved_pages(spark, str(tmp_path / "none")).count() == 0


def sample_reviews(spark):
    row = ("1", 'A "title"', None, "u", "line one\nline, two", 4, "007", "", 3, "2023-01-15T00:00:00", "/r")
    return spark.createDataFrame([row], review_table())


def test_review_csv_round_trip(spark, tmp_path):
    df = sample_reviews(spark).withColumn("shelves", F.array(F.lit("a,b"), F.lit("c")))
    written = sinks.write_reviews(df, str(tmp_path / "p"), [str(tmp_path / "c1"), str(tmp_path / "c2")])
    assert written.collect() == df.collect()
    for copy in ("c1", "c2"):
        back = tables.read_reviews(spark, str(tmp_path / copy)).first()
        expected = {**df.first().asDict(), "review_rating": 4.0, "review_rating_raw": "4", "reviewer_name": None}
        assert back.asDict() == expected


def test_packed_review_csv_is_small_and_in_several_files(spark, tmp_path):
    one = sample_reviews(spark).withColumn("shelves", F.array(F.lit("a,b"), F.lit("c")))
    text = F.concat("review_text", F.repeat(F.concat(F.lit('\n"said" no. '), F.col("id").cast("string")), 30))
    df = one.crossJoin(spark.range(0, 45_000, 1, 1)).withColumn("review_text", text).withColumn("reviewer_id", F.col("id").cast("string")).drop("id")
    sinks.write_reviews(df, str(tmp_path / "p"), [str(tmp_path / "c")], packed=True)
    files = list((tmp_path / "c").glob("part-*"))
    assert len(files) >= 3 and all(f.name.endswith(".csv.gz") for f in files) and sum(f.stat().st_size for f in files) < 5_000_000
    back = tables.read_reviews(spark, str(tmp_path / "c")).select("reviewer_id", "review_text")
    assert back.exceptAll(df.select("reviewer_id", "review_text")).isEmpty() and back.count() == 45_000


def test_missing_and_empty_output(spark, tmp_path):
    assert tables.read_reviews(spark, str(tmp_path / "none")) is None
    sinks.write_empty_reviews(spark, str(tmp_path / "empty"))
    back = tables.read_reviews(spark, str(tmp_path / "empty"))
    assert back.drop(RAW_RATING).columns == required_columns() and back.count() == 0


def test_last_copy_of_a_page_counts(spark):
    def html(text):
        return page(apolloState={"Review:1": {"text": text}})

    url = "https://x.org/1"
    rows = [(f"{url}/reviews", 1, html(f"copy {i}"), i) for i in range(50)] + [(f"{url}/reviews", None, html(""), 0)]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA + ", saved_at int").repartition(5)
    books = spark.createDataFrame([("1", "t", "a", url)], "book_id string, title string, author string, book_url string")
    assert [r.review_text for r in pipeline.extract(spark, books, pages).collect()] == ["copy 49"]


def test_ties_and_unknown_times(spark):
    rows = [(1, "k", 5, 1), (2, "k", 5, 2), (3, "k", None, 9), (4, "j", None, 1), (5, "j", None, 2), (6, None, 1, 1)]
    df = spark.createDataFrame(rows, "i int, key string, saved_at int, tie int")
    assert sorted(r.i for r in copies.latest_copies(df, ["key"], "saved_at", "tie").collect()) == [2, 5, 6]
    assert sorted(r.i for r in copies.latest_copies(df.union(df), ["key"], None, "tie").collect()) == [3, 5, 6]


def test_equal_copies_of_a_search_page_link_once(spark):
    key = spark.range(1).select(search_page_key(F.lit("Emma"), F.lit("Jane Austen"))).first()[0]
    pages = spark.createDataFrame([(key, SEARCH, 200), (key, SEARCH, 200), (key, "captcha", 200), (key, "<p>", 500)], "search_key string, html string, status int")
    books = spark.createDataFrame([("1", "Emma", "Jane Austen"), ("2", None, "x")], "book_id string, title string, author string")
    linked = pipeline.link(spark, books, pages).orderBy("book_id").collect()
    assert [r.book_url for r in linked] == ["https://books.example.org/book/show/9.Emma", None]


def test_ordered_csv(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_csv(df, str(tmp_path / "o"), order=["k"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "o").glob("*.csv"))
    rows = [int(x) for f in files for x in f.read_text().split("\n")[1:] if x]
    assert rows == list(range(1000)) and len(files) > 1


def test_quarantine_by_reason(spark, tmp_path):
    pages = page_table(spark, "<p>", page(), page(apolloState={"Review:1": {"text": "a"}}))
    sinks.write_quarantine(with_reviews(pages), str(tmp_path / "q"))
    back = spark.read.parquet(str(tmp_path / "q"))
    assert sorted((r.reason, r.page) for r in back.collect()) == [("no_reviews", 2), ("no_state", 1)]


SEARCH = '<div class="bookTitle"><a href="/book/show/9.Emma">Emma</a><div class="authorName">by Jane Austen</div></div>'


def test_whole_run(spark, tmp_path):
    books = write(tmp_path, "books.csv", "Book ID,Title,Author\n1,Emma,Jane Austen\n2,Nothing,Nobody\n")
    key = spark.range(1).select(search_page_key(F.lit("Emma"), F.lit("Jane Austen"))).first()[0]
    search = spark.createDataFrame([(key, SEARCH)], "search_key string, html string")
    url = "https://books.example.org/book/show/9.Emma/reviews"
    review = {"text": "good", "rating": 5, "createdAt": "2023-01-01T00:00:00", "userId": "u", "userName": "U"}
    state = {"ROOT_QUERY": {"book(9)": {"reviews": {"pageInfo": {"totalPages": 2}}}}, "Review:1": review}
    pages = spark.createDataFrame([(url, n, page(apolloState=state)) for n in (None, 1, 2)], page_schema())
    out = str(tmp_path / "out")
    summary = pipeline.run(spark, books, search, pages, out)
    assert (summary["n_books"], summary["n_linked"], summary["n_reviews"], summary["books_with_reviews"]) == (2, 1, 2, 1)
    assert [r.book_url for r in tables.read_csv(spark, f"{out}/linked").orderBy("book_id").collect()] == [url[: -len("/reviews")], None]
    table = tables.read_reviews(spark, f"{out}/reviews_csv")
    assert [(r.page, r.review_rating) for r in table.orderBy("page").collect()] == [("1", 5.0), ("2", 5.0)]
    rules = quality.run_suite(spark.read.parquet(f"{out}/reviews"), "release").collect()
    assert summary["suite"].collect() == rules and summary["passed"] is True
    passed, report = pipeline.check(spark, f"{out}/reviews_csv", "contract")
    assert passed and all(r.passed for r in report.collect())
    assert pipeline.check(spark, f"{out}/nowhere", "release") == (False, None)
    nothing = pipeline.run(spark, books, search.limit(0), pages, str(tmp_path / "out2"))
    assert nothing["n_reviews"] == 0
    assert tables.read_reviews(spark, f"{tmp_path}/out2/reviews_csv").drop(RAW_RATING).columns == required_columns()
