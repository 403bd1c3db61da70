"""The queries of this repository, each over the whole tables of one scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import markup
from shelfmark.functions import text as tx
from shelfmark.functions import urls
from shelfmark.operators import catalogue, copies, linking, markupreviews, pagecheck, pagestate, paging, policy, quality, report
from shelfmark.operators import reviews as rv
from shelfmark.plans import derived, pipeline
from shelfmark.schema import BOOK_SEQ, RAW_RATING
from shelfmark.session import work_folder
from shelfmark.site import DEFAULT_SITE
from shelfmark.sources import pagefiles, sinks, tables
from shelfmark.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RULES_TEXT = """
User-agent: slowbot
Disallow: /fr/1
Disallow: /de

User-agent: *
Disallow: /en
Allow: /en/1
Disallow: /*.html$
Disallow: /es/*7
Allow: /es/17
Disallow:
"""


def query(fn: Query) -> Query:
    """Register under the function's name; whole numbers come out as bigint."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        small = (T.IntegerType, T.ShortType, T.ByteType)
        return df.select(
            *[F.col(f.name).cast("bigint").alias(f.name) if isinstance(f.dataType, small) else f.name for f in df.schema]
        )

    QUERIES[fn.__name__] = run
    return fn


# Book lists, keys and URLs


@query
def booklist_alias_required(spark, sf_dir):
    part = derived.table(spark, sf_dir, "part")
    listed = part.select(
        F.col("p_partkey").alias("Book ID"), F.col("p_name").alias("Title"), F.col("p_brand").alias("Author"), "p_size"
    )
    return tables.unlinked(listed)


@query
def booklist_csv(spark, sf_dir):
    """A book list as a CSV file, with quotes and line ends in its fields, read by its header."""
    folder = work_folder(spark, "books")
    part = derived.table(spark, sf_dir, "part")
    listed = part.select(
        F.col("p_partkey").alias("Book ID"),
        F.concat("p_name", F.lit(' "new", vol. 1\n'), "p_type").alias("Title"),
        F.when(F.col("p_partkey") % 9 != 4, F.col("p_brand")).alias("Author"),
        "p_size",
    )
    sinks.write_csv(listed, f"{folder}/books")
    return tables.read_book_list(spark, f"{folder}/books")


@query
def search_key_encoded(spark, sf_dir):
    part = derived.table(spark, sf_dir, "part")
    title = F.concat("p_name", F.lit(" & sons* ~"), F.col("p_type"))
    return part.select(
        "p_partkey",
        urls.search_query(title, F.col("p_brand")).alias("search_query"),
        urls.search_parameters(title, F.col("p_brand")).alias("parameters"),
        linking.search_page_key(title, F.col("p_brand")).alias("search_key"),
    )


@query
def review_page_urls(spark, sf_dir):
    return derived.books(spark, sf_dir).select("book_id", urls.reviews_url(F.col("book_url")).alias("page_url"))


@query
def page_key(spark, sf_dir):
    pages = derived.table(spark, sf_dir, "pages")
    long = F.concat("url", F.lit("/é ü"), F.repeat("url", F.col("page_id").cast("int") % 6))
    parameters = F.create_map(F.lit("sort"), F.lit("new"), F.lit("page"), F.col("page_id").cast("string"))
    return pages.select(
        "page_id",
        urls.flat_page_key(long, F.lit("q=a+b")).alias("flat_key"),
        urls.readable_page_key(long).alias("readable_key"),
        urls.readable_page_key(F.col("url"), parameters).alias("readable_key_with_parameters"),
    )


@query
def canonical_url(spark, sf_dir):
    pages = derived.table(spark, sf_dir, "pages")
    relative = F.when(F.col("page_id") % 3 == 0, F.regexp_replace("url", "^https?://[^/]+", "")).otherwise(F.col("url"))
    return pages.select(
        "page_id", urls.canonical_url(relative).alias("url"), urls.url_path(F.col("url")).alias("path")
    )


@query
def id_from_url(spark, sf_dir):
    pages = derived.table(spark, sf_dir, "pages")
    url = F.regexp_replace("url", "/(en|es)/", "/book/show/")
    user = F.regexp_replace("url", "/(de|fr)/", "/user/show/")
    return pages.select(
        "page_id", urls.catalogue_id(url).alias("catalogue_id"), urls.user_id(user).alias("user_id")
    )


@query
def author_clean(spark, sf_dir):
    part = derived.table(spark, sf_dir, "part")
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" by  "), "p_brand", F.lit("  "))).when(
        F.col("p_partkey") % 3 == 1, F.concat(F.lit("bystander "), "p_brand")
    ).otherwise(F.concat(F.lit("by "), "p_brand"))
    return part.select("p_partkey", urls.clean_author(raw).alias("author"))


@query
def date_formats(spark, sf_dir):
    orders = derived.table(spark, sf_dir, "orders")
    day, no = F.col("o_orderdate"), F.col("o_orderkey")
    shown = (
        F.when(no % 5 == 0, F.date_format(day, "MMM d, yyyy"))
        .when(no % 5 == 1, F.date_format(day, "MMMM dd, yyyy"))
        .when(no % 5 == 2, F.date_format(day, "yyyy-MM-dd"))
        .when(no % 5 == 3, F.date_format(day, "yyyy-M-d"))
        .otherwise(F.date_format(day, "dd.MM.yyyy"))
    )
    return orders.select("o_orderkey", shown.alias("shown"), tx.parse_date(shown).alias("iso"))


# Which pages are needed, and which are stored


def _counted_books(spark, sf_dir):
    """Books with page counts from review counts: no page is read for it."""
    counts = (
        derived.reviews(spark, sf_dir, with_text=False)
        .groupBy("book_no")
        .agg(paging.pages_for(F.count("*")).alias("page_count"))
    )
    return derived.books(spark, sf_dir).join(counts, "book_no", "left").fillna(0, ["page_count"])


@query
def page_frontier(spark, sf_dir):
    needed = paging.frontier(_counted_books(spark, sf_dir), max_pages=5)
    return needed.select("book_id", "page", "page_url", "page_key")


def _stored_keys(spark, sf_dir):
    """Keys of a store that holds every second page of a book, some of them several times."""
    held = paging.frontier(_counted_books(spark, sf_dir)).filter((F.col("page") + F.col("book_no")) % 2 == 0)
    return held.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(1) + (F.col("book_no") % 3).cast("int"))))


@query
def page_frontier_odd_counts(spark, sf_dir):
    """Counts that are too large to be true, zero, negative and unknown."""
    odd = (
        F.when(F.col("book_no") % 4 == 0, F.lit(3_000_000_000))
        .when(F.col("book_no") % 4 == 1, F.lit(2**62))
        .when(F.col("book_no") % 4 == 2, F.col("book_no") % 9 - 2)
    )
    needed = paging.frontier(derived.books(spark, sf_dir).withColumn("page_count", odd), max_pages=1200)
    return needed.groupBy("book_id").agg(F.count("*").alias("n_pages"), F.max("page").alias("last_page"))


@query
def cache_hits(spark, sf_dir):
    needed = paging.frontier(_counted_books(spark, sf_dir))
    return paging.stored_pages(needed, _stored_keys(spark, sf_dir)).select("book_id", "page", "page_key")


@query
def cache_misses(spark, sf_dir):
    needed = paging.frontier(_counted_books(spark, sf_dir))
    return paging.missing_pages(needed, _stored_keys(spark, sf_dir)).select("book_id", "page", "page_key")


def _answered_keys(spark, sf_dir):
    """The store's keys with the answers' status: some failed and were asked for again later."""
    held = _stored_keys(spark, sf_dir)
    failed = (F.col("page") + F.col("copy")) % 3 == 0
    return held.withColumn("status", F.when(failed, 429).when(F.col("page") % 7 == 5, F.lit(None)).otherwise(200)).drop("book_no")


@query
def cache_misses_by_status(spark, sf_dir):
    """A failed answer is no stored page."""
    needed = paging.frontier(_counted_books(spark, sf_dir))
    return paging.missing_pages(needed, _answered_keys(spark, sf_dir)).select("book_id", "page", "page_key")


@query
def cache_probe_bucketed(spark, sf_dir):
    """Hits and misses against a table of keys that lies in buckets, written in two deliveries."""
    folder = work_folder(spark, "keys")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    held = sinks.stored_below(folder)(_answered_keys(spark, sf_dir), "held")
    paging.write_keys(held.filter("page % 2 = 0"), name, f"{folder}/keys", buckets=8)
    keys = paging.write_keys(held.filter("page % 2 = 1"), name, f"{folder}/keys", buckets=8, append=True)
    needed = sinks.stored_below(folder)(paging.frontier(_counted_books(spark, sf_dir)), "needed")
    hits = paging.stored_pages(needed, keys).select("book_id", "page", F.lit(True).alias("stored"))
    return hits.union(paging.missing_pages(needed, keys).select("book_id", "page", F.lit(False)))


@query
def url_policy(spark, sf_dir):
    pages = derived.table(spark, sf_dir, "pages").select("page_id", urls.url_path(F.col("url")).alias("path"))
    return policy.with_policy(pages, "path", policy.parse_rules(RULES_TEXT), "any_agent")


@query
def url_policy_agent(spark, sf_dir):
    pages = derived.table(spark, sf_dir, "pages").select("page_id", urls.url_path(F.col("url")).alias("path"))
    return policy.with_policy(pages, "path", policy.parse_rules(RULES_TEXT), "agent")


@query
def url_policy_joined(spark, sf_dir):
    """The rules as a table that is joined, with wildcards, lengths and permissions."""
    pages = derived.table(spark, sf_dir, "pages").select("page_id", urls.url_path(F.col("url")).alias("path"))
    return policy.with_policy_joined(pages, "path", policy.parse_rules(RULES_TEXT), "agent")


# Linking


def _match_columns(matched):
    return matched.select(
        "book_id",
        F.col("match.title").alias("match_title"),
        F.col("match.author").alias("match_author"),
        F.col("match.catalogue_id").alias("match_id"),
        F.round("match_score", 6).alias("score"),
    )


@query
def fuzzy_best_match(spark, sf_dir):
    books = derived.book_queries(spark, sf_dir)
    return _match_columns(
        linking.with_best_match(books.join(derived.result_candidates(spark, sf_dir), "book_no", "left"))
    )


def _search_store(spark, sf_dir):
    """Search pages in several copies: older and undated ones with other content, and equal ones."""
    pages = derived.keyed_search_pages(spark, sf_dir)
    copies = F.array(
        F.struct(F.lit(2).alias("saved_at"), F.col("html")),
        F.struct(F.lit(2).alias("saved_at"), F.col("html")),
        F.struct(F.lit(1).alias("saved_at"), F.lit("<html></html>").alias("html")),
        F.struct(F.lit(None).cast("int").alias("saved_at"), F.lit("<html>none</html>").alias("html")),
    )
    return pages.withColumn("c", F.explode(copies)).select("search_key", "c.saved_at", "c.html")


def _linked(spark, sf_dir):
    books = derived.book_queries(spark, sf_dir).select("book_id", "title", "author")
    return pipeline.link(spark, books, _search_store(spark, sf_dir))


@query
def linked_books(spark, sf_dir):
    return _linked(spark, sf_dir)


@query
def link_coverage(spark, sf_dir):
    return report.link_coverage(_linked(spark, sf_dir))


@query
def catalogue_best_match(spark, sf_dir):
    """All books against all parts, without a search page to narrow them down."""
    folder = work_folder(spark, "catalogue")
    parts = derived.table(spark, sf_dir, "part").select(
        F.col("p_name").alias("title"), F.col("p_brand").alias("author"), F.col("p_partkey").cast("string").alias("catalogue_id"), "p_partkey"
    )
    books = derived.book_queries(spark, sf_dir).select("book_id", "title", "author")
    return _match_columns(catalogue.with_best_entry(books, parts, "p_partkey", stored=sinks.stored_below(folder)))


@query
def html_search_candidates(spark, sf_dir):
    return markupreviews.candidate_rows(markupreviews.with_candidates(derived.search_pages(spark, sf_dir)))


# Reviews from embedded state


def _by_shape(shape: str | None):
    def run(spark, sf_dir):
        pages = derived.state_pages(spark, sf_dir, shape)
        return pagestate.review_rows(pagestate.with_reviews(pages)).drop("page_url", "shape")

    return run


for _name, _shape in {
    "reviews_by_ref": "edges",
    "reviews_all_entities": "entities",
    "reviews_inline_state": "state",
    "reviews_inline_data": "data",
    "reviews_dehydrated": "queries",
    "reviews_fallback_mix": None,
}.items():
    _run = _by_shape(_shape)
    _run.__name__ = _name
    query(_run)


def _bad_pages(spark, sf_dir):
    """Saved pages with some states cut short, taken out, emptied or going on after their end, some
    behind a state in a comment, and some in a comment themselves."""
    pages = derived.state_pages(spark, sf_dir)
    kind = (F.col("book_no") + F.col("page")) % 8
    hidden = '<!-- <script id="__NEXT_DATA__">{"props":{"pageProps":{}}}</script> -->'
    html = (
        F.when(kind == 0, F.regexp_replace("html", r"\}\s*</script>", "</script>"))
        .when(kind == 1, F.replace("html", F.lit("__NEXT_DATA__"), F.lit("__OTHER_DATA__")))
        .when(kind == 2, F.lit('<script id="__NEXT_DATA__">{"props":{"pageProps":{}}}</script>'))
        .when(kind == 3, F.regexp_replace("html", r"\}\s*</script>", "} }more</script>"))
        .when(kind == 4, F.concat(F.lit(hidden), "html"))
        .when(kind == 5, F.concat(F.lit("<!-- "), "html", F.lit(" -->")))
        .otherwise(F.col("html"))
    )
    return pages.withColumn("html", html)


@query
def quarantine_pages(spark, sf_dir):
    bad = pagecheck.quarantine(pagestate.with_reviews(_bad_pages(spark, sf_dir)))
    return bad.select("book_no", "page", "reason", F.char_length("state_json").isNotNull().alias("has_state"))


@query
def quarantine_written(spark, sf_dir):
    """The pages without reviews, written by reason and read again."""
    folder = work_folder(spark, "quarantine")
    sinks.write_quarantine(pagestate.with_reviews(_bad_pages(spark, sf_dir)), f"{folder}/pages")
    return spark.read.parquet(f"{folder}/pages").groupBy("reason", "book_no").agg(F.count("*").alias("n_pages"))


@query
def odd_state_reviews(spark, sf_dir):
    """What the pages of which some states are odd still give."""
    found = pagestate.review_rows(pagestate.with_reviews(_bad_pages(spark, sf_dir)))
    return found.select("book_no", "page", "pos", "reviewer_id", "reviewer_name", "review_rating")


@query
def page_count_json(spark, sf_dir):
    return paging.with_page_count(derived.state_pages(spark, sf_dir)).select("book_no", "page", "shape", "page_count")


@query
def page_count_answers(spark, sf_dir):
    """Page counts where some answers failed: those count one page."""
    status = F.when(F.col("book_no") % 7 == 3, 404).when(F.col("book_no") % 7 == 4, F.lit(None)).otherwise(200)
    pages = derived.state_pages(spark, sf_dir).withColumn("status", status)
    return paging.with_page_count(pages, status="status").select("book_no", "page", "page_count")


@query
def page_count_html(spark, sf_dir):
    pages = derived.markup_pages(spark, sf_dir)
    status = F.when(F.col("book_no") % 7 == 3, 404).otherwise(200)
    counted = paging.with_markup_page_count(pages.withColumn("status", status), status="status")
    return counted.select("book_no", "page", "page_count")


# Reviews from markup


@query
def html_review_fields(spark, sf_dir):
    found = markupreviews.markup_reviews(derived.markup_pages(spark, sf_dir).select("book_no", "page", "html"))
    return found.withColumn("shelves", F.array_join("shelves", "|"))


@query
def page_title_links(spark, sf_dir):
    pages = derived.table(spark, sf_dir, "pages")
    found = pages.withColumn("found", markup.scan(F.col("html"), ["title", "nav a", "article h1"]))
    items, pieces = F.col("found.elements"), F.col("found.pieces")
    links = markup.matching(items, "nav a")
    title = markup.text_of(markup.first_match(items, "title"), pieces)
    return found.select(
        "page_id",
        title.alias("title"),
        F.size(links).alias("n_nav_links"),
        F.array_join(F.transform(links, lambda e: e["href"]), " ").alias("nav_links"),
        (title == markup.text_of(markup.first_match(items, "article h1"), pieces)).alias("title_is_heading"),
    )


# Books, pages and reviews together


def _listed(spark, sf_dir):
    return derived.books(spark, sf_dir).drop("plain_url", "book_no")


@query
def flat_reviews(spark, sf_dir):
    return rv.reviews_of_books(_listed(spark, sf_dir), derived.saved_pages(spark, sf_dir))


@query
def flat_reviews_gaps(spark, sf_dir):
    """A store without first pages: what it holds is extracted, whatever count was printed there."""
    pages = derived.saved_pages(spark, sf_dir).filter("page > 1")
    return rv.reviews_of_books(_listed(spark, sf_dir), pages).select("book_id", "page", "pos", "reviewer_id")


@query
def nested_reviews(spark, sf_dir):
    nested = rv.nested_of_books(_listed(spark, sf_dir), derived.saved_pages(spark, sf_dir))
    return nested.select(
        "book_id",
        "title",
        "author",
        "page",
        F.size("reviews").alias("n_reviews"),
        F.array_join(F.transform("reviews", lambda r: r["reviewer_id"]), "|").alias("reviewer_ids"),
        F.array_join(F.transform("reviews", lambda r: F.md5(r["review_text"])), "|").alias("text_digests"),
    )


@query
def reviews_per_book(spark, sf_dir):
    """Every book with its list of reviews; the book with a third of them in several rows."""
    listed = rv.reviews_per_book(rv.nested_of_books(_listed(spark, sf_dir), derived.saved_pages(spark, sf_dir)))
    return listed.select(
        "book_id",
        "title",
        "chunk",
        F.size("reviews").alias("n_reviews"),
        F.md5(F.array_join(F.transform("reviews", lambda r: r["reviewer_id"]), "|")).alias("reviewer_ids"),
        F.md5(F.array_join(F.transform("reviews", lambda r: F.md5(r["review_text"])), "|")).alias("text_digests"),
    )


@query
def single_book_reviews(spark, sf_dir):
    return rv.reviews_of_url(f"{DEFAULT_SITE.base_url}/book/show/0.Book_0", derived.saved_pages(spark, sf_dir))


@query
def answered_reviews(spark, sf_dir):
    """Pages with failed answers and captchas among them, and older copies of the others."""
    pages = derived.state_pages(spark, sf_dir, packed=False)
    kind = (F.col("book_no") + F.col("page")) % 5
    copies = F.array(
        F.struct(F.lit(5).alias("saved_at"), F.col("html")),
        F.struct(F.lit(5).alias("saved_at"), F.col("html")),
        F.struct(F.lit(4).alias("saved_at"), F.lit("<html></html>").alias("html")),
    )
    stored = pages.select(
        "page_url",
        "page",
        F.when(kind == 1, 404).otherwise(200).alias("status"),
        F.explode(copies).alias("c"),
        (kind == 2).alias("asks"),
    )
    html = F.when(F.col("asks"), F.concat(F.lit("<b>Captcha</b>"), "c.html")).otherwise(F.col("c.html"))
    stored = stored.select("page_url", "page", "status", "c.saved_at", html.alias("html"))
    return pipeline.extract(spark, _listed(spark, sf_dir), stored).select("book_id", "page", "pos", "reviewer_id", "review_rating")


@query
def flat_markup_reviews(spark, sf_dir):
    found = rv.markup_reviews_of_books(_listed(spark, sf_dir), _markup_store(spark, sf_dir))
    return found.withColumn("shelves", F.array_join("shelves", "|"))


def _markup_store(spark, sf_dir):
    return derived.markup_pages(spark, sf_dir).select("page_url", "page", "html")


@query
def markup_csv_round_trip(spark, sf_dir):
    """The whole table of reviews in markup, with its texts and arrays, written as CSV and read again."""
    folder = work_folder(spark, "markup")
    found = rv.markup_reviews_of_books(_listed(spark, sf_dir), _markup_store(spark, sf_dir))
    sinks.write_reviews(found, f"{folder}/reviews", [f"{folder}/csv"], packed=True)
    back = tables.read_reviews(spark, f"{folder}/csv").drop(RAW_RATING)
    return back.withColumn("shelves", F.array_join("shelves", "|"))


@query
def linked_list_round_trip(spark, sf_dir):
    """The linked list written as CSV and read again by its path."""
    folder = work_folder(spark, "linked")
    sinks.write_csv(_listed(spark, sf_dir), f"{folder}/linked")
    return tables.linked_books(spark, f"{folder}/linked")


@query
def empty_reviews_written(spark, sf_dir):
    """A run that finds nothing leaves a header; the books are those whose pages are not stored."""
    folder = work_folder(spark, "empty")
    pages = derived.saved_pages(spark, sf_dir).filter("page < 0")
    found = rv.reviews_of_books(_listed(spark, sf_dir), pages)
    if found.isEmpty():
        sinks.write_empty_reviews(spark, f"{folder}/csv")
    back = tables.read_csv(spark, f"{folder}/csv")
    return back.agg(F.lit(",".join(back.columns)).alias("header"), F.count("*").alias("n_rows"))


@query
def ordered_csv(spark, sf_dir):
    """A table written in order: no row before a smaller one in its file, no file across another."""
    folder = work_folder(spark, "ordered")
    table = derived.flat_table(spark, sf_dir, with_text=False).select("event_id", "book_id")
    sinks.write_csv(table, f"{folder}/csv", order=["event_id"])
    rows = tables.read_csv(spark, f"{folder}/csv", multi_line=False).select(
        F.col("event_id").cast("bigint"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at")
    )
    before = F.lag("event_id").over(Window.partitionBy("file").orderBy("at"))
    files = rows.withColumn("before", before).groupBy("file").agg(
        F.count("*").alias("n"), F.count_if(F.col("before") > F.col("event_id")).alias("wrong"),
        F.min("event_id").alias("lo"), F.max("event_id").alias("hi"),
    )
    files = files.withColumn("last", F.lag("hi").over(Window.orderBy("file")))
    return files.agg(
        F.sum("n").alias("n_rows"), F.sum("wrong").alias("n_unordered"), F.count_if(F.col("last") > F.col("lo")).alias("n_overlapping")
    )


@query
def list_order_written(spark, sf_dir):
    """A book list in no order of its own, read from CSV; its reviews are written in the list's order,
    then in reading order, and numbered as they stand in the files."""
    folder = work_folder(spark, "list")
    listed = _listed(spark, sf_dir).withColumn("mixed", F.md5("book_id"))
    sinks.write_csv(listed, f"{folder}/books", order=["mixed"])
    books = tables.read_book_list(spark, f"{folder}/books", seq=BOOK_SEQ)
    found = rv.reviews_of_books(books, derived.saved_pages(spark, sf_dir))
    sinks.write_csv(found.drop("review_url", "title"), f"{folder}/reviews", order=[BOOK_SEQ, "page", "pos"], packed=True)
    back = tables.read_csv(spark, f"{folder}/reviews", seq="n")
    number = lambda c: F.col(c).cast("bigint").alias(c)
    return back.select("n", number(BOOK_SEQ), "book_id", number("page"), number("pos"), "reviewer_id", F.md5("review_text").alias("digest"))


def _deliveries(spark, pages) -> str:
    """Pages in two deliveries, the second with most of the first again; some answers failed.

    Page 0 mod 4 comes twice in the first delivery. Failed answers come right in the second.
    """
    folder = work_folder(spark, "incremental")
    numbered = sinks.stored_below(folder)(pages.select("book_no", "page_url", "page", "html"), "all")
    pages = numbered.withColumn("kind", (F.col("book_no") + F.col("page")) % 4)
    at = lambda day: F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp").alias("saved_at")
    copies_ = F.explode(F.when(F.col("kind") == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    failed = F.when(F.col("kind") == 1, 429).otherwise(200).alias("status")
    first = pages.filter("kind < 3").select("page_url", "page", "html", failed, at(1), copies_.alias("copy")).drop("copy")
    second = pages.filter("kind > 0").select("page_url", "page", "html", F.lit(200).alias("status"), at(2))
    for name, arrived in (("first", first), ("second", second), ("third", None)):
        if arrived is not None:
            arrived.write.mode("append").options(**sinks.PARQUET).parquet(f"{folder}/pages")
        stream = incremental.page_stream(spark, f"{folder}/pages", extra="status int, saved_at timestamp")
        incremental.take_in(stream, f"{folder}/out", name)
    return f"{folder}/out"


@query
def incremental_reviews(spark, sf_dir):
    """All deliveries; a page counts once, however often and in whichever run it came."""
    out = _deliveries(spark, derived.state_pages(spark, sf_dir))
    return incremental.latest(spark, out).drop("page_url", "version", "saved_at", "delivery", "status")


@query
def incremental_quarantine(spark, sf_dir):
    """Pages without reviews that the runs put aside, by reason."""
    rows = spark.read.parquet(f"{_deliveries(spark, _bad_pages(spark, sf_dir))}/quarantine")
    return rows.groupBy("reason").agg(F.count("*").alias("n_pages"), F.countDistinct("page_url", "page").alias("n_different"))


@query
def incremental_summary(spark, sf_dir):
    """Figures from the deliveries' sketches, next to the exact ones, which they have to be close to."""
    out = _deliveries(spark, derived.state_pages(spark, sf_dir))
    rows = spark.read.parquet(f"{out}/reviews")
    exact = {f"exact_{c}": rows.agg(F.countDistinct(c)).scalar() for c in ("page_url", "reviewer_id")}
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.05 * F.col(b)
    return incremental.summary(spark, out).withColumns(exact).select(
        "n_deliveries", "n_reviews", "avg_rating", F.col("exact_page_url").alias("books"), F.col("exact_reviewer_id").alias("reviewers"),
        near("n_books", "exact_page_url").alias("books_close"), near("n_reviewers", "exact_reviewer_id").alias("reviewers_close"),
    )


@query
def csv_round_trip(spark, sf_dir):
    folder = work_folder(spark, "csv")
    sinks.write_reviews(derived.flat_table(spark, sf_dir), f"{folder}/reviews", [f"{folder}/csv"], packed=True)
    return tables.read_reviews(spark, f"{folder}/csv").drop(RAW_RATING)


# Pages as such


def _answers(spark, sf_dir):
    """Pages with a response status, some asking to solve a captcha, some without reviews."""
    pages = derived.table(spark, sf_dir, "pages")
    codes = F.array(*[F.lit(n) for n in (200, 404, 429, 500, 503, 301)])
    html = (
        F.when(F.col("page_id") % 11 == 3, F.concat("html", F.lit("<b>reCAPTCHA</b>")))
        .when(F.col("page_id") % 11 == 4, F.concat(F.lit("<p>No reviews yet</p>"), "html"))
        .otherwise(F.col("html"))
    )
    status = F.element_at(codes, (F.col("page_id") % 6 + 1).cast("int"))
    return pages.select("page_id", status.alias("status"), html.alias("html"))


@query
def page_class(spark, sf_dir):
    return _answers(spark, sf_dir).select(
        "page_id",
        pagecheck.response_class(F.col("status"), F.col("html")).alias("response_class"),
        pagecheck.is_captcha(F.col("html")).alias("captcha"),
        pagecheck.says_no_reviews(F.col("html")).alias("no_reviews"),
    )


@query
def usable_pages(spark, sf_dir):
    return pagecheck.usable_pages(_answers(spark, sf_dir)).select(
        "page_id", F.char_length("html").alias("n_chars")
    )


@query
def empty_pages(spark, sf_dir):
    return pagecheck.empty_pages(_answers(spark, sf_dir))


@query
def first_pages(spark, sf_dir):
    pages = derived.table(spark, sf_dir, "pages")
    return pagecheck.first_pages(pages.select(urls.readable_page_key(F.col("url")).alias("page_key"), "page_id"), 10)


@query
def latest_pages(spark, sf_dir):
    """Every third of the pages is a copy of one and the same page; some times are equal or unknown."""
    pages = derived.table(spark, sf_dir, "pages")
    key = F.when(F.col("page_id") % 3 == 0, "the same").otherwise(urls.readable_page_key(F.col("url")))
    saved_at = F.when(F.col("page_id") % 5 != 0, F.expr("page_id div 10"))
    narrow = pages.select(
        key.alias("page_key"), "page_id", F.char_length("html").alias("n_chars"), saved_at.alias("saved_at")
    )
    return copies.latest_copies(narrow, ["page_key"], "saved_at", "page_id").drop("saved_at")


@query
def saved_page_files(spark, sf_dir):
    """Pages saved as a file each, those of one kind read again by a pattern."""
    folder = work_folder(spark, "files")
    pages = derived.table(spark, sf_dir, "pages")
    numbered = F.create_map(F.lit("page"), F.col("page_id").cast("string"))
    keyed = pages.select(urls.readable_page_key(F.col("url"), numbered).alias("page_key"), "html")
    pagefiles.write_pages(keyed, f"{folder}/pages")
    back = tables.read_saved_pages(spark, f"{folder}/pages", "*.html")
    # The writer ends each file with a line feed.
    return back.select("page_key", "page", F.md5(F.regexp_replace("html", r"\n\z", "")).alias("digest"))


@query
def entity_profile(spark, sf_dir):
    return pagecheck.entity_profile(derived.state_pages(spark, sf_dir, "entities")).drop("page_url", "shape")


@query
def entity_types(spark, sf_dir):
    return pagecheck.entity_types(derived.state_pages(spark, sf_dir))


@query
def review_content(spark, sf_dir):
    return pagecheck.review_content(derived.state_pages(spark, sf_dir, "entities"))


# Quality and reports


def _suite(name: str):
    def run(spark, sf_dir):
        table = derived.flat_table(spark, sf_dir, defects=True).drop("event_id")
        return quality.run_suite(table, name)

    return run


for _suite_name in quality.SUITES:
    _run = _suite(_suite_name)
    _run.__name__ = f"quality_{_suite_name}"
    query(_run)


@query
def quality_while_writing(spark, sf_dir):
    """The verdict on a table, taken from its rows as they are written."""
    folder = work_folder(spark, "watched")
    table, report_of = quality.watched(derived.flat_table(spark, sf_dir, defects=True).drop("event_id"), "release")
    sinks.write_reviews(table, f"{folder}/reviews")
    return report_of()


@query
def quality_read_csv(spark, sf_dir):
    """A table read from CSV, with words among the ratings, one column missing and two too many."""
    folder = work_folder(spark, "quality")
    table = derived.flat_table(spark, sf_dir, defects=True)
    rating = F.when(F.col("event_id") % 53 == 14, "five").otherwise(F.col("review_rating").cast("string"))
    sinks.write_csv(table.withColumn("review_rating", rating).drop("review_upvotes"), f"{folder}/csv", packed=True)
    back = tables.read_reviews(spark, f"{folder}/csv")
    return quality.run_suites(back, ["sample", "release"])


@query
def quality_violations(spark, sf_dir):
    return quality.first_broken(derived.flat_table(spark, sf_dir, defects=True), "subset", ["event_id"])


@query
def real_dates(spark, sf_dir):
    table = derived.flat_table(spark, sf_dir, defects=True)
    return table.agg(
        F.count_if(~tx.is_iso_timestamp(F.col("review_date"))).alias("wrong_form"),
        F.count_if(~tx.is_real_timestamp(F.col("review_date"))).alias("wrong_form_or_day"),
    )


@query
def review_summary(spark, sf_dir):
    return report.review_summary(derived.flat_table(spark, sf_dir, with_text=False))


@query
def rating_distribution(spark, sf_dir):
    return report.rating_distribution(derived.flat_table(spark, sf_dir, with_text=False))


@query
def review_coverage(spark, sf_dir):
    return report.review_coverage(
        derived.books(spark, sf_dir), derived.flat_table(spark, sf_dir, with_text=False)
    )


@query
def sample_reviews(spark, sf_dir):
    return report.sample_reviews(derived.flat_table(spark, sf_dir), ["event_id"])


@query
def first_reviews(spark, sf_dir):
    return report.first_reviews(derived.flat_table(spark, sf_dir, with_text=False), ["event_id"]).select(
        "event_id", "title", "reviewer_id", "review_rating"
    )


@query
def preview_reviews(spark, sf_dir):
    table = derived.flat_table(spark, sf_dir, defects=True)
    return table.select(
        "event_id",
        tx.preview(F.col("review_text"), 100).alias("short"),
        tx.preview(F.col("review_text"), 500).alias("long"),
        tx.display(F.col("review_date")).alias("date_shown"),
    )
