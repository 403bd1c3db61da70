"""How many review pages a book has, and which pages are therefore needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.jsonmap import as_map, or_empty, parse
from shelfmark.functions.markup import first_filled, first_match, largest_number, matching, scan, within
from shelfmark.functions.once import compute_once
from shelfmark.functions.urls import review_page_key, reviews_url
from shelfmark.operators.copies import answered
from shelfmark.operators.pagestate import book_queries, with_state
from shelfmark.site import DEFAULT_SITE, Site

PAGER = ".pagination"
PAGER_LINK = ".pagination a"
DIV_PAGER_LINK = "div.pagination a"

# Pages of a book that fan out in one task.
PAGES_PER_BLOCK = 1000
# No count is taken to mean more pages than this.
MOST_PAGES = 10**15


def pages_for(reviews: Column, per_page: int = DEFAULT_SITE.reviews_per_page) -> Column:
    """Ceiling division of whole numbers, of any size."""
    n = reviews.cast("bigint")
    whole = F.call_function("div", n, F.lit(per_page).cast("bigint"))
    return whole + F.when(n % F.lit(per_page) > 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _query_page_info(root: Column) -> Column:
    """Page info of the last book query that has reviews."""
    with_reviews = F.filter(
        F.transform(book_queries(root), as_map), lambda q: F.coalesce(F.map_contains_key(q, "reviews"), F.lit(False))
    )
    last = F.try_element_at(with_reviews, F.lit(-1))
    return as_map(parse(last["reviews"], "pageInfo string")["pageInfo"])


def _dehydrated_page_info(dehydrated: Column) -> Column:
    """Page info of the last dehydrated query that is about a book."""
    queries = or_empty(parse(dehydrated, "queries array<string>")["queries"], "string")
    data = F.transform(queries, lambda q: as_map(parse(q, "state struct<data string>")["state"]["data"]))
    about_book = F.filter(data, lambda d: F.coalesce(F.map_contains_key(d, "book"), F.lit(False)))
    last = F.try_element_at(about_book, F.lit(-1))
    return as_map(parse(last["book"], "reviews struct<pageInfo string>")["reviews"]["pageInfo"])


def with_page_count(
    pages: DataFrame, html: str = "html", site: Site = DEFAULT_SITE, status: str | None = None
) -> DataFrame:
    """Add ``page_count`` from the embedded state, else from the first pager of the markup, else 1.

    A failed page, where ``status`` names the column of answers, counts 1.

    Only pages whose state lacks the number are handed to the markup scan.
    """
    kept = pages.columns
    col = F.col
    staged = (
        with_state(pages.withColumn("_html", col(html)), "_html")
        .withColumn("info", _query_page_info(col("root")))
        .withColumn(
            "stats",
            F.when(
                F.coalesce(F.size("info"), F.lit(0)) == 0,
                as_map(
                    parse(col("initial_state"), "books struct<current struct<reviewStats string>>")["books"]["current"][
                        "reviewStats"
                    ]
                ),
            ),
        )
        .withColumn("by_stats", F.size("stats") > 0)
        .withColumn(
            "info",
            F.when(F.size("info") > 0, col("info")).when(
                ~F.coalesce("by_stats", F.lit(False)), _dehydrated_page_info(col("dehydrated"))
            ),
        )
        .withColumn(
            "known",
            F.when(~col("state_ok"), F.lit(1).cast("bigint"))
            .when(
                col("by_stats"),
                pages_for(
                    F.coalesce(col("stats")["totalReviews"].try_cast("bigint"), F.lit(0)), site.reviews_per_page
                ),
            )
            .when(F.size("info") > 0, F.coalesce(col("info")["totalPages"].try_cast("bigint"), F.lit(1).cast("bigint"))),
        )
        .withColumn("found", scan(F.when(col("known").isNull(), col(html)), [PAGER_LINK, PAGER]))
    )
    items = col("found.elements")
    links = largest_number(within(matching(items, PAGER_LINK), first_match(items, PAGER)), col("found.pieces"))
    count = F.coalesce("known", links, F.lit(1).cast("bigint"))
    if status is not None:
        count = F.when(F.coalesce(col(status) != 200, F.lit(True)), F.lit(1).cast("bigint")).otherwise(count)
    counted = compute_once(staged, page_count=count)
    return counted.select(*kept, "page_count")


def with_markup_page_count(pages: DataFrame, html: str = "html", status: str | None = None) -> DataFrame:
    """Add ``page_count`` from all pagers of the markup; 1 without numbers, 0 for a failed page."""
    found = compute_once(pages, found=scan(F.col(html), [DIV_PAGER_LINK, PAGER_LINK]))
    items = F.col("found.elements")
    links = first_filled(matching(items, DIV_PAGER_LINK), matching(items, PAGER_LINK))
    count = F.coalesce(largest_number(links, F.col("found.pieces")), F.lit(1))
    failed = F.col(html).isNull() if status is None else F.col(html).isNull() | (F.col(status) != 200)
    return found.withColumn("page_count", F.when(failed, 0).otherwise(count)).drop("found")


def frontier(
    books: DataFrame,
    page_count: str = "page_count",
    max_pages: int | None = None,
    url_column: str = DEFAULT_SITE.url_column,
    keep_all: bool = False,
) -> DataFrame:
    """One row per book and needed page, numbered 1..n, with the page's URL and storage key.

    The cap is applied before the fan-out. A book fans out to blocks of pages first, blocks are dealt
    to all tasks, and only then their pages are written out: neither a book with very many pages nor
    a senseless count makes one task or one array large. Books without URL or without pages give no
    row, or with ``keep_all`` one row with a null ``page``.
    """
    url, block, size = F.col(url_column), F.col("_block"), F.lit(PAGES_PER_BLOCK)
    most = MOST_PAGES if max_pages is None else min(max_pages, MOST_PAGES)
    # ``least`` would take an unknown count for the bound.
    capped = F.when(F.col(page_count).isNotNull(), F.least(F.col(page_count).cast("bigint"), F.lit(most)))
    # A sequence from 1 to 0 would count down, hence the guard.
    last = F.when(url.isNotNull() & (url != "") & (capped >= 1), capped)
    fan_out = F.explode_outer if keep_all else F.explode
    counted = books.withColumn("_last", last).withColumn("_block", F.when(F.col("_last").isNotNull(), F.lit(0).cast("bigint")))
    # In steps, each from a block to its parts, so that no list of blocks is long.
    for power in (3, 2, 1):
        first = block * size
        upto = F.least(F.expr(f"(_last - 1) div {PAGES_PER_BLOCK**power}"), first + size - 1)
        if power == 3:
            upto = F.expr(f"(_last - 1) div {PAGES_PER_BLOCK**power}")
        counted = counted.withColumn("_block", fan_out(F.when(block.isNotNull(), F.sequence(first, upto))))
    # With a number, since these rows are few and small until they fan out and would be put together.
    tasks = int(books.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = counted.repartition(tasks, F.col(url_column), block)
    pages = F.when(
        block.isNotNull(), F.sequence(block * size + 1, F.least(F.col("_last"), block * size + size))
    )
    return (
        counted.withColumn("page", fan_out(pages))
        .drop("_last", "_block")
        .withColumn("page_url", reviews_url(url))
        .withColumn("page_key", F.when(F.col("page").isNotNull(), review_page_key(F.col("page_url"), F.col("page"))))
    )


def stored_pages(needed: DataFrame, store: DataFrame, key: str = "page_key") -> DataFrame:
    """Needed pages that the page store already holds, answered well; ``store`` may be a key table."""
    return needed.join(_keys(store, key), key, "left_semi")


def missing_pages(needed: DataFrame, store: DataFrame, key: str = "page_key", refresh: bool = False) -> DataFrame:
    """Needed pages that are still to be saved; with ``refresh`` that is all of them.

    A page whose stored answer failed or asks to solve a captcha is missing, where the store has the
    ``status`` of its answers.
    """
    return needed if refresh else needed.join(_keys(store, key), key, "left_anti")


def _keys(store: DataFrame, key: str) -> DataFrame:
    held = answered(store).select(key)
    if store.columns == [key]:
        return held  # a key table; copies do no harm to semi and anti joins
    # Distinct before the join: partial aggregation removes copies of a hot key where they lie.
    return held.distinct()


def write_keys(store: DataFrame, name: str, path: str, key: str = "page_key", buckets: int = 64, append: bool = False) -> DataFrame:
    """The keys of a store as a table of its own, bucketed by the key, and read again.

    It is written once and grows with each delivery (``append``). Probes then shuffle the needed pages
    only: neither the store nor its keys move. ``buckets`` should give buckets of some hundred MB.
    """
    keys = answered(store).select(key).filter(F.col(key).isNotNull()).distinct()
    # By bucket, so that a task writes the files of a few buckets.
    dealt = keys.repartition(buckets, key).write.mode("append" if append else "overwrite")
    dealt.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return store.sparkSession.table(name)
