"""Books, reviews and saved pages derived from the star-schema tables.

Every event is one review: of a part (the book), by a user, with the text of a whole document.
A third of the reviews go to one book, a third to twenty more, the rest to the remaining books;
the last tenth of the books has none. Pages are then written from those reviews in the forms a
site uses, so that the extraction jobs have real work that grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.once import compute_once
from shelfmark.functions.packing import THOROUGH, pack, unpack_list
from shelfmark.functions.urls import reviews_url
from shelfmark.operators.linking import search_page_key
from shelfmark.site import DEFAULT_SITE

PER_PAGE = DEFAULT_SITE.reviews_per_page
POPULAR = 20
CANDIDATES = 10
STRIDE = 37
PAGER_LINKS = 9

SHAPES = ["edges", "entities", "state", "data", "queries"]

# Where a review's values are: in columns of its row, or in one of a page's list.
Values = Callable[[str], Column]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(df: DataFrame) -> DataFrame:
    """For a side of a join whose size the planner cannot know: it counts what files take, not what is
    unpacked or exploded from them, and would send a table of any length through the driver."""
    return df.hint("merge")


def _count(df: DataFrame) -> Column:
    """Row count as a scalar subquery."""
    return df.agg(F.count("*")).scalar()


def _book_url(number: Column) -> Column:
    """Depends on the number alone, so that pages need no join with the books to get their URL."""
    no = number.cast("string")
    return F.concat(F.lit(f"{DEFAULT_SITE.base_url}/book/show/"), no, F.lit(".Book_"), no)


def page_url(number: Column) -> Column:
    return reviews_url(_book_url(number))


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as books. Some URLs are null, some empty, some end in slashes."""
    key = F.col("p_partkey")
    plain = _book_url(key)
    url = (
        F.when(key % 17 == 5, F.lit(None))
        .when(key % 17 == 6, F.lit(""))
        .when(key % 17 == 7, F.concat(plain, F.lit("//")))
        .otherwise(plain)
    )
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("book_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("author"),
        url.alias("book_url"), plain.alias("plain_url"), key.alias("book_no"),
    )


def reviews(spark: SparkSession, sf_dir: str, with_text: bool = True, packed: bool = False) -> DataFrame:
    """One review per event. ``seq`` numbers the reviews of a book; 30 make a page.

    With ``packed`` the text is packed bytes, made once for each document.
    """
    parts, docs = table(spark, sf_dir, "part"), table(spark, sf_dir, "documents")
    events = table(spark, sf_dir, "events").withColumn("_parts", _count(parts))
    numbered = (
        events.withColumn("_third", F.expr("event_id div 3"))
        .withColumn("_tail", F.expr(f"_parts - _parts div 10 - {POPULAR + 1}"))
        .withColumn(
            "book_no",
            F.expr(
                f"CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 + _third % {POPULAR}"
                f" ELSE {POPULAR + 1} + _third % _tail END"
            ),
        )
        .withColumn(
            "seq",
            F.expr(f"CASE event_id % 3 WHEN 0 THEN _third WHEN 1 THEN _third div {POPULAR} ELSE _third div _tail END"),
        )
    )
    base = numbered.select(
        "event_id",
        "book_no",
        "seq",
        F.expr(f"CAST(seq div {PER_PAGE} + 1 AS INT)").alias("page"),
        F.expr(f"CAST(seq % {PER_PAGE} AS INT)").alias("place"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("reader "), F.col("user_id").cast("string")).alias("user_name"),
        F.when(F.col("event_id") % 13 != 4, F.floor(F.col("value") / 4).cast("int") % 7).alias("rating"),
        F.get_json_object("props", "$.k").cast("bigint").alias("upvotes"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
    )
    keyed = base.withColumn("doc_id", F.col("event_id") % _count(docs))
    if packed:
        docs = docs.select("doc_id", pack(F.col("text"), THOROUGH).alias("text"))
    return _with_text(keyed, docs) if with_text else keyed


def _with_text(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.join(docs.select("doc_id", "text"), "doc_id").drop("doc_id")


def flat_table(
    spark: SparkSession, sf_dir: str, defects: bool = False, with_text: bool = True
) -> DataFrame:
    """The reviews as an output table, optionally with defects for the quality rules to find.

    Books join the narrow rows; the texts come last, on a key without skew.
    """
    rows = reviews(spark, sf_dir, with_text=False).join(books(spark, sf_dir).drop("book_url"), "book_no")
    rows = _with_text(rows, table(spark, sf_dir, "documents")) if with_text else rows
    no = F.col("event_id")
    text = F.col("text") if with_text else F.lit(None).cast("string")
    reviewer, date = F.col("user_id"), F.col("date")
    rating = F.col("rating").cast("double")
    if defects:
        text = (
            F.when(no % 29 == 3, F.lit(None).cast("string"))
            .when(no % 29 == 4, F.lit(""))
            .when(no % 31 == 5, F.concat(F.lit("Mock review: "), text))
            .when(no % 31 == 6, F.concat(text, F.lit(" (Mock review)")))
            .otherwise(text)
        )
        reviewer = F.when(no % 37 == 7, F.concat(F.lit("mock_user_"), reviewer)).otherwise(reviewer)
        rating = F.when(no % 41 == 8, rating + 0.5).otherwise(rating)
        date = (
            F.when(no % 43 == 9, F.concat(date, F.lit("Z")))
            .when(no % 43 == 10, F.left(date, F.lit(10)))
            .when(no % 43 == 11, F.lit(None).cast("string"))
            .when(no % 43 == 12, F.lit("2023-13-45T00:00:00"))
            .otherwise(date)
        )
    else:
        rating = F.when(rating.between(1, 5), rating.cast("int"))
    return rows.select(
        "event_id",
        F.when(no % 47 == 13, F.lit(None)).otherwise(F.col("book_id")).alias("book_id") if defects else "book_id",
        "title",
        "author",
        F.col("plain_url").alias("book_url"),
        text.alias("review_text"),
        rating.alias("review_rating"),
        reviewer.alias("reviewer_id"),
        F.col("user_name").alias("reviewer_name"),
        F.col("upvotes").alias("review_upvotes"),
        date.alias("review_date"),
    )


NULL_MARK = "(null)"


def _object(**members: Column) -> Column:
    """JSON object without its null members."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in members.items()]))


def _marked_up(text: Column) -> Column:
    """Line ends as tags and the whole in italics."""
    return F.concat(F.lit("<i>"), F.replace(text, F.lit("\n"), F.lit("<br />")), F.lit("</i>"))


def _by_number(no: Column, *cases: Column) -> Column:
    """One of several forms, in turn by event number."""
    out = F.lit(None)
    for i, case in enumerate(cases):
        out = F.when(no % len(cases) == i, case).otherwise(out)
    return out


def _content(col: Values) -> dict[str, Column]:
    """Members shared by linked and inline reviews, under their alternating names."""
    no, text = col("event_id"), _marked_up(col("text"))
    # Every eleventh review is to have a present but null text next to a filled body.
    void = no % 11 == 3
    return {
        "text": F.when(void, NULL_MARK).when(no % 2 == 0, text),
        "body": F.when(void, "unused").when(no % 2 == 1, text),
        "rating": col("rating"),
        "likesCount": F.when(no % 3 == 0, col("upvotes")),
        "likes": F.when(no % 3 == 1, col("upvotes")),
        "createdAt": F.when(no % 2 == 0, col("date")),
        "dateAdded": F.when(no % 2 == 1, col("date")),
        "url": F.when(no % 4 == 1, F.concat(F.lit("/review/show/"), no.cast("string"))),
    }


def _with_null_text(no: Column, review: Column) -> Column:
    nulled = F.replace(review, F.lit(f'"{NULL_MARK}"'), F.lit("null"))
    return F.when(no % 11 == 3, nulled).otherwise(review)


def _linked_review(col: Values) -> Column:
    """A review entity: user by reference, dangling reference, own user fields, or none."""
    no = col("event_id")
    ref = F.struct(F.concat(F.lit("User:"), col("user_id")).alias("__ref"))
    gone = F.struct(F.concat(F.lit("User:gone-"), col("user_id")).alias("__ref"))
    text = _content(col)
    apart = _has_text_entity(no)
    text["text"], text["body"] = F.when(~apart, text["text"]), F.when(~apart, text["body"])
    plain = _object(
        __typename=F.lit("Review"),
        id=F.concat(F.lit("r"), no.cast("string")),
        **text,
        creator=F.when(no % 5 == 0, ref).when(no % 5 == 2, gone),
        user=F.when(no % 5 == 0, gone).when(no % 5 == 1, ref),
        userId=F.when(no % 5 == 3, col("user_id")),
        userName=F.when(no % 5 == 3, col("user_name")),
    )
    # A text of its own entity is a reference in the review.
    link = F.concat(F.lit('{"text":{"__ref":"Text:'), no.cast("string"), F.lit('"},'), F.substr(plain, F.lit(2)))
    return _with_null_text(no, F.when(apart, link).otherwise(plain))


def _has_text_entity(no: Column) -> Column:
    return (no % 7 == 2) & (no % 11 != 3)


def _inline_review(col: Values) -> Column:
    no = col("event_id")
    user = F.struct(col("user_id").alias("id"), col("user_name").alias("name"))
    return _with_null_text(
        no,
        _object(
            **_content(col),
            user=F.when(no % 3 == 0, user),
            userId=F.when(no % 3 == 1, col("user_id")),
            userName=F.when(no % 3 == 1, col("user_name")),
        ),
    )


def _said_twice(value: Column, member: str) -> Column:
    """A JSON object with a member that is repeated; the later one is the right one."""
    return F.concat(F.lit(f'{{"{member}":"said before",'), F.substr(value, F.lit(2)))


def _entry(kind: str, key: Column, value: Column) -> Column:
    return F.concat(F.lit(f'"{kind}:'), key.cast("string"), F.lit('":'), value)


def _list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def _by_page(rows: DataFrame) -> DataFrame:
    """Bring the reviews of a page together before they are written out, dealt by the page's URL and number.

    The grouping by page that follows needs no further shuffle, nor do steps that bring the copies of a
    stored page together, and the writing runs on all tasks however few there were to read the documents.
    """
    return rows.withColumn("page_url", page_url(F.col("book_no"))).repartition("page_url", "page")


def _grouped(rows: DataFrame, keys: list[str], one: Callable[[Values], Column], values: list[str], packed: bool) -> DataFrame:
    """One row per page, with a list ``r`` of what ``one`` makes of its reviews, in its order.

    With ``packed`` the reviews' ``values`` are brought together first, and their texts unpacked page by page.
    """
    if not packed:
        return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(one(F.col))).alias("r"))
    held = rows.groupBy(*keys).agg(F.collect_list(F.struct(*values, "text")).alias("held"))
    texts = unpack_list(F.transform("held", lambda x: x["text"]))
    made = F.zip_with("held", "texts", lambda x, text: one(lambda name: text if name == "text" else x[name]))
    return compute_once(held.withColumn("texts", texts), r=F.array_sort(made)).select(*keys, "r")


def review_total(book_no: Column, n_events: Column, n_parts: Column) -> Column:
    """Reviews of a book, from the rule that assigns events to books: how many k < n fall to it."""
    tail = n_parts - F.expr("_parts div 10") - (POPULAR + 1)

    def tier(first: int) -> Column:
        return F.floor((n_events - first + 2) / 3)

    one = F.lit(1)
    hot = tier(0)
    popular = F.floor((tier(1) - (book_no - 1) + POPULAR - one) / POPULAR)
    rest = F.floor((tier(2) - (book_no - (POPULAR + 1)) + tail - one) / tail)
    total = F.when(book_no == 0, hot).when(book_no <= POPULAR, popular).otherwise(rest)
    return F.greatest(total, F.lit(0)).cast("bigint")


def _state_review(col: Values) -> Column:
    """What a page's state holds of one review: itself, and entities for its text and user."""
    is_linked = F.col("shape").isin("edges", "entities")
    no = col("event_id")
    text_entry = F.when(
        is_linked & _has_text_entity(no), _entry("Text", no, _said_twice(_object(text=_marked_up(col("text"))), "text"))
    )
    user_entry = F.when(
        is_linked & (no % 5).isin(0, 1),
        _entry(
            "User",
            col("user_id"),
            _said_twice(
                _object(
                    name=col("user_name"),
                    id=F.concat(F.lit("u"), col("user_id")),
                    legacyId=col("user_id").cast("bigint"),
                ),
                "name",
            ),
        ),
    )
    return F.struct(
        col("place").alias("place"),
        no.alias("no"),
        F.when(is_linked, _linked_review(col)).otherwise(_inline_review(col)).alias("review"),
        text_entry.alias("text_entry"),
        user_entry.alias("user_entry"),
    )


# What the pages show of a review, besides its text.
VALUES = ["place", "event_id", "user_id", "user_name", "rating", "upvotes", "date"]


def state_pages(spark: SparkSession, sf_dir: str, shape: str | None = None, packed: bool = True) -> DataFrame:
    """Saved review pages with embedded state, in one shape, or in all five by book number.

    Reviews are grouped by book *and* page, 30 to a group at most. Texts are packed on their way to the page.
    Without ``packed`` they are not, and Spark knows how the pages are dealt, which it does not behind a
    Python step: for steps that bring the copies of a page together and would deal all texts again.
    """
    rows = _by_page(reviews(spark, sf_dir, packed=packed))
    which = F.lit(shape) if shape else F.element_at(F.array(*map(F.lit, SHAPES)), (F.col("book_no") % 5 + 1).cast("int"))
    rows = rows.withColumn("shape", which)
    grouped = _grouped(rows, ["page_url", "page", "book_no", "shape"], _state_review, VALUES, packed)
    sized = grouped.withColumn("_parts", _count(table(spark, sf_dir, "part"))).withColumn(
        "total", review_total(F.col("book_no"), _count(table(spark, sf_dir, "events")), F.col("_parts"))
    )
    col = F.col
    objects = F.transform("r", lambda x: x["review"])
    edges = F.transform(
        "r", lambda x: F.concat(F.lit('{"node":{"__ref":"Review:'), x["no"].cast("string"), F.lit('"}}'))
    )
    entities = F.flatten(
        F.array(
            F.transform("r", lambda x: _entry("Review", x["no"], x["review"])),
            F.array_distinct(F.array_compact(F.transform("r", lambda x: x["user_entry"]))),
            F.array_compact(F.transform("r", lambda x: x["text_entry"])),
        )
    )
    last_page = F.floor((col("total") + F.lit(PER_PAGE - 1)) / PER_PAGE).cast("string")
    page_info = F.concat(F.lit('"pageInfo":{"totalPages":'), last_page, F.lit("}"))
    # Edges of a wrong shape and edges to nowhere are passed over; an entity that no edge names stays out.
    all_edges = _list(
        F.concat(F.array(F.lit("5"), F.lit('{"node":"x"}')), edges, F.array(F.lit('{"node":{"__ref":"Review:gone"}}')))
    )
    root = F.concat(
        F.lit('"ROOT_QUERY":{"__typename":"Query","getBook({})":{"id":1},"book({\\"id\\":'),
        col("book_no").cast("string"),
        F.lit('})":{"reviews":{"edges":'),
        all_edges,
        F.lit(","),
        page_info,
        F.lit("}}}"),
    )
    extra = F.lit('"Review:extra":{"text":"not on this page","rating":5}')
    state = (
        F.when(
            col("shape") == "edges",
            F.concat(F.lit('"apolloState":{'), root, F.lit(","), extra, F.lit(","), F.array_join(entities, ","), F.lit("}")),
        )
        .when(
            col("shape") == "entities",
            F.concat(
                F.lit('"apolloState":{"ROOT_QUERY":{"getReviews({})":{"totalCount":1}},'),
                F.array_join(entities, ","),
                F.lit("}"),
            ),
        )
        .when(
            col("shape") == "state",
            F.concat(
                F.lit('"initialState":{"books":{"current":{"reviews":'),
                _list(objects),
                F.lit(',"reviewStats":{"totalReviews":'),
                col("total").cast("string"),
                F.lit("}}}}"),
            ),
        )
        .when(
            col("shape") == "data",
            F.concat(F.lit('"initialData":{"book":{"reviews":'), _list(objects), F.lit("}}")),
        )
        .otherwise(
            F.concat(
                F.lit('"dehydratedState":{"queries":[{"state":{"data":{"user":1}}},{"state":{"data":{"book":{"reviews":{'),
                page_info,
                F.lit(',"edges":'),
                _list(F.transform(objects, lambda o: F.concat(F.lit('{"node":'), o, F.lit("}")))),
                F.lit("}}}}}]}"),
            )
        )
    )
    # As on real pages: the first few pages, and the last one.
    last = F.greatest(last_page.cast("int"), F.lit(1))
    shown = F.array_distinct(F.concat(F.sequence(F.lit(1), F.least(last, F.lit(PAGER_LINKS))), F.array(last)))
    links = F.array_join(
        F.transform(
            shown,
            lambda p: F.concat(F.lit('<a href="?page='), p.cast("string"), F.lit('"> '), p.cast("string"), F.lit(" </a>")),
        ),
        "",
    )
    html = F.concat(
        F.lit('<!DOCTYPE html><html><head><title>Reviews</title></head><body><script id="__NEXT_DATA__" type="application/json">\n{"props":{"pageProps":{'),
        state,
        F.lit('}}}\n</script><div class="pagination top"><a href="?page=0">Previous</a>'),
        F.when(col("page") == 1, links).otherwise(F.lit("")),
        F.lit('</div><div class="pagination"><a href="#">99999</a></div></body></html>'),
    )
    return sized.select("book_no", "page_url", "page", "shape", html.alias("html"))


def saved_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page store: all numbered pages, and the first page of each book again without a number."""
    pages = state_pages(spark, sf_dir, packed=False).select("page_url", "page", "html")
    return pages.union(pages.filter("page = 1").withColumn("page", F.lit(None).cast("int")))


def _element(tag: str, attributes: str, inner: Column | str) -> Column:
    inner = F.lit(inner) if isinstance(inner, str) else inner
    return F.concat(F.lit(f"<{tag} {attributes}>"), inner, F.lit(f"</{tag}>"))


def review_box(col: Values) -> Column:
    """One review as markup, in alternating forms of each part. Texts go in escaped."""
    no = col("event_id")
    safe = F.replace(F.replace(col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = _by_number(
        no,
        F.concat(F.lit('<span class="readable"><span>'), safe, F.lit("</span></span>")),
        F.concat(F.lit('<div class="reviewText stacked"><span> '), safe, F.lit(" </span></div>")),
        F.concat(F.lit('<div class="reviewText">'), safe, F.lit("<br></div>")),
    )
    number = col("rating").cast("string")
    rating = F.when(
        col("rating").isNotNull(),
        _by_number(
            no,
            F.concat(F.lit('<span class="staticStars" title="'), number, F.lit(' stars">x</span>')),
            F.concat(F.lit('<span class="staticStars plain p'), number, F.lit('5"></span>')),
            F.concat(F.lit('<span class="staticStars" title="rated">'), F.repeat(F.lit("★"), col("rating")), F.lit("</span>")),
            F.concat(F.lit('<span class="staticStars">'), F.repeat(F.lit("★"), col("rating")), F.lit("☆</span>")),
        ),
    )
    user = F.when(
        no % 6 != 5,
        F.concat(
            F.when(no % 2 == 0, '<a class="user" href="/user/show/').otherwise('<a class="reviewerName" href="/user/show/'),
            col("user_id"),
            F.lit('-x">'),
            col("user_name"),
            F.lit("</a>"),
        ),
    )
    votes = _by_number(
        no,
        F.concat(F.lit('<span class="likesCount">'), col("upvotes").cast("string"), F.lit(" likes</span>")),
        F.concat(F.lit('<span class="likeReview">Liked '), col("upvotes").cast("string"), F.lit("</span>")),
        F.lit(""),
    )
    day = F.to_date(F.left(col("date"), F.lit(10)))
    href = F.concat(F.lit('<a class="reviewDate" href="/review/show/'), no.cast("string"), F.lit('">'))
    date = _by_number(
        no,
        F.concat(href, F.date_format(day, "MMM d, yyyy"), F.lit("</a>")),
        _element("span", 'class="reviewDate"', F.date_format(day, "MMMM dd, yyyy")),
        _element("span", 'class="reviewDate"', F.date_format(day, "yyyy-MM-dd")),
        _element("span", 'class="reviewDate"', "some time ago"),
        F.lit(""),
    )
    shelf = F.concat(F.lit("shelf "), col("user_id"))
    shelves = _by_number(
        no,
        F.concat(
            F.lit('<a class="actionLinkLite bookPageGenreLink">'), shelf, F.lit('</a> <a class="x actionLinkLite bookPageGenreLink"> to read</a>')
        ),
        F.concat(F.lit('<div class="shelves"><b>Shelves:</b> '), shelf, F.lit(" , owned</div>")),
        F.lit(""),
    )
    comments = F.when(no % 4 == 0, F.concat(F.lit('<span class="commentCount">'), (no % 9).cast("string"), F.lit(" comments</span>")))
    return F.concat(
        F.lit('<div class="review bordered" id="review_'),
        no.cast("string"),
        F.lit('"><p>'),  # never closed
        F.concat_ws("\n", user, rating, body, votes, date, shelves, comments),
        F.lit("</div>"),
    )


def markup_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved review pages as markup. Reading them takes Python anyhow, so their texts are always packed on the way."""

    def one(col: Values) -> Column:
        return F.struct(col("place").alias("place"), review_box(col).alias("box"))

    rows = _by_page(reviews(spark, sf_dir, packed=True))
    grouped = _grouped(rows, ["page_url", "page", "book_no"], one, VALUES, packed=True)
    boxes = F.array_join(F.transform("r", lambda x: x["box"]), "\n")
    number = F.col("page").cast("string")
    return grouped.select(
        "book_no",
        "page_url",
        "page",
        F.size("r").cast("bigint").alias("n"),
        F.concat(
            F.lit('<html><body><script>var x = "<div class=review>";</script><div class="reviewsContainer">'),
            boxes,
            F.lit('</div><div class="pagination"><a>Previous</a><a> '),
            number,
            F.lit('</a></div><p class="pagination"><a>'),
            (F.col("page") + 5).cast("string"),
            F.lit("</a></p></body></html>"),
        ).alias("html"),
    )


def typo(title: Column, number: Column) -> Column:
    """The title with one character left out."""
    at = (number % F.char_length(title)).cast("int")
    return F.concat(F.left(title, at), F.substr(title, at + F.lit(2)))


def book_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as books to look up: the title has a letter missing, some authors are wrong or null."""
    no = F.col("p_partkey")
    author = F.when(no % 23 == 11, F.lit(None)).when(no % 5 == 3, F.lit("someone else")).otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select(
        no.alias("book_no"),
        no.cast("string").alias("book_id"),
        typo(F.col("p_name"), no).alias("title"),
        author.alias("author"),
    )


def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten search results per book: the book itself at a varying place, and parts spread over the table."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    asked = parts.select(F.col("p_partkey").alias("book_no")).withColumn("_parts", _count(parts))
    placed = asked.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(CANDIDATES - 1)))).withColumn(
        "p_partkey",
        F.expr(f"(book_no + ((place + book_no) % {CANDIDATES}) * {STRIDE}) % _parts"),
    )
    return _dealt(placed).join(parts, "p_partkey").select("book_no", "place", "p_partkey", "p_name", "p_brand")


def result_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search results of each book as an array of candidates, ten to a group."""
    no = F.col("p_partkey").cast("string")
    one = F.struct(
        "place",
        F.struct(
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("author"),
            F.concat(F.lit(f"{DEFAULT_SITE.base_url}/book/show/"), no).alias("url"),
            no.alias("catalogue_id"),
        ).alias("c"),
    )
    grouped = result_rows(spark, sf_dir).groupBy("book_no").agg(F.array_sort(F.collect_list(one)).alias("r"))
    return grouped.select("book_no", F.transform("r", lambda x: x["c"]).alias("candidates"))


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved search pages in the table form and the box form; some results lack author or id."""
    col = F.col
    no = col("p_partkey").cast("string")
    href = (
        F.when((col("place") == 3) & (col("book_no") % 4 == 1), F.lit("/author/only"))
        .when(col("place") % 2 == 0, F.concat(F.lit("/book/show/"), no, F.lit("?from=search")))
        .otherwise(F.concat(F.lit(f"{DEFAULT_SITE.base_url}/book/show/"), no))
    )
    no_author = (col("place") == 5) & (col("book_no") % 4 == 2)
    as_row = F.concat(
        F.lit('<tr><td><a class="bookTitle" href="'), href, F.lit('"><span>'), col("p_name"), F.lit("</span></a><br>"),
        F.when(no_author, "").otherwise(F.concat(F.lit('by <a class="authorName" href="/a">'), col("p_brand"), F.lit("</a>"))),
        F.lit("</td></tr>"),
    )
    as_box = F.concat(
        F.lit('<div class="bookTitle"><a href="'), href, F.lit('"> '), col("p_name"), F.lit("\n</a>"),
        F.when(no_author, "").otherwise(F.concat(F.lit('<div class="authorName">by '), col("p_brand"), F.lit("</div>"))),
        F.lit("</div>"),
    )
    rows = result_rows(spark, sf_dir)
    in_table = col("book_no") % 2 == 0
    one = F.struct("place", F.when(in_table, as_row).otherwise(as_box).alias("item"))
    grouped = rows.groupBy("book_no").agg(F.array_sort(F.collect_list(one)).alias("r"))
    items = F.array_join(F.transform("r", lambda x: x["item"]), "")
    html = F.when(in_table, F.concat(F.lit('<html><table class="tableList">'), items, F.lit("</table></html>"))).otherwise(
        F.concat(F.lit("<html><body>"), items, F.lit("</body></html>"))
    )
    return grouped.select("book_no", html.alias("html"))


def keyed_search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages under the key of the query they answer. Equal queries share one page."""
    asked = book_queries(spark, sf_dir).withColumn("search_key", search_page_key(F.col("title"), F.col("author")))
    first = asked.filter(F.col("search_key").isNotNull()).groupBy("search_key").agg(F.min("book_no").alias("book_no"))
    return _dealt(first).join(search_pages(spark, sf_dir), "book_no").select("search_key", "html")
