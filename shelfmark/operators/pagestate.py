"""Reviews from the JSON state embedded in a page.

Everything is row-local: one page in, one page with an array of reviews out, no shuffle. The state
is parsed once per layer, and each layer is a separate projection so that Catalyst does not repeat
a parse where its result is used twice. Inside lambdas the same holds for nested ``transform``s.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.jsonmap import (
    STRICT,
    as_map,
    filled,
    last_wins,
    or_empty,
    parse,
    pick,
    reference,
    truthy,
)
from shelfmark.functions.once import compute_once
from shelfmark.functions.text import strip_markup
from shelfmark.schema import STATE_REVIEW

# Where the state sits in a page, and the names inside it.
STATE_OPEN = r"""(?i)<script[^>]*?\sid\s*=\s*["']?__NEXT_DATA__(?=["'\s>])[^>]*>"""
STATE_CLOSE = "</script"
STATE_MARK = "__NEXT_DATA__"
# The state is read as one member of an object with a second member behind it. A reader stops at the
# end of the first value; text after the state's own end makes the object malformed or hides the mark.
END_MARK = "_end_of_state"
STATE_SCHEMA = (
    "state struct<props struct<pageProps struct<apolloState map<string,string>,"
    f"initialState string,initialData string,dehydratedState string>>>,{END_MARK} int,malformed string"
)
COMMENT_OPEN, COMMENT_CLOSE = "<!--", "-->"
REVIEW_PREFIX = "Review:"
BOOK_QUERY = "book("
TEXT = ["text", "body"]
UPVOTES = ["likesCount", "likes"]
DATE = ["createdAt", "dateAdded"]

REVIEW = f"struct<{','.join(f'{f.name}:{f.dataType.simpleString()}' for f in STATE_REVIEW.fields)}>"
JSON_MAP = "map<string,string>"


def _ends_in_comment(text: Column, inside: Column | bool = False) -> Column:
    """Whether a comment is open at the end of a text; ``inside``: whether one was at its start."""
    opened = F.contains(text, F.lit(COMMENT_OPEN))
    tail = F.when(opened, F.substring_index(text, COMMENT_OPEN, -1)).otherwise(text)
    start = inside if isinstance(inside, Column) else F.lit(inside)
    return (opened | start) & ~F.contains(tail, F.lit(COMMENT_CLOSE))


def _head(html: Column) -> tuple[Column, Column, Column]:
    """The page up to the end of the tag with the first literal mark, what follows the mark, and that tag's end."""
    before = F.substring_index(html, STATE_MARK, 1)
    behind = F.substr(html, F.char_length(before) + F.lit(len(STATE_MARK) + 1))
    tag_end = F.substring_index(behind, ">", 1)
    return F.concat(before, F.lit(STATE_MARK), tag_end, F.lit(">")), behind, tag_end


def usual_head(html: Column) -> Column:
    """Whether the first literal mark of a page stands in its first state tag, and no comment hides that.

    A match of the pattern holds no ">" but its last character. So one with the first mark in it ends
    where the head does, and no other begins before it.
    """
    head, _, _ = _head(html)
    tag = F.regexp_extract(head, STATE_OPEN, 0)
    lead = F.left(head, F.char_length(head) - F.char_length(tag))
    usual = F.startswith(html, head) & F.contains(tag, F.lit(STATE_MARK)) & ~_ends_in_comment(lead)
    return F.coalesce(usual, F.lit(False))


def state_text(html: Column) -> Column:
    """Content of the first state script that is not in a comment, null without one.

    The page is cut at the literal mark and the literal end tag, so the pattern does not look at the state.
    Only unusual pages are searched as a whole.
    """
    _, behind, tag_end = _head(html)
    rest = F.when(usual_head(html), F.substr(behind, F.char_length(tag_end) + F.lit(2))).otherwise(_searched_state(html))
    # The end tag is looked for from the end of the page, where it mostly is.
    tail = F.substring_index(rest, STATE_CLOSE, -1)
    last = F.left(rest, F.char_length(rest) - F.char_length(tail) - F.lit(len(STATE_CLOSE)))
    cut = F.when(F.char_length(tail) < F.char_length(rest), last).otherwise(rest)
    # Tags are spelled in any case; the slower search is for states that hold something like one.
    alike = F.contains(cut, F.lit("</s")) | F.contains(cut, F.lit("</S"))
    first = F.get(F.split(F.substring_index(cut, STATE_CLOSE, 1), f"(?i){STATE_CLOSE}", 2), F.lit(0))
    return F.nullif(F.when(alike, first).otherwise(cut), F.lit(""))


def _searched_state(html: Column) -> Column:
    """What follows the first state tag that is not in a comment, by a search of the whole page.

    Only if a comment is open before the first such tag, all of them are looked at.
    """
    parts = F.split(html, STATE_OPEN, 2)
    every = F.split(html, STATE_OPEN)
    # Folded over the parts: whether a comment is open behind them, and the first part that none hides.
    seen = F.aggregate(
        F.slice(every, F.lit(2), F.size(every)),
        F.struct(_ends_in_comment(F.get(every, F.lit(0))).alias("inside"), F.lit(None).cast("string").alias("found")),
        lambda s, part: F.struct(
            _ends_in_comment(part, s["inside"]).alias("inside"),
            F.when(s["found"].isNull() & ~s["inside"], part).otherwise(s["found"]).alias("found"),
        ),
        lambda s: s["found"],
    )
    return F.when(_ends_in_comment(F.get(parts, F.lit(0))), seen).otherwise(F.get(parts, F.lit(1)))


def with_state(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the page text by its parsed state.

    Adds ``state_json`` (null without a state script), ``state_ok`` (false when it is not
    well-formed, goes on after its end, or holds a list or a number where an object belongs),
    ``entities`` and its
    ``root`` query, and the other parts of the state as JSON text. The parts become columns of
    their own so that later projections carry only what they use.
    """
    kept = [c for c in pages.columns if c != html]
    options = {**STRICT, "columnNameOfCorruptRecord": "malformed"}
    parsed = (
        pages.select(*kept, state_text(F.col(html)).alias("state_json"))
        .withColumn("wrapped", F.concat(F.lit('{"state":'), "state_json", F.lit(f',"{END_MARK}":1}}')))
        .withColumn("json", F.from_json("wrapped", STATE_SCHEMA, options))
        .withColumn(
            "state_ok",
            F.col("state_json").isNotNull() & F.col("json.malformed").isNull() & F.col(f"json.{END_MARK}").isNotNull(),
        )
        .withColumn("state", F.when(F.col("state_ok"), F.col("json.state.props.pageProps")))
    )
    return parsed.select(
        *kept,
        "state_json",
        F.col("state_json").isNotNull().alias("has_state"),
        "state_ok",
        last_wins(F.col("state.apolloState")).alias("entities"),
        F.col("state.initialState").alias("initial_state"),
        F.col("state.initialData").alias("initial_data"),
        F.col("state.dehydratedState").alias("dehydrated"),
    ).withColumn("root", as_map(F.col("entities")["ROOT_QUERY"]))


def book_queries(root: Column) -> Column:
    """Values of the root queries about a book, in JSON order."""
    return F.map_values(F.map_filter(root, lambda k, v: F.contains(k, F.lit(BOOK_QUERY))))


def review_keys(entities: Column) -> Column:
    return F.filter(F.map_keys(entities), lambda k: F.startswith(k, F.lit(REVIEW_PREFIX)))


def _edge_targets(root: Column) -> Column:
    """Targets of the review edges of all book queries; edges of another shape are skipped."""
    edges = F.flatten(
        F.transform(
            book_queries(root),
            lambda q: or_empty(parse(q, "reviews struct<edges array<string>>")["reviews"]["edges"], "string"),
        )
    )
    targets = F.transform(edges, lambda e: F.get_json_object(e, "$.node.__ref"))
    return or_empty(F.filter(targets, lambda t: t.isNotNull()), "string")


def _common_fields(review: Column) -> list[Column]:
    return [
        pick(review, UPVOTES, "0").try_cast("double").try_cast("bigint").alias("review_upvotes"),
        pick(review, DATE, "").alias("review_date"),
        pick(review, ["url"], "").alias("review_url"),
    ]


def _rating(review: Column) -> Column:
    return pick(review, ["rating"])


def _by_reference(entities: Column, targets: Column) -> Column:
    """Look the targets up, follow their user and text references, keep reviews with content."""
    objects = F.filter(F.transform(targets, lambda t: as_map(entities[t])), lambda m: F.size(m) > 0)
    with_links = F.transform(
        objects,
        lambda m: F.struct(
            m.alias("m"),
            pick(m, TEXT, "").alias("text"),
            reference(pick(m, TEXT, "")).alias("text_key"),
            reference(pick(m, ["creator", "user"], "{}")).alias("user_key"),
        ),
    )
    looked_up = F.transform(
        with_links,
        lambda x: F.struct(
            x["m"].alias("m"),
            x["user_key"].isNotNull().alias("linked_user"),
            as_map(entities[x["user_key"]]).alias("user"),
            x["text"].alias("own_text"),
            x["text_key"].isNotNull().alias("linked_text"),
            as_map(entities[x["text_key"]]).alias("text"),
        ),
    )

    def fields(x: Column) -> Column:
        review, user = x["m"], x["user"]
        text = F.when(x["linked_text"], pick(x["text"], TEXT, "")).otherwise(x["own_text"])
        known = F.size(user) > 0

        def of_user(names: list[str], own: Column) -> Column:
            return F.when(x["linked_user"], F.when(known, pick(user, names, ""))).otherwise(own)

        return F.struct(
            _rating(review).alias("raw_rating"),
            F.struct(
                strip_markup(text).alias("review_text"),
                _rating(review).try_cast("double").alias("review_rating"),
                of_user(["legacyId", "id"], pick(review, ["userId", "id"], "")).alias("reviewer_id"),
                of_user(["name"], pick(review, ["userName"], "")).alias("reviewer_name"),
                *_common_fields(review),
            ).alias("review"),
        )

    return _numbered(_with_content(F.transform(looked_up, fields)))


def _inline(items: Column) -> Column:
    """Reviews written in place: markup is kept, the user is an object of the review."""

    def fields(x: Column) -> Column:
        review, user = x["m"], x["user"]
        return F.struct(
            _rating(review).alias("raw_rating"),
            F.struct(
                pick(review, TEXT, "").alias("review_text"),
                _rating(review).try_cast("double").alias("review_rating"),
                pick(user, ["id"], pick(review, ["userId"], "")).alias("reviewer_id"),
                pick(user, ["name"], pick(review, ["userName"], "")).alias("reviewer_name"),
                *_common_fields(review),
            ).alias("review"),
        )

    objects = F.filter(F.transform(items, as_map), lambda m: m.isNotNull())
    with_user = F.transform(objects, lambda m: F.struct(m.alias("m"), as_map(m["user"]).alias("user")))
    return F.transform(with_user, fields)


def _with_content(found: Column) -> Column:
    """Accept a review that has a text or a rating."""
    kept = F.filter(found, lambda x: filled(x["review"]["review_text"]) | truthy(x["raw_rating"]))
    return F.transform(kept, lambda x: x["review"])


def _with_author(found: Column) -> Column:
    """Accept a review that has a text and a reviewer."""
    kept = F.filter(
        found, lambda x: filled(x["review"]["review_text"]) & truthy(x["review"]["reviewer_id"])
    )
    return F.transform(kept, lambda x: x["review"])


def _numbered(reviews: Column) -> Column:
    """A review without reviewer gets one named after its place among the accepted ones."""
    return F.transform(
        reviews,
        lambda r, i: r.withField(
            "reviewer_id",
            F.when(truthy(r["reviewer_id"]), r["reviewer_id"]).otherwise(
                F.concat(F.lit("unknown_"), i.cast("string"))
            ),
        ),
    )


def _dehydrated_nodes(dehydrated: Column) -> Column:
    queries = or_empty(parse(dehydrated, "queries array<string>")["queries"], "string")
    edges = F.flatten(
        F.transform(
            queries,
            lambda q: or_empty(
                parse(
                    q,
                    "state struct<data struct<book struct<reviews struct<edges array<struct<node string>>>>>>",
                )["state"]["data"]["book"]["reviews"]["edges"],
                "struct<node string>",
            ),
        )
    )
    return F.transform(edges, lambda e: e["node"])


def with_reviews(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``reviews`` (array, in page order) and ``review_source`` to a page table.

    Sources are tried in order and the first that yields reviews wins: edges of the book's query,
    all review entities, initial state, initial data, dehydrated queries. Without any review
    ``reviews`` is empty and ``review_source`` tells why: no_state, bad_state or no_reviews.
    """
    kept = pages.columns
    col = F.col
    none = F.array().cast(f"array<{REVIEW}>")
    staged = (
        with_state(pages, html)
        .withColumn("edges", _edge_targets(col("root")))
        .withColumn(
            "targets",
            F.when(F.size("edges") > 0, col("edges")).otherwise(or_empty(review_keys(col("entities")), "string")),
        )
        .withColumn("linked", F.when(F.size("targets") > 0, _by_reference(col("entities"), col("targets"))))
        .withColumn(
            "in_state",
            F.when(
                F.size("targets") == 0,
                _numbered(
                    _with_content(
                        _inline(
                            parse(
                                col("initial_state"),
                                "books struct<current struct<reviews array<string>>>",
                            )["books"]["current"]["reviews"]
                        )
                    )
                ),
            ),
        )
        .withColumn(
            "in_data",
            F.when(
                (F.size("targets") == 0) & (F.coalesce(F.size("in_state"), F.lit(0)) == 0),
                _with_author(
                    _inline(
                        parse(col("initial_data"), "book struct<reviews array<string>>")["book"]["reviews"]
                    )
                ),
            ),
        )
        .withColumn(
            "found",
            F.coalesce(
                *[F.when(F.size(name) > 0, col(name)) for name in ("linked", "in_state", "in_data")]
            ),
        )
        .withColumn(
            "in_queries",
            F.when(col("found").isNull(), _with_author(_inline(_dehydrated_nodes(col("dehydrated"))))),
        )
    )
    source = (
        F.when((F.size("linked") > 0) & (F.size("edges") > 0), "edges")
        .when(F.size("linked") > 0, "entities")
        .when(F.size("in_state") > 0, "state")
        .when(F.size("in_data") > 0, "data")
        .when(F.size("in_queries") > 0, "queries")
        .when(~col("has_state"), "no_state")
        .when(~col("state_ok"), "bad_state")
        .otherwise("no_reviews")
    )
    done = compute_once(staged, reviews=F.coalesce("found", "in_queries", none), review_source=source)
    return done.select(*[c for c in kept if c != html], "state_json", "reviews", "review_source")


def review_rows(pages_with_reviews: DataFrame) -> DataFrame:
    """One row per review, with its place ``pos`` on the page; pages without reviews give none."""
    kept = [c for c in pages_with_reviews.columns if c not in ("reviews", "state_json")]
    return pages_with_reviews.select(*kept, F.posexplode("reviews").alias("pos", "r")).select(*kept, "pos", "r.*")
