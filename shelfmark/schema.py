"""Column names and types of the tables at the edges."""

from __future__ import annotations

from pyspark.sql import types as T

# Accepted spellings of the book list header, and the columns a book list must have.
HEADER_ALIASES = {"Book ID": "book_id", "Title": "title", "Author": "author"}
BOOK_COLUMNS = ["book_id", "title", "author"]

# Place of a book in its list. Where a list has it, the tables made from the list carry it on.
BOOK_SEQ = "book_seq"

# A review table read from CSV carries the rating as it was written next to its number.
RAW_RATING = "review_rating_raw"


def required_columns(url_column: str = "book_url", with_reviewer_name: bool = False) -> list[str]:
    """The columns a review table must have; one contract also asks for the reviewer's name."""
    names = ["book_id", "title", "author", url_column, "review_text", "review_rating", "reviewer_id"]
    names += ["reviewer_name"] if with_reviewer_name else []
    return names + ["review_upvotes", "review_date"]


BOOK_FIELDS = [T.StructField(name, T.StringType()) for name in BOOK_COLUMNS]

# One review as found in a page's embedded state. The rating is still raw here.
STATE_REVIEW = T.StructType(
    [
        T.StructField("review_text", T.StringType()),
        T.StructField("review_rating", T.DoubleType()),
        T.StructField("reviewer_id", T.StringType()),
        T.StructField("reviewer_name", T.StringType()),
        T.StructField("review_upvotes", T.LongType()),
        T.StructField("review_date", T.StringType()),
        T.StructField("review_url", T.StringType()),
    ]
)

# One review as found in a page's markup.
MARKUP_REVIEW = T.StructType(
    STATE_REVIEW.fields[:5]
    + [T.StructField("review_downvotes", T.LongType())]
    + STATE_REVIEW.fields[5:]
    + [
        T.StructField("shelves", T.ArrayType(T.StringType())),
        T.StructField("comment_count", T.LongType()),
    ]
)


def review_table(url_column: str = "book_url") -> T.StructType:
    """The flat output table: one row per book and review, rating cleaned to 1..5 or null."""
    reviews = [
        T.StructField(f.name, T.IntegerType()) if f.name == "review_rating" else f
        for f in STATE_REVIEW.fields
    ]
    return T.StructType(BOOK_FIELDS + [T.StructField(url_column, T.StringType())] + reviews)


def book_columns(table) -> list[str]:
    """The columns of a book that go from table to table."""
    return BOOK_COLUMNS + [c for c in (BOOK_SEQ,) if c in table.columns]


def page_table() -> T.StructType:
    """Saved pages. ``page`` is null for the page that was asked for without a page number."""
    return T.StructType(
        [
            T.StructField("page_url", T.StringType()),
            T.StructField("page", T.IntegerType()),
            T.StructField("html", T.StringType()),
        ]
    )
