"""Readers. Schemas are stated, never inferred, and ids are strings."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.urls import readable_page_key
from shelfmark.schema import BOOK_COLUMNS, HEADER_ALIASES, RAW_RATING, required_columns, review_table
from shelfmark.site import DEFAULT_SITE, Site
from shelfmark.sources.pagefiles import NO_KEY
from shelfmark.sources.records import read_records

# Quotes are doubled inside quoted fields, which may span lines.
CSV = {"header": "true", "escape": '"'}
# At most, to read small files.
TASKS_PER_CORE = 16


def read_csv(spark: SparkSession, path: str, multi_line: bool = True, seq: str | None = None) -> DataFrame:
    """All columns as strings, by header name; empty fields are null.

    Fields may span lines; large files are read by several tasks all the same, twice. Where no field
    does, ``multi_line=False`` leaves it to Spark's reader, which reads once. ``seq`` names a column
    that numbers the rows in the order of the file.
    """
    if multi_line or seq:
        return read_records(spark, path, CSV, seq)
    return spark.read.options(**CSV).csv(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns the schema knows, leave others as they are. What does not fit becomes null."""
    types = {f.name: f.dataType for f in schema.fields}
    cols = []
    for name in df.columns:
        wanted = types.get(name)
        if isinstance(wanted, T.ArrayType):
            cols.append(F.from_json(name, wanted).alias(name))
        else:
            cols.append(F.col(name).try_cast(wanted).alias(name) if wanted else F.col(name))
    return df.select(*cols)


def book_list(books: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Rename known header spellings; raise if a required column is missing."""
    renamed = books.withColumnsRenamed(HEADER_ALIASES)
    missing = [c for c in [*BOOK_COLUMNS, *(extra or [])] if c not in renamed.columns]
    if missing:
        raise ValueError(f"book list lacks the columns {missing}")
    return renamed.withColumns({c: F.col(c).cast("string") for c in BOOK_COLUMNS})


def unlinked(books: DataFrame, site: Site = DEFAULT_SITE) -> DataFrame:
    """A book list before linking: its URL column is there and null."""
    return book_list(books).withColumn(site.url_column, F.lit(None).cast("string"))


def read_book_list(spark: SparkSession, path: str, multi_line: bool = True, seq: str | None = None) -> DataFrame:
    """The list; with ``seq`` (see ``BOOK_SEQ``) its order can be given back by the tables made from it."""
    return book_list(read_csv(spark, path, multi_line, seq))


def linked_books(spark: SparkSession, books: DataFrame | str, site: Site = DEFAULT_SITE) -> DataFrame:
    """Linked list from a table or a CSV path."""
    table = books if isinstance(books, DataFrame) else read_csv(spark, str(books))
    if site.url_column not in table.columns:
        raise ValueError(f"book list lacks the column {site.url_column!r}")
    return table


def read_reviews(spark: SparkSession, path: str, site: Site = DEFAULT_SITE) -> DataFrame | None:
    """A review table from CSV; None if there is no such file.

    The rating is read as a number, null where it is none, and ``review_rating_raw`` keeps it as it
    was written: the rules tell a missing rating from one that is no number.
    """
    schema = review_table(site.url_column)
    schema["review_rating"].dataType = T.DoubleType()
    schema = schema.add("review_downvotes", T.LongType()).add("comment_count", T.LongType())
    schema = schema.add("shelves", T.ArrayType(T.StringType()))
    try:
        raw = read_csv(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if "review_rating" in raw.columns:
        raw = raw.withColumn(RAW_RATING, F.col("review_rating"))
    return conform(raw, schema)


def empty_reviews(spark: SparkSession, site: Site = DEFAULT_SITE) -> DataFrame:
    """The nine required columns and no rows."""
    names = required_columns(site.url_column)
    return spark.createDataFrame([], review_table(site.url_column)).select(*names)


def read_saved_pages(spark: SparkSession, folder: str, pattern: str = "*.html") -> DataFrame:
    """Saved pages, one file each: ``page_key`` is the file name, ``page`` the number in it.

    Where files lie in folders named ``page_key=...``, as Spark writes them, that is the key.
    Invalid bytes are replaced, not fatal. Many small files are slow to list at scale: write the
    result once as parquet and read that afterwards.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    # Spark deals a few small files to a task, and what follows would write a file for each of those tasks.
    files = files.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    named = F.when(name != NO_KEY, F.regexp_replace(F.url_decode(name), r"\.html?$", ""))
    key = F.col("page_key").cast("string") if "page_key" in files.columns else named
    return files.select(
        key.alias("page_key"),
        F.regexp_extract(key, r"_page=(\d+)$", 1).try_cast("int").alias("page"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("html"),
    )


def keyed_pages(pages: DataFrame) -> DataFrame:
    """Add the storage key to a page table that has URL and number."""
    numbered = F.create_map(F.lit("page"), F.col("page").cast("string"))
    key = F.when(F.col("page").isNull(), readable_page_key(F.col("page_url"))).otherwise(
        readable_page_key(F.col("page_url"), numbered)
    )
    return pages.withColumn("page_key", key)
