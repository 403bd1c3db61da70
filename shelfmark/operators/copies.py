"""Which rows of a page store a job reads: the wanted ones, answered well, one copy of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.keyfilter import possibly_in
from shelfmark.operators.pagecheck import usable_pages


def only_wanted(pages: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Pages whose key is wanted, and a few others; the join that follows the extraction drops those.

    ``wanted`` is one narrow column, of any length: what goes to the pages is a filter of bounded size,
    so page texts are neither shuffled nor parsed for books that are not listed.
    """
    return possibly_in(pages, key, wanted)


def answered(pages: DataFrame) -> DataFrame:
    """Pages without failed answers and captchas, where the store says how the site answered.

    A store of keys without texts is judged by the status alone.
    """
    if "status" not in pages.columns:
        return pages
    return usable_pages(pages) if "html" in pages.columns else pages.filter("status = 200")


def digest(html: Column) -> Column:
    """Decides between copies that were saved at the same time."""
    return F.xxhash64(html)


def latest_copies(rows: DataFrame, key: list[str], saved_at: str | None, tie: str) -> DataFrame:
    """One row per key: that saved last. Unknown times come before all others, ``tie`` decides ties.

    For narrow rows, or rows with extracted values: whatever the rows carry is shuffled. The rank
    filter becomes a limit per partition, so the copies of a hot key go where they lie.
    """
    order = [F.col(tie).desc()]
    if saved_at is not None:
        order = [F.col(saved_at).desc_nulls_last(), *order]
    ranked = rows.withColumn("_copy", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("_copy = 1").drop("_copy")


def saved_at_of(pages: DataFrame) -> str | None:
    return "saved_at" if "saved_at" in pages.columns else None
