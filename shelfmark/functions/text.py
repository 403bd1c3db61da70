"""Text and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The timestamp form the output must have, and the date forms the pages use.
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"
DATE_FORMATS = ["MMM d, yyyy", "MMMM d, yyyy", "yyyy-M-d"]


# Fixed value: white space of all kinds. Plain ``trim`` removes blanks only.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


# What counts as a line-break tag, and as a tag.
LINE_BREAK = r"<br\s*/?>"
TAG = r"<[^>]+>"


def strip_markup(text: Column) -> Column:
    """Line-break tags become newlines, every other tag goes."""
    lines = F.when(F.contains(text, F.lit("<br")), F.regexp_replace(text, LINE_BREAK, "\n")).otherwise(text)
    return F.when(F.contains(text, F.lit("<")), F.regexp_replace(lines, TAG, "")).otherwise(text)


def preview(text: Column, length: int) -> Column:
    return F.when(F.char_length(text) > length, F.concat(F.left(text, F.lit(length)), F.lit("..."))).otherwise(text)


def display(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("Unknown"))


def first_integer(text: Column) -> Column:
    """First run of digits as a number, null when there is none or it does not fit."""
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("bigint")


def parse_date(text: Column) -> Column:
    """ISO timestamp text of a date in any of the known forms; null when none fits."""
    day = F.coalesce(*[F.try_to_date(text, form) for form in DATE_FORMATS])
    return F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss")


def is_iso_timestamp(text: Column) -> Column:
    """Shape test only: it accepts impossible dates such as month 13."""
    return F.coalesce(text.rlike(ISO_TIMESTAMP), F.lit(False))


def is_real_timestamp(text: Column) -> Column:
    """Shape test plus a calendar test."""
    parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return is_iso_timestamp(text) & parsed.isNotNull()
