import datetime
import re
import urllib.parse

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import text as tx
from shelfmark.functions import urls


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("text", ["a b", "é/&?=+", "*~'!()-_.", "日本 x"])
def test_form_encoding(spark, text):
    assert value(spark, urls.form_encode(F.lit(text))) == urllib.parse.quote_plus(text)


@pytest.mark.parametrize(
    "url, expected",
    [
        ("/book/show/5.X?a=1?b", "https://books.example.org/book/show/5.X"),
        ("https://h.org/b/show/5", "https://h.org/b/show/5"),
        ("http://h.org/?q", "http://h.org/"),
    ],
)
def test_canonical_url(spark, url, expected):
    assert value(spark, urls.canonical_url(F.lit(url))) == expected


def test_ids_authors_and_review_urls(spark):
    assert value(spark, urls.catalogue_id(F.lit("/book/show/88.Rye_Fields"))) == "88"
    assert value(spark, urls.catalogue_id(F.lit("/book/5907"))) is None
    assert value(spark, urls.user_id(F.lit("/user/show/12-x"))) == "12"
    assert value(spark, urls.clean_author(F.lit("  by  A. B  "))) == "A. B"
    assert value(spark, urls.clean_author(F.lit("byron"))) == "byron"
    assert value(spark, urls.reviews_url(F.lit("http://x/1//"))) == "http://x/1/reviews"
    assert value(spark, urls.url_path(F.lit("http://x?q"))) == "/"
    assert value(spark, urls.url_path(F.lit("http://x/a/b?q#f"))) == "/a/b"


@pytest.mark.parametrize("url", ["https://x.org/a b/é-_1?q=2", "https://x.org/" + "y" * 300])
def test_flat_page_key(spark, url):
    key = value(spark, urls.flat_page_key(F.lit(url), F.lit("q=a")))
    safe = re.sub(r"[^\w\-_]", "_", url + "q=a")
    assert key == safe if len(safe) <= 200 else (key[:190] == safe[:190] and len(key) == 254)


def test_readable_page_key(spark):
    parameters = F.create_map(*[F.lit(x) for x in ("b", "2", "a", "1")])
    assert value(spark, urls.readable_page_key(F.lit('https://x/a\\b*c?d:"<>|'), parameters)) == "x_a_b_c_d______a=1_b=2"
    assert value(spark, urls.review_page_key(F.lit("http://x/r"), F.lit(3))) == "x_r_page=3"
    assert value(spark, urls.review_page_key(F.lit("http://x/r"), F.lit(None).cast("int"))) == "x_r"


@pytest.mark.parametrize("form", ["%b %d, %Y", "%B %d, %Y", "%Y-%m-%d"])
def test_dates_in_known_forms(spark, form):
    days = [datetime.datetime(2023, m, d) for m in range(1, 13) for d in (1, 9, 28)]
    rows = spark.createDataFrame([(d.strftime(form), d.isoformat()) for d in days], "t string, iso string")
    assert rows.filter(~tx.parse_date(F.col("t")).eqNullSafe(F.col("iso"))).count() == 0


@pytest.mark.parametrize("text", ["", "yesterday", "Feb 30, 2023", "15.01.2023", None])
def test_other_dates_are_null(spark, text):
    assert value(spark, tx.parse_date(F.lit(text).cast("string"))) is None


def test_text_helpers(spark):
    assert value(spark, tx.preview(F.lit("abcdef"), 3)) == "abc..."
    assert value(spark, tx.preview(F.lit("abc"), 3)) == "abc"
    assert value(spark, tx.preview(F.lit(None).cast("string"), 3)) is None
    assert value(spark, tx.display(F.lit(None))) == "Unknown"
    assert value(spark, tx.first_integer(F.lit("Liked 42 of 50"))) == 42
    assert value(spark, tx.first_integer(F.lit("none"))) is None
    for text, form, real in [
        ("2023-01-15T00:00:00", True, True), ("2023-13-15T00:00:00", True, False), ("2023-01-15", False, False),
        ("2023-01-15T00:00:00Z", False, False), (None, False, False),
    ]:
        text = F.lit(text).cast("string")
        assert value(spark, tx.is_iso_timestamp(text)) is form
        assert value(spark, F.coalesce(tx.is_real_timestamp(text), F.lit(False))) is real
