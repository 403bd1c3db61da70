"""URLs, ids in URLs, and the keys under which pages are stored."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import strip
from shelfmark.site import DEFAULT_SITE, Site


def form_encode(text: Column) -> Column:
    """Form encoding that escapes ``*`` and leaves ``~``, unlike the JVM's default."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def search_query(title: Column, author: Column) -> Column:
    """Null when either part is null: such a book cannot be searched for."""
    return F.concat(title, F.lit(" "), author)


def search_parameters(title: Column, author: Column) -> Column:
    return F.concat(F.lit("q="), form_encode(search_query(title, author)))


def reviews_url(book_url: Column) -> Column:
    return F.concat(F.regexp_replace(book_url, "/+$", ""), F.lit("/reviews"))


def absolute_url(url: Column, site: Site = DEFAULT_SITE) -> Column:
    return F.when(F.startswith(url, F.lit("http")), url).otherwise(F.concat(F.lit(site.base_url), url))


def without_query(url: Column) -> Column:
    return F.regexp_replace(url, r"\?.*$", "")


def canonical_url(url: Column, site: Site = DEFAULT_SITE) -> Column:
    return without_query(absolute_url(url, site))


def _number_after(url: Column, marker: str) -> Column:
    return F.nullif(F.regexp_extract(url, marker + r"(\d+)", 1), F.lit(""))


def catalogue_id(url: Column) -> Column:
    return _number_after(url, "/show/")


def user_id(url: Column) -> Column:
    return _number_after(url, "/user/show/")


def url_path(url: Column) -> Column:
    """Path of an absolute URL, at least ``/``."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def clean_author(author: Column) -> Column:
    trimmed = strip(author)
    without_by = strip(F.substring(trimmed, F.lit(4), F.char_length(trimmed)))
    return F.when(F.startswith(trimmed, F.lit("by ")), without_by).otherwise(trimmed)


def flat_page_key(url: Column, parameters: Column | None = None) -> Column:
    """Key form 1: every character but letters, digits, ``_`` and ``-`` becomes ``_``.

    Keys over 200 characters are cut to 190 and completed by a digest of the whole URL, so that
    they stay distinct.
    """
    whole = url if parameters is None else F.concat(url, F.coalesce(parameters, F.lit("")))
    safe = F.regexp_replace(whole, r"[^\p{L}\p{N}_\-]", "_")
    cut = F.concat(F.left(safe, F.lit(190)), F.sha2(whole, 256))
    return F.when(F.char_length(safe) > 200, cut).otherwise(safe)


def readable_page_key(url: Column, parameters: Column | None = None) -> Column:
    """Key form 2: no scheme, characters unsafe in file names become ``_``, then sorted ``_k=v``.

    ``parameters`` is a map<string,string> column.
    """
    bare = F.replace(F.replace(url, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    safe = F.regexp_replace(bare, r'[\\/*?:"<>|]', "_")
    if parameters is None:
        return safe
    pairs = F.transform(
        F.array_sort(F.map_entries(parameters)),
        lambda e: F.concat(F.lit("_"), e["key"], F.lit("="), e["value"]),
    )
    return F.concat(safe, F.coalesce(F.array_join(pairs, ""), F.lit("")))


def review_page_key(page_url: Column, page: Column) -> Column:
    """Form 2 key of one numbered review page; a null number means no parameter."""
    numbered = readable_page_key(page_url, F.create_map(F.lit("page"), page.cast("string")))
    return F.when(page.isNull(), readable_page_key(page_url)).otherwise(numbered)
