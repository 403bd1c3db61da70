"""Link books to catalogue entries: the best of the search results of each book.

Candidates are the results on the saved search page of that book's own query, so the join is an
equi-join on the page key and the comparison stays inside the row: no pairs are exploded, no group
is collected, and the arg-max needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import similarity as sim
from shelfmark.functions.urls import flat_page_key, search_parameters
from shelfmark.site import DEFAULT_SITE, Site

SEARCH_KEY = "search_key"


def search_page_key(title: Column, author: Column, site: Site = DEFAULT_SITE) -> Column:
    return flat_page_key(F.lit(site.search_url), search_parameters(title, author))


def with_best_match(books: DataFrame, candidates: str = "candidates", threshold: float = sim.THRESHOLD) -> DataFrame:
    """Replace an array of candidates by ``match`` (null if none is good enough) and ``match_score``.

    Scores are weighted title and author similarities. Equal scores: the first candidate wins.
    """
    kept = [c for c in books.columns if c != candidates]
    col = F.col
    plausible = F.filter(
        F.transform(candidates, lambda c, i: c.withField("pos", i)),
        lambda c: sim.could_match(col("title"), col("author"), c["title"], c["author"], threshold),
    )
    scored = (
        books.withColumn("_near", plausible)
        .withColumn("_by_title", sim.ratios(col("title"), F.transform("_near", lambda c: c["title"])))
        .withColumn("_by_author", sim.ratios(col("author"), F.transform("_near", lambda c: c["author"])))
    )
    score = F.zip_with(
        "_by_title", "_by_author", lambda t, a: t * F.lit(sim.TITLE_WEIGHT) + a * F.lit(sim.AUTHOR_WEIGHT)
    )
    ranked = F.zip_with(
        F.col("_near"),
        F.col("_scores"),
        lambda c, s: F.struct(s.alias("score"), (-c["pos"]).alias("early"), c.alias("match")),
    )
    best = F.array_max(F.filter(ranked, lambda r: r["score"] >= threshold))
    return (
        scored.withColumn("_scores", score)
        .withColumn("_best", best)
        .select(*kept, col("_best.match").alias("match"), col("_best.score").alias("match_score"))
    )


def link_books(
    books: DataFrame,
    search_pages: DataFrame,
    threshold: float = sim.THRESHOLD,
    site: Site = DEFAULT_SITE,
) -> DataFrame:
    """Every book with the URL of its best match, null when it has none.

    ``search_pages`` holds ``search_key`` and ``candidates``, one row per search page.
    """
    keyed = books.withColumn(SEARCH_KEY, search_page_key(F.col("title"), F.col("author"), site))
    joined = keyed.join(search_pages.select(SEARCH_KEY, "candidates"), SEARCH_KEY, "left")
    matched = with_best_match(joined, threshold=threshold)
    return matched.select(*books.columns, F.col("match.url").alias(site.url_column))
