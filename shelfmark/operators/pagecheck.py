"""What kind of page was saved, and what is in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.jsonmap import as_map, filled, or_empty, pick, truthy
from shelfmark.functions.jsonmap import reference
from shelfmark.functions.text import preview
from shelfmark.operators.pagestate import TEXT, review_keys, with_state

# Fixed value: what a review page without reviews says.
NO_REVIEWS = "No reviews yet"


def is_captcha(html: Column) -> Column:
    return F.contains(F.lower(html), F.lit("captcha"))


def says_no_reviews(html: Column) -> Column:
    return F.contains(html, F.lit(NO_REVIEWS))


def response_class(status: Column, html: Column) -> Column:
    """captcha, retryable (server error or rate limit), usable, or other."""
    return (
        F.when(is_captcha(html), "captcha")
        .when((status >= 500) | (status == 429), "retryable")
        .when(status == 200, "usable")
        .otherwise("other")
    )


def usable_pages(pages: DataFrame, status: str = "status", html: str = "html") -> DataFrame:
    return pages.filter(response_class(F.col(status), F.col(html)) == "usable")


def quarantine(pages_with_reviews: DataFrame) -> DataFrame:
    """Pages that gave no review, with the reason and the state that was looked at."""
    return pages_with_reviews.filter(F.size("reviews") == 0).withColumnRenamed("review_source", "reason").drop("reviews")


def entity_profile(pages: DataFrame, html: str = "html") -> DataFrame:
    """Per page: entities in the state, review objects among them, and a look at the first review."""
    kept = [c for c in pages.columns if c != html]
    col = F.col
    staged = (
        with_state(pages, html)
        .withColumn("reviews_in_state", or_empty(review_keys(col("entities")), "string"))
        .withColumn("first", as_map(col("entities")[F.get("reviews_in_state", F.lit(0))]))
        .withColumn("user", as_map(col("entities")[reference(pick(col("first"), ["user"], "{}"))]))
    )
    return staged.select(
        *kept,
        "has_state",
        F.coalesce(F.size("entities"), F.lit(0)).alias("n_entities"),
        F.size("reviews_in_state").alias("n_reviews"),
        F.array_join(F.map_keys("first"), ",").alias("first_fields"),
        preview(pick(col("first"), ["text"], ""), 100).alias("first_preview"),
        pick(col("first"), ["rating"]).alias("first_rating"),
        pick(col("user"), ["id"]).alias("first_user_id"),
        pick(col("user"), ["name"]).alias("first_user_name"),
    )


def entity_types(pages: DataFrame, html: str = "html") -> DataFrame:
    """Entities per type over the whole corpus. Only the type names are exploded and shuffled."""
    names = F.transform(F.map_keys("entities"), lambda k: F.substring_index(k, ":", 1))
    return (
        with_state(pages, html)
        .select(F.explode(names).alias("entity_type"))
        .groupBy("entity_type")
        .agg(F.count("*").alias("n_entities"))
    )


def review_content(pages: DataFrame, html: str = "html") -> DataFrame:
    """Over all review objects of the corpus: how many there are, with text, and with a rating."""
    objects = F.transform(review_keys(F.col("entities")), lambda k: as_map(F.col("entities")[k]))
    rows = with_state(pages, html).select(F.explode(objects).alias("m"))
    return rows.agg(
        F.count("*").alias("n_reviews"),
        F.count_if(filled(pick(F.col("m"), TEXT, ""))).alias("n_with_text"),
        F.count_if(truthy(pick(F.col("m"), ["rating"]))).alias("n_with_rating"),
    )


def empty_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages checked and pages that say they have no reviews."""
    return pages.agg(
        F.count("*").alias("n_pages"), F.count_if(says_no_reviews(F.col(html))).alias("n_empty")
    )


def first_pages(pages: DataFrame, n: int, key: str = "page_key") -> DataFrame:
    """The first n pages by key: a top-k, not a full sort."""
    return pages.orderBy(key).limit(n)
