"""Link books to a whole catalogue: the best of all entries, without comparing all pairs.

A score is a weighted mean of the title's and the author's similarity, so a pair that reaches a score
reaches it in the title or in the author. Two strings of together s characters that are similar by a
ratio r differ by (1 - r) * s inserted and deleted characters at most. Each of these breaks one pair of
neighbours at most, and takes half a common character, so the strings, with a mark at both ends, share
``s * (1.5 * r - 1) + 1`` pairs of neighbouring characters (grams) at least. Strings that share so many
of their grams share one among the rarest few of each: an inverted index needs the others' postings only
for those. Length and the number of shared grams are tested before any string is compared.

What is shared grows fast with the score, so the search goes down in steps: equal entries first, then
scores of 90 and more, 80, and the threshold. Each step finds all entries of its scores, so a book that
has one is done, and the weak filters of the low steps meet few books.

Strings are indexed once, however many entries have them. Postings of common grams are joined by gram
and a part of the string's hash, so no gram's postings lie in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import similarity as sim

# Scores of the steps above the threshold; 2/3 is where the bound on shared grams ends to say anything.
STEPS = (90.0, 80.0)
LEAST_THRESHOLD = 100.0 * 2 / 3
# Parts into which the postings of a gram are dealt.
PARTS = 16
_SLACK = 1e-6


def grams(text: Column) -> Column:
    """Pairs of neighbouring characters, with marks at both ends; repeated ones are numbered."""
    marked = F.concat(F.lit("\u0002"), text, F.lit("\u0003"))
    pairs = F.transform(F.sequence(F.lit(1), F.char_length(marked) - 1), lambda i: F.substr(marked, i, F.lit(2)))
    earlier = lambda g, i: F.size(F.filter(F.slice(pairs, F.lit(1), i), lambda x: x == g))
    return F.transform(pairs, lambda g, i: F.concat(g, earlier(g, i).cast("string")))


def least_shared(length: Column, ratio: float) -> Column:
    """Grams that a string of this length shares with any that is as similar, at least."""
    together = 2.0 * length / (2.0 - ratio)
    return F.ceil(together * (1.5 * ratio - 1.0) + 1.0 - _SLACK).cast("int")


def indexed(strings: DataFrame, frequency: DataFrame) -> DataFrame:
    """(text, n, grams): the grams of each string, the rarest first."""
    each = strings.select("text", F.posexplode(grams(F.col("text"))).alias("at", "gram"))
    known = each.join(frequency, "gram", "left")
    order = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram")
    listed = known.groupBy("text").agg(F.array_sort(F.collect_list(order)).alias("g"))
    return listed.select("text", F.char_length("text").alias("n"), F.transform("g", lambda x: x["gram"]).alias("grams"))


def similar_strings(asked: DataFrame, held: DataFrame, ratio: float) -> DataFrame:
    """(a, b, similarity) of all pairs of indexed strings that are similar by ``ratio`` or more."""

    def prefix(df: DataFrame) -> DataFrame:
        few = F.size("grams") - least_shared(F.col("n"), ratio) + 1
        return df.withColumn("gram", F.explode(F.slice("grams", F.lit(1), F.greatest(few, F.lit(1)))))

    part = F.pmod(F.xxhash64("text"), F.lit(PARTS))
    left = prefix(asked).select(F.col("text").alias("a"), F.col("n").alias("m"), F.col("grams").alias("g"), "gram")
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    right = prefix(held).select(F.col("text").alias("b"), "n", F.col("grams").alias("h"), "gram", part.cast("int").alias("part"))
    together = F.col("m") + F.col("n")
    shared = F.size(F.array_intersect("g", "h"))
    near = (
        left.join(right, ["gram", "part"])
        .filter(2.0 * F.least("m", "n") >= F.lit(ratio) * together - _SLACK)
        .filter(shared >= together * (1.5 * ratio - 1.0) + 1.0 - _SLACK)
        .select("a", "b")
        .distinct()
    )
    scored = near.withColumn("similarity", sim.ratios(F.col("a"), F.array("b"))[0])
    return scored.filter(F.col("similarity") >= 100.0 * ratio - _SLACK)


def _distinct(entries: DataFrame, column: str) -> DataFrame:
    return entries.select(F.col(column).alias("text")).distinct()


def _scored(pairs: DataFrame, column: str, least: float) -> DataFrame:
    """Candidates that reach a score, from pairs whose ``similarity`` in one column is known.

    The other column is compared only where its lengths let the score be reached.
    """
    other, weights = ("author", (sim.TITLE_WEIGHT, sim.AUTHOR_WEIGHT)) if column == "title" else ("title", (sim.AUTHOR_WEIGHT, sim.TITLE_WEIGHT))
    mine, theirs = F.col(other), F.col(f"c_{other}")
    bound = F.col("similarity") * F.lit(weights[0]) + sim.length_bound(mine, theirs) * F.lit(weights[1])
    compared = pairs.filter(bound >= least - _SLACK).withColumn("other", sim.ratios(mine, F.array(theirs))[0])
    t, w = ("similarity", "other") if column == "title" else ("other", "similarity")
    score = F.col(t) * F.lit(sim.TITLE_WEIGHT) + F.col(w) * F.lit(sim.AUTHOR_WEIGHT)
    return compared.select("title", "author", "c_title", "c_author", "first", score.alias("score")).filter(F.col("score") >= least)


def _best(scored: DataFrame) -> DataFrame:
    """Of each entry's candidates the best, of equal ones that whose entry comes first; a mergeable maximum."""
    top = F.max_by(F.struct("c_title", "c_author", "first"), F.struct("score", -F.col("first")))
    return scored.groupBy("title", "author").agg(F.max("score").alias("match_score"), top.alias("match"))


def with_best_entry(
    books: DataFrame, catalogue: DataFrame, order: str, threshold: float = sim.THRESHOLD, stored=None
) -> DataFrame:
    """Every book with ``match`` (a struct of the catalogue's columns, null if none is good enough) and ``match_score``.

    ``catalogue`` has ``title``, ``author`` and a whole number ``order`` without repeats; of equally
    good entries the first by it wins. Null titles and authors match nothing. ``stored`` writes a table
    and reads it again; with it each step starts from what the step before has left.
    """
    if threshold <= LEAST_THRESHOLD:
        raise ValueError(f"the index needs a threshold above {LEAST_THRESHOLD:.1f}")
    stored = stored or (lambda df, name: df)
    lower = lambda df: df.select(F.lower("title").alias("title"), F.lower("author").alias("author"))
    asked = lower(books).dropna().distinct()
    held = catalogue.select(F.lower("title").alias("c_title"), F.lower("author").alias("c_author"), F.col(order).cast("bigint").alias("first"))
    held = stored(held.dropna().groupBy("c_title", "c_author").agg(F.min("first").alias("first")), "entries")

    same = asked.join(held, (F.col("title") == F.col("c_title")) & (F.col("author") == F.col("c_author")))
    found = stored(_best(same.withColumn("score", F.lit(100.0))), "equal")
    results = [found]
    open_ = stored(asked.join(found.select("title", "author"), ["title", "author"], "left_anti"), "open")
    index = {}
    for column in ("title", "author"):
        texts = _distinct(held, f"c_{column}")
        counts = texts.select(F.explode(grams(F.col("text"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("df"))
        counts = stored(counts, f"{column}-grams")
        index[column] = (counts, stored(indexed(texts, counts), f"{column}-index"))
    for least in [s for s in STEPS if s > threshold] + [threshold]:
        routes = []
        for column in ("title", "author"):
            counts, texts = index[column]
            pairs = similar_strings(indexed(_distinct(open_, column), counts), texts, least / 100.0)
            pairs = pairs.select(F.col("a").alias(column), F.col("b").alias(f"c_{column}"), "similarity")
            routes.append(_scored(open_.join(pairs, column).join(held, f"c_{column}"), column, least))
        found = stored(_best(routes[0].union(routes[1])), f"found-{least:.0f}")
        results.append(found)
        open_ = stored(open_.join(found.select("title", "author"), ["title", "author"], "left_anti"), f"open-{least:.0f}")
    every = results[0]
    for more in results[1:]:
        every = every.union(more)
    entries = catalogue.select(F.struct(*catalogue.columns).alias("entry"), F.col(order).cast("bigint").alias("first"))
    told = every.select(F.col("title").alias("_t"), F.col("author").alias("_a"), "match_score", F.col("match.first").alias("first"))
    told = told.join(entries, "first").select("_t", "_a", F.col("entry").alias("match"), "match_score")
    keyed = (F.lower(books["title"]) == F.col("_t")) & (F.lower(books["author"]) == F.col("_a"))
    return books.join(told, keyed, "left").select(*[books[c] for c in books.columns], "match", "match_score")
