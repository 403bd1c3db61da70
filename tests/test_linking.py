import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import similarity as sim
from shelfmark.operators.linking import link_books, search_page_key, with_best_match

CANDIDATES = [
    ("Salt Roads North", "Ida Marsh", "u0", "31"),
    ("Salt Roads North, with maps", "Ida Marsh & Per Holm", "u1", "32"),
    ("North by Salt: A Play", "Per Holm", "u2", "33"),
]


def score(title, author, entry):
    """The weighted score, with common subsequences from the textbook table."""

    def ratio(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row
            row = [0]
            for j, y in enumerate(b):
                row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
        return 200.0 * row[-1] / (len(a) + len(b))

    return round(0.6 * ratio(title.lower(), entry[0].lower()) + 0.4 * ratio(author.lower(), entry[1].lower()), 2)


SCHEMA = "id int, title string, author string, candidates array<struct<title:string,author:string,url:string,catalogue_id:string>>"


def best(spark, title, author, candidates=CANDIDATES, **options):
    df = spark.createDataFrame([(1, title, author, candidates)], SCHEMA)
    row = with_best_match(df, **options).first()
    return (row.match.url if row.match else None), (round(row.match_score, 2) if row.match_score else None)


@pytest.mark.parametrize(
    "title, author, url",
    [
        ("Salt Roads North", "Ida Marsh", "u0"),
        ("Salt Rods North", "I. Marsh", "u0"),
        ("SALT roads NORTH", "iDA mARSH", "u0"),
        ("Salt Roads North with map", "Marsh & Holm", "u1"),
        ("Winter Crossings", "Ida Marsh", None),
        ("Salt Roads North", "Somebody Else Entirely", None),
        (None, "Ida Marsh", None),
        ("Salt Roads North", None, None),
    ],
)
def test_scores(spark, title, author, url):
    if title and author:
        best_score, entry = max((score(title, author, c), c[2]) for c in CANDIDATES)
        assert (entry if best_score >= 70 else None) == url
        assert best(spark, title, author) == (url, best_score if url else None)
    else:
        assert best(spark, title, author) == (None, None)


def test_scores_below_the_threshold(spark):
    low = score("Winter Crossings", "Ida Marsh", CANDIDATES[0])
    assert 40 < low < 70 and best(spark, "Winter Crossings", "Ida Marsh", CANDIDATES[:1], threshold=40) == ("u0", low)


def test_first_wins_ties_and_no_candidates(spark):
    same = [("a", "b", f"u{i}", "1") for i in range(3)]
    assert best(spark, "a", "b", [("x", "y", "no", "1"), *same]) == ("u0", 100.0)
    assert best(spark, "a", "b", []) == (None, None)
    assert best(spark, "a", "b", None) == (None, None)


def test_link_books_keeps_every_book(spark):
    books = spark.createDataFrame(
        [("1", "Salt Roads North", "Ida Marsh"), ("1", "Salt Roads North", "Ida Marsh"), ("2", "Emma", "Jane Austen"), ("3", None, "x")],
        "book_id string, title string, author string",
    )
    pages = (
        spark.createDataFrame([(1, "Salt Roads North", "Ida Marsh", CANDIDATES)], SCHEMA)
        .withColumn("search_key", search_page_key(F.col("title"), F.col("author")))
        .select("search_key", "candidates")
    )
    linked = sorted((r.book_id, r.book_url) for r in link_books(books, pages).collect() if r.book_url)
    assert linked == [("1", "u0"), ("1", "u0")]
    assert link_books(books, pages).count() == 4


def by_table(a, b):
    """Textbook table for the longest common subsequence."""
    cells = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            cells[i + 1][j + 1] = cells[i][j] + 1 if x == y else max(cells[i][j + 1], cells[i + 1][j])
    return 200 * cells[-1][-1] / (len(a) + len(b)) if a or b else 100.0


words = st.text(alphabet="abcdé ★", max_size=90)


@settings(max_examples=300, deadline=None)
@given(words, words)
def test_ratio_properties(a, b):
    r = sim._ratio(a, b)
    assert abs(r - by_table(a, b)) < 1e-9
    assert 0 <= r <= 100
    assert abs(r - sim._ratio(b, a)) < 1e-9
    assert sim._ratio(a, a) == 100


def test_prefilter_drops_no_match(spark):
    import random

    rng = random.Random(5)

    def text(most):
        return "".join(rng.choice("ab ") for _ in range(rng.randint(0, most)))

    rows = [(i, text(12), text(8), [(text(14), text(9), "u", "1") for _ in range(6)]) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    near = F.filter("candidates", lambda c: sim.could_match(F.col("title"), F.col("author"), c["title"], c["author"], 70.0))
    for row in df.withColumn("near", near).collect():
        good = [
            c for c in row.candidates
            if 0.6 * sim._ratio(row.title, c.title) + 0.4 * sim._ratio(row.author, c.author) >= 70
        ]
        assert all(c in row.near for c in good)
