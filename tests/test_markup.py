from pyspark.sql import functions as F

from shelfmark.functions.markup import _Scan, scan, text_of
from shelfmark.operators.markupreviews import candidate_rows, markup_reviews, with_candidates
from shelfmark.schema import MARKUP_REVIEW



def box(*parts, attributes=""):
    """A review box with the given parts, in the order they are given."""
    return f'<div class="review" {attributes}>{"".join(parts)}</div>'


def text(words):
    return f'<div class="reviewText"><span> {words} </span></div>'


def stars(title):
    return f'<span class="staticStars" title="{title}"></span>'


def found(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return [r.asDict() for r in markup_reviews(df).orderBy("i", "pos").collect()]


def test_review_fields(spark):
    """Parts may come in any order; each is found by its class."""
    who = '<em><a class="reviewerName" href="/user/show/8080-wim?ref=nav">Wim</a></em>'
    full = box(
        '<div class="shelves">Shelves: maps ,\n\ttrains, north</div>', '<span class="commentCount">11 comments</span>', text("Rails &lt;and&gt; ice"),
        '<span class="likeReview">7 likes</span>', stars("2 stars"), '<span class="reviewDate">August 9, 1987</span>', who, attributes='id="entry-6"',
    )
    sparse = box('<span class="reviewDate">Dec 31, 2004</span>', text("Cold<br>and long"), '<span class="likeReview">no likes</span>')
    first, second = found(spark, f"<section class='reviewsContainer'>{full}{sparse}</section>")
    values = dict(zip(("i", "pos", "review_text", "review_rating", "reviewer_id"), (0, 0, "Rails <and> ice", 2.0, "8080")))
    values |= dict(zip(("reviewer_name", "review_upvotes", "review_downvotes", "comment_count"), ("Wim", 7, 0, 11)))
    values |= {"review_date": "1987-08-09T00:00:00", "date_unparsed": False, "shelves": ["maps", "trains", "north"]}
    assert first == values | {"review_url": "https://books.example.org/review/show/entry-6"}
    assert second["review_text"] == "Coldand long" and second["review_date"] == "2004-12-31T00:00:00"
    assert second["review_upvotes"] == 0 and second["reviewer_id"] is None and second["shelves"] == []


def test_schema(spark):
    df = markup_reviews(spark.createDataFrame([], "html string")).drop("pos", "date_unparsed")
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in MARKUP_REVIEW]


def test_fallbacks(spark):
    rows = found(
        spark,
        box('<span class="readable"><span>short</span></span><div class="reviewText"><span>long</span></div>')
        + box('<div class="reviewText">bare</div>')
        + box('<div class="reviewText"><b>bold</b></div><span class="staticStars plain p35">★</span>')
        + box('<span class="staticStars" title="1 star">★☆</span>')
        + box('<span class="staticStars">☆☆</span>')
        + box('<span class="staticStars p00">★★</span>')
        + box('<a class="reviewDate" href="/review/show/9">2023-1-5</a>', attributes='id="r9"')
        + box('<span class="reviewDate">yesterday</span>', attributes='id=""')
        + box('<a class="actionLinkLite bookPageGenreLink">x </a><a class="bookPageGenreLink">no</a><div class="shelves">y</div>')
        + box('<a class="user" href="/u/1">N</a><a class="reviewerName" href="/user/show/2">M</a>'),
    )
    assert [r["review_text"] for r in rows[:3]] == ["short", "bare", "bold"]
    assert [r["review_rating"] for r in rows[2:6]] == [3.5, 1.0, None, 2.0]
    assert rows[6]["review_url"] == "https://books.example.org/review/show/9"
    assert (rows[6]["review_date"], rows[6]["date_unparsed"]) == ("2023-01-05T00:00:00", False)
    assert (rows[7]["review_date"], rows[7]["date_unparsed"], rows[7]["review_url"]) == (None, True, None)
    assert rows[8]["shelves"] == ["x"]
    assert (rows[9]["reviewer_id"], rows[9]["reviewer_name"]) == (None, "N")
    assert rows[0]["shelves"] == [] and rows[0]["comment_count"] == 0 and rows[0]["review_date"] is None


def test_other_review_boxes_and_broken_markup(spark):
    assert len(found(spark, '<ul class="reviewsContainer"><li class="review">a<li class="review">b</ul>')) == 2
    unclosed = '<div class="review"><p><b><div class="reviewText">one</div><div class="review"><div class="reviewText">two'
    assert [r["review_text"] for r in found(spark, unclosed)] == ["one", "two"]
    assert found(spark, None, "", "<p>nothing", "<script><div class='review'></div></script>") == []


def test_elements_do_not_see_script_or_comment_text(spark):
    df = spark.createDataFrame([("<div class=a>x<script>y</script><!-- z --><style>w</style>&eacute;</div></p>",)], "html string")
    found = df.select(scan(F.col("html"), ["div.a", "script"]).alias("f"))
    texts = F.transform("f.elements", lambda e: text_of(e, F.col("f.pieces")))
    assert found.select(texts).first()[0] == ["xé", ""]


def test_malformed_declaration_is_an_empty_page(spark):
    assert found(spark, "<![bogus[ x ]]><div class=review>a</div>", "<div class=review>b</div>")[0]["i"] == 1


def test_scan_of_deep_nesting_stays_as_small_as_the_page():
    result = _Scan(["span.readable span"]).result("<span class=readable>" + "<span>a" * 5000)
    assert len(result["elements"]) == 5000 and len(result["pieces"]) == 5000


def candidates(spark, html):
    df = spark.createDataFrame([(1, html)], "i int, html string")
    rows = candidate_rows(with_candidates(df)).orderBy("pos").collect()
    return [(r.pos, r.title, r.author, r.url, r.catalogue_id) for r in rows]


def test_search_results_in_boxes(spark):
    """Results without an author or a number of their own are passed over."""
    entries = [
        ("/book/show/5.Salt", "Salt", "<div class='authorName'>Wren &amp; Oak</div>"), ("/book/show/6", "Alone", ""),
        ("/list/6", "A list", "<div class='authorName'>Many</div>"), ("https://books.example.org/book/show/880?q=1", " Rye ", "<div class='authorName'>by Ash</div>"),
    ]
    html = "".join(f"<div class='bookTitle'>{author}<a href='{href}'>{title}</a></div>" for href, title, author in entries)
    base = "https://books.example.org/book/show/"
    assert candidates(spark, html) == [(0, "Salt", "Wren & Oak", f"{base}5.Salt", "5"), (1, "Rye", "Ash", f"{base}880", "880")]


def test_search_results_in_a_table_come_first(spark):
    html = """<table class="tableList"><tr><td><a class="bookTitle" href="/book/show/1"><span>One</span></a>
      <a class="authorName">A</a></td></tr><tr><td>advertisement</td></tr></table>
      <div class="bookTitle"><a href="/book/show/2">Two</a><div class="authorName">B</div></div>"""
    assert [c[1] for c in candidates(spark, html)] == ["One"]
    assert candidates(spark, "<p>nothing found</p>") == []


def test_text_outside_elements_is_left_empty():
    page = (
        '<p>before</p><div class="a"><i class="b">1</i><div class="a b"><br class="b">2</div><b>3</b></div>\n'
        '<i class="b">4</i>after<div class="a"><i class="b">5<div class="a">'
    )
    scanned = _Scan(["div.a", ".b", ".a .b"]).result(page)
    assert scanned["pieces"] == ["", "1", "2", "3", "", "4", "", "5"]
    assert _Scan(["div.c"]).result(page) == {"pieces": [""] * 8, "elements": []}
