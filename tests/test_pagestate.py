import pytest
from conftest import page, page_table
from pyspark.sql import functions as F

from shelfmark.operators import pagestate
from shelfmark.operators.pagecheck import quarantine
from shelfmark.operators.pagestate import review_rows, with_reviews


def extract(spark, html):
    """Source and reviews of one page."""
    row = with_reviews(page_table(spark, html)).select("review_source", "reviews").first()
    return row.review_source, [r.asDict() for r in row.reviews]


def entities(**objects):
    return {k.replace("__", ":"): v for k, v in objects.items()}


def by_edges(*keys, **more):
    edges = [{"node": {"__ref": k}} for k in keys]
    return {"ROOT_QUERY": {'book({"id":1})': {"reviews": {"edges": edges}}}, **entities(**more)}


def test_reviews_and_users_by_reference(spark):
    """Three readers on one page, of whom one is known under an older number, and one review of no reader."""
    readers = {"User:k1": {"name": "Ora", "id": "k1"}, "User:k2": {"name": "Pim", "id": "k2", "legacyId": 90}, "User:k3": {"id": "k3"}}
    written = [("k2", "body", "dateAdded"), ("k3", "text", "createdAt"), ("k1", "body", "createdAt"), (None, "text", "dateAdded")]
    state = {"ROOT_QUERY": {"viewer": None}}
    for place, (reader, text, date) in enumerate(written):
        review = {text: f"Page {place} read", date: f"1999-0{place + 3}-28T05:06:07", "rating": place + 0.5, "likesCount": place * 3}
        if reader:
            review["creator"] = {"__ref": f"User:{reader}"}
        state[f"Review:{9 - place}"] = review
    source, found = extract(spark, page(apolloState=state | readers))
    assert source == "entities"
    assert [(r["reviewer_id"], r["reviewer_name"]) for r in found] == [("90", "Pim"), ("k3", ""), ("k1", "Ora"), ("unknown_3", "")]
    for place, r in enumerate(found):
        assert r["review_text"] == f"Page {place} read" and r["review_rating"] == place + 0.5
        assert r["review_date"] == f"1999-0{place + 3}-28T05:06:07" and r["review_upvotes"] == 3 * place and r["review_url"] == ""


def test_edges_come_before_other_entities_and_odd_edges_are_skipped(spark):
    state = by_edges("Review:b", "Review:gone", Review__a={"text": "a"}, Review__b={"text": "b"}, Review__e={})
    edges = state["ROOT_QUERY"]['book({"id":1})']["reviews"]["edges"]
    edges += [5, None, "x", {"node": "s"}, {"node": {"other": 1}}, {"node": {"__ref": "Review:e"}}]
    source, found = extract(spark, page(apolloState=state))
    assert (source, [r["review_text"] for r in found]) == ("edges", ["b"])


def test_entities_keep_page_order(spark):
    names = ["z", "m", "a", "q"]
    state = {f"Review:{n}": {"text": n, "userId": n} for n in names}
    _, found = extract(spark, page(apolloState=state))
    assert [r["review_text"] for r in found] == names


def test_repeated_key_takes_the_last_value_at_the_first_place(spark):
    html = page(apolloState={"Review:a": {"text": "old"}, "Review:b": {"text": "b"}})
    html = html.replace('"Review:b": {"text": "b"}', '"Review:b": {"text": "b"}, "Review:a": {"text": "new"}')
    _, found = extract(spark, html)
    assert [r["review_text"] for r in found] == ["new", "b"]


@pytest.mark.parametrize(
    "review, users, expected",
    [
        ({"creator": {"__ref": "User:1"}}, {"User:1": {"legacyId": 7, "id": "x", "name": "N"}}, ("7", "N")),
        ({"creator": {"__ref": "User:1"}, "user": {"__ref": "User:2"}}, {"User:2": {"id": "2"}}, ("unknown_0", None)),
        ({"user": {"__ref": "User:1"}}, {"User:1": {"id": "x"}}, ("x", "")),
        ({"user": {"__ref": "User:1"}}, {"User:1": {}}, ("unknown_0", None)),
        ({"user": {"id": "inline", "name": "ignored"}, "userId": "u", "userName": "U"}, {}, ("u", "U")),
        ({"user": {"id": "inline"}, "id": "own"}, {}, ("own", "")),
        ({"user": None}, {}, ("unknown_0", "")),
        ({}, {}, ("unknown_0", "")),
    ],
)
def test_reviewer_of_a_linked_review(spark, review, users, expected):
    state = {"Review:1": {"text": "t", **review}, **users}
    _, found = extract(spark, page(apolloState=state))
    assert (found[0]["reviewer_id"], found[0]["reviewer_name"]) == expected


def test_text_markup_reference_and_present_null(spark):
    state = {
        "Review:1": {"text": "a<br/>b<BR>c <i>d</i> <br >e", "id": "1"},
        "Review:2": {"text": {"__ref": "Text:1"}, "id": "2"},
        "Text:1": {"body": "<b>from there</b>"},
        "Review:3": {"text": None, "body": "not used", "rating": 3, "id": "3"},
        "Review:4": {"body": "from body", "id": "4"},
        "Review:5": {"text": {"__ref": "Text:gone"}, "rating": 1, "id": "5"},
    }
    _, found = extract(spark, page(apolloState=state))
    assert [r["review_text"] for r in found] == ["a\nbc d \ne", "from there", None, "from body", ""]


def test_acceptance_and_numbering_of_linked_reviews(spark):
    state = {
        "Review:1": {"text": "", "rating": 0},
        "Review:2": {"text": "x"},
        "Review:3": {"rating": None},
        "Review:4": {"rating": 4.5},
        "Review:5": {"text": "y", "userId": "u"},
        "Review:6": {"text": "z"},
    }
    _, found = extract(spark, page(apolloState=state))
    assert [(r["reviewer_id"], r["review_rating"]) for r in found] == [
        ("unknown_0", None), ("unknown_1", 4.5), ("u", None), ("unknown_3", None),
    ]


def test_field_aliases(spark):
    state = {
        "Review:1": {"text": "a", "likesCount": 1, "likes": 2, "createdAt": "c", "dateAdded": "d", "url": "/u"},
        "Review:2": {"text": "b", "likes": 2, "dateAdded": "d"},
        "Review:3": {"text": "c", "likesCount": None, "likes": 5, "createdAt": None, "dateAdded": "d"},
    }
    _, found = extract(spark, page(apolloState=state))
    assert [(r["review_upvotes"], r["review_date"], r["review_url"]) for r in found] == [
        (1, "c", "/u"), (2, "d", ""), (None, None, ""),
    ]


INLINE = [
    {"text": "<i>kept</i>", "rating": 5, "user": {"id": "1", "name": "One"}},
    {"body": "b", "userId": "2", "userName": "Two", "user": {}},
    {"text": "nobody"},
    {"rating": 3, "userId": "4"},
    "not a review",
]


def test_state_reviews_are_accepted_with_text_or_rating(spark):
    source, found = extract(spark, page(initialState={"books": {"current": {"reviews": INLINE}}}))
    assert source == "state"
    assert [(r["review_text"], r["reviewer_id"], r["reviewer_name"]) for r in found] == [
        ("<i>kept</i>", "1", "One"), ("b", "2", "Two"), ("nobody", "unknown_2", ""), ("", "4", ""),
    ]


@pytest.mark.parametrize(
    "props, expected",
    [
        ({"initialData": {"book": {"reviews": INLINE}}}, "data"),
        (
            {
                "dehydratedState": {
                    "queries": [
                        {"state": {"data": {"x": 1}}},
                        7,
                        {"state": {"data": {"book": {"reviews": {"edges": [{"node": r} for r in INLINE]}}}}},
                    ]
                }
            },
            "queries",
        ),
    ],
)
def test_data_and_query_reviews_need_text_and_reviewer(spark, props, expected):
    source, found = extract(spark, page(**props))
    assert source == expected
    assert [(r["review_text"], r["reviewer_id"]) for r in found] == [("<i>kept</i>", "1"), ("b", "2")]


def test_fallback_order(spark):
    state = {"books": {"current": {"reviews": [{"text": "state"}]}}}
    data = {"book": {"reviews": [{"text": "data", "userId": "1"}]}}
    queries = {
        "queries": [{"state": {"data": {"book": {"reviews": {"edges": [{"node": {"text": "q", "userId": "1"}}]}}}}}]
    }
    apollo = {"Review:1": {"text": "apollo"}}

    def texts(**props):
        source, found = extract(spark, page(**props))
        return source, [r["review_text"] for r in found]

    parts = {"initialState": state, "initialData": data, "dehydratedState": queries}
    assert texts(apolloState=apollo, **parts) == ("entities", ["apollo"])
    assert texts(**parts) == ("state", ["state"])
    assert texts(initialData=data, dehydratedState=queries) == ("data", ["data"])
    # References that lead to nothing: state and data are not looked at, queries are.
    assert texts(apolloState={"Review:1": {}}, **parts) == ("queries", ["q"])


def test_pages_without_reviews_are_kept_apart_with_reason(spark):
    good = page(apolloState={"Review:1": {"text": "a"}})
    bad = [
        "<html>no state</html>",
        good.replace("}}}", "}"),
        good.replace('"props"', "'props'"),
        page(),
        '<script id="__NEXT_DATA__"></script>',
        '<script id="__NEXT_DATA__">[1]</script>',
        None,
        page(apolloState=[1], initialState={"books": {"current": {"reviews": [{"text": "x"}]}}}),
    ]
    done = with_reviews(page_table(spark, good, *bad))
    reasons = {r.page: r.reason for r in quarantine(done).collect()}
    assert reasons == {
        2: "no_state", 3: "bad_state", 4: "bad_state", 5: "no_reviews", 6: "no_state", 7: "bad_state", 8: "no_state",
        9: "bad_state",
    }
    assert [r.review_text for r in review_rows(done).collect()] == ["a"]


@pytest.mark.parametrize(
    "tag",
    ['<script id="__NEXT_DATA__">', "<SCRIPT type='x' ID = '__NEXT_DATA__' defer>", "<script id=__NEXT_DATA__>"],
)
def test_forms_of_the_script_tag(spark, tag):
    html = page(apolloState={"Review:1": {"text": "a"}})
    html = html.replace('<script id="__NEXT_DATA__" type="application/json">', "<script>var x;</script>" + tag)
    if tag.startswith("<SCRIPT"):
        html = html.replace("</script></body>", "</SCRIPT></body>")
    assert extract(spark, html)[0] == "entities"


def test_other_scripts_are_not_state(spark):
    html = page(apolloState={"Review:1": {"text": "a"}})
    assert extract(spark, html.replace("__NEXT_DATA__", "__NEXT_DATA__2"))[0] == "no_state"


def one_review(spark, html):
    row = with_reviews(page_table(spark, html)).first()
    return [r.review_text for r in row.reviews], row.review_source


GOOD = page(apolloState={"Review:1": {"text": "real", "rating": 1}})


@pytest.mark.parametrize("tail", ["}garbage", " }", "]", ", 1", ' {"a": 1}', "\n// note"])
def test_text_after_the_state_is_malformed(spark, tail):
    assert one_review(spark, GOOD.replace("\n</script>", tail + "</script>")) == ([], "bad_state")


def test_white_space_after_the_state_is_fine(spark):
    assert one_review(spark, GOOD.replace("\n</script>", " \n\t </script>")) == (["real"], "entities")


def test_last_of_repeated_keys_counts(spark):
    html = GOOD.replace('"text": "real"', '"text": "first", "rating": 5, "text": "last"').replace('"rating": 1', '"rating": 2')
    row = with_reviews(page_table(spark, html)).first().reviews[0]
    assert (row.review_text, row.review_rating) == ("last", 2.0)


OTHER = GOOD.replace("real", "hidden")


@pytest.mark.parametrize(
    "html, found",
    [
        (f"<!-- {OTHER} -->{GOOD}", ["real"]),
        (f"<!-- a --><!-- {OTHER} {OTHER} --> x --> {GOOD}{OTHER}", ["real"]),
        (f"<!-- a -->{GOOD}<!-- {OTHER} -->", ["real"]),
        (f"--> {GOOD}", ["real"]),
        (f"<!-- {OTHER}", []),
        (f"<!-- {OTHER} -->", []),
        (f"<!-- <!-- {OTHER} -->{GOOD}", ["real"]),
    ],
)
def test_states_in_comments_are_passed_over(spark, html, found):
    assert one_review(spark, html) == (found, "entities" if found else "no_state")


TAG, CLOSE = '<script id="__NEXT_DATA__">', "</script>"
PLACES = {
    "usual": ("<title>x</title>" + TAG + "{1}" + CLOSE + "<p>", "{1}"),
    "none": ("<p>__NEXT_DATA__</p>", None),
    "in other case first": ("<script id='__next_data__'>{1}</script>" + TAG + "{2}" + CLOSE, "{1}"),
    "mark in text first": ("<p>__NEXT_DATA__ > </p>" + TAG + "{1}" + CLOSE, "{1}"),
    "mark twice in a tag": ('<script id="__NEXT_DATA__" class="__NEXT_DATA__">{1}' + CLOSE, "{1}"),
    "tag not ended": ("<p>" + TAG[:-1], None),
    "hidden": ("<!-- " + TAG + "{1}" + CLOSE + " -->" + TAG + "{2}" + CLOSE, "{2}"),
    "comment closed before": ("<!-- x -->" + TAG + "{1}" + CLOSE, "{1}"),
    "other scripts behind": (TAG + "{1}" + CLOSE + "<script>2</script><script>3</script>", "{1}"),
    "other case of end": (TAG + "{1}</SCRIPT>" + "<script>2</script>", "{1}"),
    "no end": (TAG + "{é1}", "{é1}"),
    "nothing": (TAG + CLOSE, None),
    "null": (None, None),
}


def test_place_of_state(spark):
    """Both ways to find the state agree, and the one that searches the whole page is for odd pages only."""
    df = spark.createDataFrame([(k, html) for k, (html, _) in PLACES.items()], "k string, html string")
    found = df.select("k", pagestate.state_text(F.col("html")).alias("state"), pagestate.usual_head(F.col("html")).alias("usual"))
    rows = found.collect()
    assert {r.k: r.state for r in rows} == {k: state for k, (_, state) in PLACES.items()}
    odd = {"none", "in other case first", "mark in text first", "tag not ended", "hidden", "null"}
    assert {r.k for r in rows if not r.usual} == odd
