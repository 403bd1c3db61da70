import pytest

from shelfmark.operators.policy import parse_rules, rule_table, with_policy, with_policy_joined

TEXT = """# a comment
User-agent: spider
Disallow: /

User-agent: one
User-agent: two
Allow: /user/year
Disallow: /user  # trailing

User-agent: *
Allow: /work/editions
Disallow: /search
Disallow: /work
Disallow: /*filters
Disallow: /file.txt$
Disallow:

Sitemap: https://books.example.org/map.xml
"""
PATHS = ["/search", "/book/show/", "/work/editions", "/work/quotes", "/a/filters?x", "/file.txt", "/file.txt2", "/"]


@pytest.fixture(scope="module")
def urls(spark):
    return spark.createDataFrame([(p,) for p in PATHS * 2], "path string")


def allowed(df):
    rows = df.collect()
    assert len(rows) == 2 * len(PATHS)
    return {r.path for r in rows if r.allowed}


def test_parse(spark):
    rules = parse_rules(TEXT)
    assert ("spider", "disallow", "/") in rules
    assert [r for r in rules if r[0] in ("one", "two")] == [
        ("one", "allow", "/user/year"), ("two", "allow", "/user/year"),
        ("one", "disallow", "/user"), ("two", "disallow", "/user"),
    ]
    assert rule_table(spark, TEXT).count() == len(rules) == 11


def test_any_agent_takes_every_prohibition_literally(urls):
    rules = parse_rules(TEXT)
    assert allowed(with_policy(urls, "path", rules)) == set()
    some = [r for r in rules if r[2] not in ("/", "")]
    assert allowed(with_policy(urls, "path", some)) == {
        "/book/show/", "/a/filters?x", "/file.txt", "/file.txt2", "/",
    }


def test_agent_group_longest_match_and_wildcards(urls):
    rules = parse_rules(TEXT)

    def of(agent):
        return allowed(with_policy(urls, "path", rules, "agent", agent))

    assert of("*") == of("somebody") == {"/book/show/", "/work/editions", "/file.txt2", "/"}
    assert of("Spider") == set()
    assert of("two") == set(PATHS)


def test_empty_prohibition_says_nothing(urls):
    assert allowed(with_policy(urls, "path", [("a", "disallow", "")], "any_agent")) == set(PATHS)
    assert allowed(with_policy(urls, "path", [("a", "disallow", ""), ("b", "disallow", "/w")], "any_agent")) == {
        p for p in PATHS if not p.startswith("/w")
    }


def test_columns_keep_their_order(spark):
    table = spark.createDataFrame([(1, "/search", "x"), (2, None, "y")], "no int, path string, tail string")
    for mode in ("any_agent", "agent"):
        got = with_policy(table, "path", parse_rules(TEXT), mode)
        assert got.columns == ["no", "path", "tail", "allowed"]
        assert {r.no: r.allowed for r in got.collect()} == {1: False, 2: True}


def test_no_rules_allow_all(urls):
    assert allowed(with_policy(urls, "path", [], "agent")) == set(PATHS)
    with pytest.raises(ValueError):
        with_policy(urls, "path", [], "other")


def test_rules_are_one_expression_and_bounded(urls):
    rules = parse_rules(TEXT)
    plan = with_policy(urls, "path", rules, "agent")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    many = [("*", "disallow", f"/x{i}") for i in range(3000)]
    assert allowed(with_policy(urls, "path", [*many, ("*", "allow", "/x")], "agent")) == set(PATHS)
    with pytest.raises(ValueError):
        with_policy(urls, "path", [("*", "disallow", "/" + "x" * 600_000)], "agent")


def test_joined_rules_say_the_same(spark, urls):
    rules = parse_rules(TEXT)
    for mode, agent in (("any_agent", "*"), ("agent", "*"), ("agent", "Spider"), ("agent", "two")):
        assert allowed(with_policy_joined(urls, "path", rules, mode, agent)) == allowed(with_policy(urls, "path", rules, mode, agent))
    assert allowed(with_policy_joined(urls, "path", [], "agent")) == set(PATHS)
    table = spark.createDataFrame([(1, "/search", "x"), (2, None, "y")], "no int, path string, tail string")
    got = with_policy_joined(table, "path", rules, "agent")
    assert got.columns == ["no", "path", "tail", "allowed"]
    assert {r.no: r.allowed for r in got.collect()} == {1: False, 2: True}


def test_joined_rules_go_beyond_the_bound_of_an_expression(urls):
    many = [("*", "disallow", "/" + "x" * 600_000), ("*", "disallow", "/work"), ("*", "allow", "/work/*tions$")]
    assert allowed(with_policy_joined(urls, "path", many, "agent")) == set(PATHS) - {"/work/quotes"}


def test_query_of_joined_rules_uses_the_whole_group():
    """Wildcards, lengths and permissions of the common group, not two literal prohibitions of a named one."""
    from shelfmark.plans.oracle import ORACLE

    assert ORACLE["url_policy_joined"] == ORACLE["url_policy_agent"]
