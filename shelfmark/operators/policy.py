"""URL paths against crawl rules (robots.txt)."""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: crawlers have to read 500 KiB of a file of rules.
MOST_RULES_TEXT = 500 * 1024

RULES = "agent string, kind string, pattern string"


def parse_rules(text: str) -> list[tuple[str, str, str]]:
    """Rules of one robots.txt as (agent, allow|disallow, pattern), one per agent of a group."""
    rules, agents, in_rules = [], [], False
    for line in text.splitlines():
        name, colon, value = line.partition("#")[0].partition(":")
        name, value = name.strip().lower(), value.strip()
        if not colon:
            continue
        if name == "user-agent":
            agents = [value.lower()] if in_rules else [*agents, value.lower()]
            in_rules = False
        elif name in ("allow", "disallow"):
            in_rules = True
            rules += [(agent, name, value) for agent in agents or ["*"]]
    return rules


def rule_table(spark: SparkSession, text: str) -> DataFrame:
    return spark.createDataFrame(parse_rules(text), RULES)


def _regex(pattern: str) -> str:
    body, anchored = (pattern[:-1], "$") if pattern.endswith("$") else (pattern, "")
    return "^" + ".*".join(re.escape(part) for part in body.split("*")) + anchored


def _applicable(rules: list[tuple[str, str, str]], mode: str, agent: str) -> list[tuple[str, str]]:
    """The rules the mode looks at: all prohibitions, or the agent's group, or the ``*`` group.

    An empty pattern says nothing in either mode.
    """
    if mode == "any_agent":
        return sorted({("disallow", p) for _, kind, p in rules if kind == "disallow" and p})
    if mode != "agent":
        raise ValueError(f"unknown mode {mode!r}")
    names = {a for a, _, _ in rules}
    group = agent.lower() if agent.lower() in names else "*"
    return sorted({(kind, p) for a, kind, p in rules if a == group and p})


def with_policy(
    urls: DataFrame,
    path: str,
    rules: list[tuple[str, str, str]],
    mode: str = "any_agent",
    agent: str = "*",
) -> DataFrame:
    """Add ``allowed`` to a table with a column of URL paths.

    ``any_agent``: not allowed if any prohibition of any agent is a literal prefix of the path.
    ``agent``: rules of the agent's group only, with wildcards; the longest pattern wins, permission
    beats prohibition at equal length. A null path is allowed.

    One expression per row, no exchange: from the longest patterns to the shortest, literal ones are
    looked up among those of their length, and those with wildcards tested behind their literal head.
    The rules are part of the plan, so their size is checked: a file of rules that is larger than
    crawlers have to read is refused.
    """
    used = _applicable(rules, mode, agent)
    if sum(len(p) for _, p in used) > MOST_RULES_TEXT:
        raise ValueError(f"crawl rules of more than {MOST_RULES_TEXT} characters")
    whole = F.col(path)
    allowed = F.when(whole.isNull(), True)
    for length in sorted({len(p) for _, p in used}, reverse=True):
        for kind in ("allow", "disallow"):
            patterns = [p for k, p in used if k == kind and len(p) == length]
            plain = [p for p in patterns if mode == "any_agent" or not re.search(r"\*|\$\Z", p)]
            tests = [F.left(whole, F.lit(length)).isin(plain)] if plain else []
            for p in patterns:
                if p not in plain:
                    head = re.split(r"\*|\$\Z", p)[0]
                    tests.append(whole.startswith(head) & F.regexp_like(whole, F.lit(_regex(p))))
            if tests:
                allowed = allowed.when(functools.reduce(operator.or_, tests), kind == "allow")
    return urls.withColumn("allowed", allowed.otherwise(True))


def with_policy_joined(
    urls: DataFrame,
    path: str,
    rules: list[tuple[str, str, str]],
    mode: str = "any_agent",
    agent: str = "*",
) -> DataFrame:
    """What ``with_policy`` adds, by an equi-join of path prefixes with the literal heads of the rules.

    The rules are a table, of any length. A path is cut only at the lengths that heads have, and what
    the head lets through gets the full test. Distinct paths are tested once, however often they occur.
    """
    rows = []
    for kind, pattern in _applicable(rules, mode, agent):
        literal = mode == "any_agent"
        head = pattern if literal else re.split(r"\*|\$\Z", pattern)[0]
        rows.append((head, "^" + re.escape(pattern) if literal else _regex(pattern), len(pattern), kind == "allow"))
    heads = urls.sparkSession.createDataFrame(rows, "head string, regex string, length int, allow boolean")
    lengths = F.array(*[F.lit(n) for n in sorted({len(r[0]) for r in rows})]).cast("array<int>")
    paths = urls.select(F.col(path).alias("_path")).filter("_path IS NOT NULL").distinct()
    cut = paths.withColumn("n", F.explode(F.filter(lengths, lambda n: n <= F.char_length("_path"))))
    hits = cut.withColumn("head", F.left("_path", "n")).join(heads, "head").filter(F.regexp_like("_path", "regex"))
    best = hits.groupBy("_path").agg(F.max(F.struct("length", "allow")).alias("_best"))
    joined = urls.join(best, F.col(path) == F.col("_path"), "left")
    return joined.select(*urls.columns, F.coalesce("_best.allow", F.lit(True)).alias("allowed"))
