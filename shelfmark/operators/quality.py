"""Data-quality rules and the suites that use them.

A suite only picks rules and severities. All row rules of a suite are counted in one aggregation.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import is_iso_timestamp, is_real_timestamp
from shelfmark.schema import RAW_RATING, required_columns
from shelfmark.site import DEFAULT_SITE, Site

FAIL, WARN, REPORT = "fail", "warn", "report"

# Marks of generated test data.
MOCK_TEXT = "Mock review"
MOCK_USER = "mock_user"


def _null_safe(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


@dataclass(frozen=True)
class Rule:
    """A condition on one column that a good row does not meet.

    ``broken`` takes the value and the value as written, which differ in a rating read from text.
    """

    column: str
    condition: Callable[..., Column]
    as_written: bool = False

    def broken(self, df: DataFrame) -> Column:
        if not self.as_written:
            return self.condition(F.col(self.column))
        return self.condition(F.col(self.column), self.written(df))

    def written(self, df: DataFrame) -> Column:
        raw = self.column == "review_rating" and RAW_RATING in df.columns
        return F.col(RAW_RATING if raw else self.column)


RULES = {
    "mock_text_inside": Rule("review_text", lambda c: _null_safe(F.contains(c, F.lit(MOCK_TEXT)))),
    "mock_text_start": Rule("review_text", lambda c: _null_safe(F.startswith(c, F.lit(MOCK_TEXT)))),
    "mock_user": Rule("reviewer_id", lambda c: _null_safe(F.startswith(c, F.lit(MOCK_USER)))),
    "null_book_id": Rule("book_id", lambda c: c.isNull()),
    "null_review_text": Rule("review_text", lambda c: c.isNull()),
    "null_review_rating": Rule("review_rating", lambda c, raw: raw.isNull(), as_written=True),
    "empty_text": Rule("review_text", lambda c: c.isNull() | (c == "")),
    # Null counts as invalid here, and 4.5 is valid ...
    "rating_range": Rule("review_rating", lambda c: ~_null_safe(c.between(1, 5))),
    # ... while here null is left out, and 4.5 is invalid, as is a word.
    "rating_whole": Rule(
        "review_rating", lambda c, raw: raw.isNotNull() & ~_null_safe(c.isin(1, 2, 3, 4, 5)), as_written=True
    ),
    "date_form": Rule("review_date", lambda c: ~is_iso_timestamp(c)),
    "date_real": Rule("review_date", lambda c: ~is_real_timestamp(c)),
}
NULL_RULES = ["null_book_id", "null_review_text", "null_review_rating"]


@dataclass(frozen=True)
class Suite:
    """``empty``: severity of a table without rows, or None if it passes without further checks.

    ``extra``: severity of columns beyond the required ones, or None if they are not looked at.
    """

    rules: dict[str, str]
    columns: str
    empty: str | None = FAIL
    with_reviewer_name: bool = False
    few_books: str | None = None
    extra: str | None = None


def _all(names: list[str], severity: str) -> dict[str, str]:
    return dict.fromkeys(names, severity)


SUITES = {
    "format": Suite(_all([*NULL_RULES, "rating_range", "date_form"], REPORT), REPORT, REPORT, extra=REPORT),
    "sample": Suite(_all([*NULL_RULES, "rating_range", "date_form"], FAIL), FAIL, REPORT, extra=REPORT),
    "subset": Suite(
        _all(["mock_text_start", "mock_user", *NULL_RULES, "rating_range", "date_form"], FAIL), FAIL, None
    ),
    "release": Suite(
        {"mock_text_inside": FAIL, **_all([*NULL_RULES, "empty_text", "rating_whole"], WARN)},
        FAIL,
        FAIL,
        with_reviewer_name=True,
        few_books=WARN,
    ),
    "report": Suite(
        _all(["mock_text_inside", *NULL_RULES, "rating_whole"], REPORT), REPORT, REPORT, with_reviewer_name=True
    ),
    "contract": Suite(_all([*NULL_RULES, "rating_range", "date_form"], FAIL), FAIL, REPORT),
}


def missing_and_extra(df: DataFrame, required: list[str]) -> tuple[list[str], list[str]]:
    extra = [c for c in df.columns if c not in required and c != RAW_RATING]
    return [c for c in required if c not in df.columns], extra


def _usable(df: DataFrame, suite: Suite) -> dict[str, str]:
    """Rules whose column exists; a missing column is already reported as such."""
    return {name: s for name, s in suite.rules.items() if RULES[name].column in df.columns}


def _counts(df: DataFrame, suite: Suite) -> dict[str, Column]:
    """What a suite counts, as aggregates by name."""
    counts = {name: F.count_if(RULES[name].broken(df)) for name in _usable(df, suite)}
    counts["n_rows"] = F.count("*")
    if suite.few_books and "book_id" in df.columns:
        # Fewer than two books means that smallest and largest id agree: no distinct needed.
        counts |= {"low": F.min("book_id"), "high": F.max("book_id")}
    return counts


def _rows(df: DataFrame, suite: Suite, site: Site) -> list[Column]:
    """The rules of a suite, from one row of its counts."""
    rules = _usable(df, suite)
    missing, extra = missing_and_extra(df, required_columns(site.url_column, suite.with_reviewer_name))

    def row(name: str, severity: str, violations: Column) -> Column:
        return F.struct(
            F.lit(name).alias("rule"), F.lit(severity).alias("severity"), violations.cast("bigint").alias("violations")
        )

    n_missing = F.lit(len(missing))
    if suite.empty is None:
        n_missing = F.when(F.col("n_rows") == 0, 0).otherwise(n_missing)
    rows = [row("required_columns", suite.columns, n_missing)]
    if suite.extra is not None:
        rows.append(row("extra_columns", suite.extra, F.lit(len(extra))))
    if suite.empty is not None:
        rows.append(row("not_empty", suite.empty, (F.col("n_rows") == 0).cast("int")))
    rows += [row(name, severity, F.col(name)) for name, severity in rules.items()]
    if suite.few_books and "book_id" in df.columns:
        few = F.col("low").isNull() | (F.col("low") == F.col("high"))
        rows.append(row("few_books", suite.few_books, few.cast("int")))
    return rows


def _report(counted: DataFrame, df: DataFrame, suite: Suite, site: Site) -> DataFrame:
    rows = _rows(df, suite, site)
    return counted.select(F.inline(F.array(*rows))).withColumn("passed", F.col("violations") == 0)


def run_suite(df: DataFrame, suite_name: str, site: Site = DEFAULT_SITE) -> DataFrame:
    """One row per rule: ``rule, severity, violations, passed``. One pass, one global aggregation."""
    return run_suites(df, [suite_name], site).drop("suite")


def run_suites(df: DataFrame, suite_names: list[str], site: Site = DEFAULT_SITE) -> DataFrame:
    """The reports of several suites below each other, told apart by ``suite``. One pass for all of them.

    Suites that count the same thing count it once.
    """
    by_name = {name: SUITES[name] for name in suite_names}
    # A rule is the same in every suite, only its severity differs.
    names, counts = set(), []
    for suite in by_name.values():
        new = [(n, c) for n, c in _counts(df, suite).items() if n not in names]
        names.update(n for n, _ in new)
        counts += [c.alias(n) for n, c in new]
    rows = [F.struct(r.alias("r"), F.lit(name).alias("suite")) for name, suite in by_name.items() for r in _rows(df, suite, site)]
    reports = df.agg(*counts).select(F.inline(F.array(*rows)))
    return reports.select("r.*", (F.col("r.violations") == 0).alias("passed"), "suite")


def watched(df: DataFrame, suite_name: str, site: Site = DEFAULT_SITE) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The table, to be written, and a function that gives the suite's report once it has been.

    The counts are taken from the rows as they pass on to the writer, so the verdict on what was
    written needs no second reading.
    """
    suite = SUITES[suite_name]
    counts = [count.alias(name) for name, count in _counts(df, suite).items()]
    seen = Observation()

    def report() -> DataFrame:
        spark = df.sparkSession
        types = {name: "string" if name in ("low", "high") else "bigint" for name in seen.get}
        row = spark.createDataFrame([tuple(seen.get.values())], ", ".join(f"{n} {t}" for n, t in types.items()))
        return _report(row, df, suite, site)

    return df.observe(seen, *counts), report


def suite_passed(report: DataFrame) -> bool:
    """Verdict over a suite's report, which has a handful of rows."""
    return report.filter((F.col("severity") == FAIL) & ~F.col("passed")).isEmpty()


def broken_rows(df: DataFrame, suite_name: str) -> DataFrame:
    """One row per row and broken rule, with the offending value as text, in one pass."""
    rules = _usable(df, SUITES[suite_name])
    checks = [
        F.struct(
            F.lit(name).alias("rule"),
            RULES[name].written(df).cast("string").alias("value"),
            RULES[name].broken(df).alias("broken"),
        )
        for name in rules
    ]
    return df.withColumn("_c", F.explode(F.filter(F.array(*checks), lambda c: c["broken"]))).select(
        *df.columns, "_c.rule", "_c.value"
    )


def first_broken(df: DataFrame, suite_name: str, order: list[str], n: int = 5) -> DataFrame:
    """The first n offending values per rule.

    The rank filter becomes a per-partition group limit, so at most n rows per rule and partition
    are shuffled even if every row breaks the same rule.
    """
    by_rule = Window.partitionBy("rule").orderBy(*order)
    ranked = broken_rows(df, suite_name).withColumn("n", F.row_number().over(by_rule))
    return ranked.filter(F.col("n") <= n).select("rule", "n", "value")
