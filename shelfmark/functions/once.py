"""Results that are computed exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions Catalyst will not copy into later filters.

    A filter on a projected column is normally pushed below the projection with the column's
    expression in place of its name, and ``explode`` infers such a filter. For a chain of parses
    that means parsing again, several times over. A filter on the output of a generator is not
    pushed, so the values pass through a one-element ``explode``. Filters on other columns still go
    down to the scan.
    """
    rest = [c for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*rest, F.explode_outer(F.array(row)).alias("_once")).select(*rest, "_once.*")
