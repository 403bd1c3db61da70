"""Column helpers for loosely typed JSON held as map<string,string>.

A JSON object parsed to map<string,string> keeps the key order, keeps nested values as JSON text
and keeps "key present but null" apart from "key absent", which VARIANT and struct schemas do not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON proper has no single-quoted strings, so a page that uses them is malformed.
STRICT = {"allowSingleQuotes": "false"}

# JSON scalars and containers that count as "nothing there".
FALSY = ["", "0", "-0", "0.0", "-0.0", "false", "{}", "[]"]


def as_map(text: Column) -> Column:
    """Parse a JSON object; anything else gives null. Of a repeated key the last value counts."""
    # Bound in a list of one, so that the parse is not copied to where its result is used.
    return F.get(F.transform(F.array(F.from_json(text, "map<string,string>", STRICT)), last_wins), F.lit(0))


def parse(text: Column, schema: str) -> Column:
    return F.from_json(text, schema, STRICT)


def last_wins(entries: Column) -> Column:
    """Resolve repeated keys as JSON readers commonly do: first position, last value."""
    keys = F.array_distinct(F.map_keys(entries))

    def last_value(key: Column) -> Column:
        same = F.filter(F.map_entries(entries), lambda e: e["key"] == key)
        return F.try_element_at(same, F.lit(-1))["value"]

    repeated = F.size(keys) < F.size(F.map_keys(entries))
    return F.when(repeated, F.map_from_arrays(keys, F.transform(keys, last_value))).otherwise(entries)


def pick(entries: Column, names: list[str], default: str | Column | None = None) -> Column:
    """Value of the first *present* key. A present null is returned, not skipped."""
    fallback = default if isinstance(default, Column) else F.lit(default).cast("string")

    def prefer(rest: Column, name: str) -> Column:
        # Looked up first: the test whether a key is there reads all keys, and only nulls need it.
        null = F.lit(None).cast("string")
        return F.coalesce(entries[name], F.when(F.map_contains_key(entries, name), null).otherwise(rest))

    return reduce(prefer, reversed(names), fallback)


def truthy(value: Column) -> Column:
    """Truth of a JSON value held as text: null, empty, zero, false and empty containers are false."""
    return F.coalesce(~value.isin(FALSY), F.lit(False))


def filled(value: Column) -> Column:
    """Truth of a string: neither null nor empty."""
    return F.coalesce(value != "", F.lit(False))


def reference(value: Column) -> Column:
    """The target key if the value is a reference object, else null."""
    return F.when(F.startswith(F.ltrim(value), F.lit("{")), F.get_json_object(value, "$.__ref"))


def or_empty(items: Column, element: str) -> Column:
    return F.coalesce(items, F.array().cast(f"array<{element}>"))
