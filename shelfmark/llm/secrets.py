"""Secret scan in column expressions only.

Patterns give base spans of known kinds. Candidate strings of a character class are then scanned
with a sliding window whose Shannon entropy is kept by incremental counts: one character enters, one
leaves, and the sum of c * log2(c) over the counts changes by table values. Windows of high entropy
are merged to spans. The allow-list suppresses: a placeholder word cuts a candidate, and what is left on
either side is judged by itself; a candidate that is a word, a number or a UUID as a whole is left out;
and so are windows that a base span covers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.once import compute_once

# The kinds in their order, their patterns, the group whose length counts, and the least.
BASE = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]

# c * log2(c) is kept in whole numbers of this unit, so counts that come and go leave no rounding.
UNIT = 1 << 20


@dataclass(frozen=True)
class CharacterClass:
    """Candidates are runs of ``alphabet`` (a regular-expression class) of a window's length at least."""

    name: str
    alphabet: str
    window: int
    bits: float

    @property
    def pattern(self) -> str:
        return f"[{self.alphabet}]{{{self.window},}}"

    @property
    def table(self) -> list[int]:
        return [0] + [round(c * math.log2(c) * UNIT) for c in range(1, self.window + 2)]

    @property
    def most(self) -> int:
        """The largest sum of c * log2(c) that a window of enough entropy has."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * UNIT)


CLASSES = [
    CharacterClass("mixed_hex", "0-9A-Fa-f", 24, 3.0),
    CharacterClass("base64", "A-Za-z0-9+/_=-", 24, 3.9),
]
# Words in candidates that are no part of a secret.
PLACEHOLDER = r"(?i)(?:example|sample|placeholder|changeme|dummy|your[_-]?(?:key|token|secret)|x{6,}|0123456789|abcdefghij)"
# Candidates that are no secrets: words and paths without digits, bare numbers, UUIDs.
ALLOWED = [
    r"^[^0-9]*$",
    r"^[0-9]*$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
]

# Kinds are numbered in this order: base kinds, then the classes.
KINDS = [kind for kind, *_ in BASE] + [c.name for c in CLASSES]
SPANS = "array<struct<lo:int,kind:int,hi:int>>"


# Matches whose places are added up in one list.
TOGETHER = 500


def placed(i: int) -> Column:
    """Start and end of every match of pattern i, from the gaps before the matches and the matches.

    Lists grow by copying, so long ones are made of parts: places within a part first, then the
    parts' own places.
    """
    places = "array<struct<lo:int,hi:int>>"
    return F.expr(
        f"""if(size(found_{i}) = 0, cast(array() as {places}), flatten(aggregate(
        transform(
          transform(sequence(0, (size(found_{i}) - 1) div {TOGETHER}), n -> zip_with(
            slice(gaps_{i}, n * {TOGETHER} + 1, least({TOGETHER}, size(found_{i}) - n * {TOGETHER})),
            slice(found_{i}, n * {TOGETHER} + 1, {TOGETHER}), (g, f) -> struct(length(g) as g, length(f) as f))),
          part -> aggregate(part, struct(0 as upto, cast(array() as {places}) as spans),
            (s, x) -> struct(s.upto + x.g + x.f as upto,
              array_append(s.spans, struct(s.upto + x.g as lo, s.upto + x.g + x.f as hi)) as spans))),
        struct(0 as upto, cast(array() as array<{places}>) as parts),
        (s, part) -> struct(s.upto + part.upto as upto, array_append(s.parts,
          transform(part.spans, p -> struct(s.upto + p.lo as lo, s.upto + p.hi as hi))) as parts),
        s -> s.parts)))"""
    )


def hot_spans(i: int, c: CharacterClass) -> Column:
    """Merged windows of enough entropy in the candidates of class i.

    The state holds the window w, g = sum of c * log2(c) over the counts of its symbols, the place i
    behind it, the span that is growing and the spans that are done. A symbol a enters before the
    window's first symbol leaves: only the counts of these two change, so only they are taken. A step
    first judges the window before it. The work per symbol does not grow with the alphabet.
    """
    w = c.window
    gain = f"array({','.join(f'{b - a}L' for a, b in zip(c.table, c.table[1:]))})"
    count = lambda symbol: f"(length(s.w) - length(replace(s.w, {symbol}, '')))"
    hot = f"s.i >= {w} and s.g <= {c.most}L"
    apart = f"{hot} and s.lo >= 0 and s.i - {w} > s.hi"
    span = f"struct(c.lo + s.lo as lo, {i} as kind, c.lo + s.hi as hi)"
    judged = f"""if({hot}, if(s.lo >= 0 and s.i - {w} <= s.hi, s.lo, s.i - {w}), s.lo) as lo,
      if({hot}, s.i, s.hi) as hi, if({apart}, array_append(s.done, {span}), s.done) as done"""
    step = f"""struct(right(concat(s.w, a), {w}) as w,
      s.g + {gain}[{count("a")}] - if(s.i < {w}, 0L, {gain}[{count("left(s.w, 1)")} - if(a = left(s.w, 1), 0, 1)]) as g,
      s.i + 1 as i, {judged})"""
    start = f"struct('' as w, 0L as g, 0 as i, -1 as lo, -1 as hi, cast(array() as {SPANS}) as done)"
    last = f"aggregate(array(struct({judged})), cast(array() as {SPANS}), (t, s) -> if(s.lo < 0, s.done, array_append(s.done, {span})))"
    return F.expr(f"flatten(transform(candidates_{i}, c -> aggregate(split(c.text, ''), {start}, (s, a) -> {step}, s -> {last})))")


def with_secrets(docs: DataFrame, text: str = "text", allowed: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns of ``docs``), ``base`` and ``added``: spans (lo, kind, hi)
    in code points, end exclusive, in order; ``kind`` numbers ``KINDS``.

    Base spans are the leftmost matches of each kind that do not overlap, without those that are too
    short. Added spans are merged windows of high entropy; the allow-list suppresses only these. What
    is shorter than a window, 24 characters, is judged by the base patterns alone. Columns may have any names. A
    null text counts as empty and has no span. Very long texts with very many matches are added up
    in parts. Repeated rows get equal results; an empty table gives none.
    """
    patterns = [p for _, p, _, _ in BASE] + [c.pattern for c in CLASSES]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    scanned = docs.select(whole.alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    found = {f"found_{i}": F.regexp_extract_all("t", F.lit(p), F.lit(0)) for i, p in enumerate(patterns)}
    scanned = compute_once(scanned, **found)
    gaps = {f"gaps_{i}": F.when(F.size(f"found_{i}") > 0, F.split("t", p, -1)) for i, p in enumerate(patterns)}
    counted = {
        f"value_{i}": F.when(F.size(f"found_{i}") > 0, F.regexp_extract_all("t", F.lit(p), F.lit(group)))
        for i, (_, p, group, _) in enumerate(BASE)
    }
    scanned = compute_once(scanned, **gaps, **counted)
    base = [
        F.when(
            F.size(f"found_{i}") > 0,
            F.expr(
                f"""transform(filter(arrays_zip(places_{i}, value_{i}), x -> length(x.value_{i}) >= {least}),
                x -> struct(x.places_{i}.lo as lo, {i} as kind, x.places_{i}.hi as hi))"""
            ),
        ).otherwise(F.array().cast(SPANS))
        for i, (_, _, _, least) in enumerate(BASE)
    ]
    rules = ALLOWED if allowed is None else allowed
    candidates = {f"candidates_{i}": candidates_of(i, c, rules) for i, c in enumerate(CLASSES, len(BASE))}
    scanned = compute_once(scanned, **{f"places_{i}": placed(i) for i in range(len(patterns))})
    scanned = compute_once(scanned.drop("t"), base=F.array_sort(F.concat(*base)), **candidates)
    hot = F.concat(*[hot_spans(i, c) for i, c in enumerate(CLASSES, len(BASE))])
    scanned = compute_once(scanned.select("row", "base", *candidates), hot=hot)
    outside = F.expr("array_sort(filter(hot, h -> not exists(base, b -> b.lo <= h.lo and b.hi >= h.hi)))")
    return scanned.select("row", "base", outside.alias("added"))


def candidates_of(i: int, c: CharacterClass, rules: list[str]) -> Column:
    """Start and text of the matches of class i, cut at placeholder words, that no allow-list rule fits."""
    words = PLACEHOLDER.replace("'", "''")
    pieces = F.expr(
        f"""flatten(transform(zip_with(places_{i}, found_{i}, (p, f) -> struct(p.lo as lo, f as text)), x -> if(
        not x.text rlike r'{words}', array(x), aggregate(
          zip_with(split(x.text, r'{words}', -1), regexp_extract_all(x.text, r'{words}', 0),
            (part, word) -> struct(part as part, coalesce(length(word), 0) as skip)),
          struct(x.lo as upto, cast(array() as array<struct<lo:int,text:string>>) as done),
          (s, y) -> struct(s.upto + length(y.part) + y.skip as upto,
            array_append(s.done, struct(s.upto as lo, y.part as text)) as done),
          s -> s.done))))"""
    )
    return F.filter(pieces, lambda x: (F.char_length(x["text"]) >= c.window) & ~any_match(x["text"], rules))


def any_match(candidate: Column, rules: list[str]) -> Column:
    matched = F.lit(False)
    for rule in rules:
        matched = matched | candidate.rlike(rule)
    return matched


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["lo"].cast("string"), s["hi"].cast("string")))
    )
