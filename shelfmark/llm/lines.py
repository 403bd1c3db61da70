"""Line deduplication by a suffix array over line-ID sequences, built by distributed prefix doubling.

Lines are named by 128 bits of hash; blank lines do not count as lines. A suffix starts at a line and
goes on within its document. Ranks after the first h lines are refined to ranks after 2h lines: the
new rank is the old one plus the number of suffixes of the same old rank whose rank h lines further
on is smaller. Suffixes that share their rank form the interval of the suffix array whose longest
common prefix is at least h. Only those go on to the next round, since the others cannot be part of
a longer repeat; so rounds shrink, and end when no repeat is longer.

A later copy is a run that starts in an interval of enough lines and not at its first place. Ranks
come from counts of (rank, next rank) classes, which are aggregated before the shuffle, in sums over
ranges of the next rank, so a line that makes up a third of all lines fills no task by itself.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Later copies of this many consecutive lines are deleted, and of single lines of so many characters.
MIN_LINES = 2
LONG_LINE = 40
# Ranges of the second key over which class sizes are summed.
RANGES = 256
NO_ID = (1 << 63) - 1
DOC = ["dk", "d"]


def ranked(classes: DataFrame, key: list[str], part: Column) -> DataFrame:
    """Add ``rank``: r and the number of suffixes of the same r with a smaller key.

    ``part`` cuts the keys of an r into ordered ranges; sizes are summed within and over ranges.
    """
    classes = classes.withColumn("part", part)
    before = (Window.unboundedPreceding, -1)
    sums = classes.groupBy("r", "part").agg(F.sum("n").alias("s"))
    over = Window.partitionBy("r").orderBy("part").rowsBetween(*before)
    sums = sums.select("r", "part", F.coalesce(F.sum("s").over(over), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("r", "part").orderBy(*key).rowsBetween(*before)
    inner = classes.withColumn("within", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return inner.join(sums, ["r", "part"]).withColumn("rank", F.col("r") + F.col("earlier") + F.col("within"))


def repeated(rows: DataFrame, key: list[str], part: Column) -> DataFrame:
    """Rows whose class (r and key) has several members, with their new rank and the class's first place."""
    place = F.struct("d", "dk", "k", "i")
    classes = rows.groupBy("r", *key).agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    names = ranked(classes, key, part).select("r", *key, "rank", "first")
    kept = [c for c in rows.columns if c not in ("r", "first", *key)]
    return rows.drop("first").join(names, ["r", *key]).select(*kept, F.col("rank").alias("r"), "first")


def numbered_lines(keyed: DataFrame, long_line: int) -> DataFrame:
    """(dk, d, k, i, a, b, long): lines that are not blank, the k-th of their document at place i."""
    lines = F.transform(F.split("t", "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    lines = F.filter(lines, lambda z: z["x"].rlike(r"[^\x20\x09-\x0D]"))
    each = keyed.select("dk", "d", F.posexplode(lines).alias("k", "z"))
    x = F.col("z.x")
    return each.select(
        "dk", "d", "k", F.col("z.i").alias("i"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"),
        (F.length(x) >= long_line).alias("long"), F.lit(0).cast("bigint").alias("r"),
    )


def later_copies(keyed: DataFrame, min_lines: int, long_line: int) -> DataFrame:
    """Starts (dk, d, k, i, upto, h, from_d, from_i, cut) that have an earlier equal run of h lines.

    ``cut`` marks those that decide what is deleted: from line i to line ``upto``.
    """
    lines = numbered_lines(keyed, long_line)
    # The hashes' first twelve bits cut the order of line IDs into ranges.
    suffixes = repeated(lines, ["a", "b"], F.shiftright("a", 52).cast("bigint"))
    by_doc = Window.partitionBy(*DOC).orderBy("k")
    upto = F.max("i").over(by_doc.rangeBetween(min_lines - 1, min_lines - 1))
    suffixes = checkpointed(suffixes.withColumn("upto", upto))
    n = suffixes.count()
    width = F.lit(max(1, -(-n // RANGES)))

    def found(h: int) -> DataFrame:
        same = (F.col("first.dk") == F.col("dk")) & (F.col("first.d") == F.col("d"))
        # An earlier run of the same document must end before this one starts.
        earlier = F.when(same, F.col("first.k") + h <= F.col("k")).otherwise(F.lit(True))
        cut = F.col("long") if h == 1 < min_lines else F.lit(h == min_lines)
        return suffixes.filter(earlier).select(
            "dk", "d", "k", "i", (F.col("i") if h < min_lines else F.col("upto")).alias("upto"), F.lit(h).alias("h"),
            F.col("first.d").alias("from_d"), F.col("first.i").alias("from_i"), cut.alias("cut"),
        )

    levels, h = [found(1)], 1
    while n:
        # Double, but stop once at exactly min_lines: two overlapping runs of h lines make it up.
        ahead = h if 2 * h <= min_lines or h >= min_lines else min_lines - h
        following = F.max("r").over(by_doc.rangeBetween(ahead, ahead))
        pairs = suffixes.withColumn("next", following).filter("next is not null")
        suffixes = checkpointed(repeated(pairs, ["next"], F.floor(F.col("next") / width)))
        h += ahead
        n = suffixes.count()
        if n:
            levels.append(found(h))
    every = levels[0]
    for level in levels[1:]:
        every = every.union(level)
    return every


def without_repeated_lines(
    docs: DataFrame, min_lines: int = MIN_LINES, long_line: int = LONG_LINE, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``row`` (a struct of the columns of ``docs``), ``kept``, ``n_lines``, ``n_removed`` and ``runs``.

    A line is deleted if a run of ``min_lines`` lines, or a line of ``long_line`` characters, covers
    it that also stands earlier: in a document of a smaller id, or before it in the same document
    without overlap. Blank lines (white space only) are no lines; those inside a deleted run go with
    it, others stay. ``runs`` lists the deleted stretches: first line, last line (places in the
    text), and the earliest place, (document, line), of the longest doubled run from there.

    A null text stays null and has no lines. Null ids count as larger than all others. Rows alike in
    id and text are one document, treated alike; rows of one id with other texts are ordered by a
    hash of the text. An empty table gives none. Columns may have any names.
    """
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{id_column}`").cast("bigint"), F.lit(NO_ID)).alias("d"),
        F.xxhash64(F.col(f"`{id_column}`").cast("bigint"), F.col(f"`{text}`")).alias("dk"),
        F.col(f"`{text}`").cast("string").alias("t"),
    )
    starts = later_copies(keyed.select("dk", "d", "t"), min_lines, long_line)
    entry = F.struct("i", "h", "upto", "cut", "from_d", "from_i")
    per_doc = starts.groupBy(*DOC).agg(F.collect_list(entry).alias("starts"), F.max("cut").alias("any_cut"))
    # The text is shuffled once, inside the row.
    judged = keyed.drop("t").join(per_doc.filter("any_cut").select(*DOC, "starts"), DOC, "left")
    judged = judged.select("row", F.col("row").getField(text).cast("string").alias("t"), "starts")
    added = "kept string, n_lines bigint, n_removed bigint, runs array<struct<lo:int,hi:int,from_doc:bigint,from_line:int>>"
    schema = T.StructType([judged.schema["row"], *T._parse_datatype_string(added).fields])

    def run(batches):
        span = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("from_doc", pa.int64()), ("from_line", pa.int32())]))
        kinds = [pa.string(), pa.int64(), pa.int64(), span]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = [cleaned(t, s) for t, s in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                columns = [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["row", "kept", "n_lines", "n_removed", "runs"])

    return judged.mapInArrow(run, schema)


BLANK = " \t\n\x0b\x0c\r"


def cleaned(text: str | None, starts: list[dict] | None) -> tuple[str | None, int, int, list[dict]]:
    """The text without its later copies, its lines, the deleted lines, and the deleted stretches."""
    if text is None:
        return None, 0, 0, []
    lines = text.split("\n")
    n_lines = sum(1 for x in lines if x.strip(BLANK))
    if not starts:
        return text, n_lines, 0, []
    runs: list[dict] = []
    for s in sorted((s for s in starts if s["cut"]), key=lambda s: (s["i"], s["upto"])):
        if runs and s["i"] <= runs[-1]["hi"] + 1:
            runs[-1]["hi"] = max(runs[-1]["hi"], s["upto"])
        else:
            runs.append({"lo": s["i"], "hi": s["upto"]})
    longest: dict[int, dict] = {}
    for s in starts:
        if s["i"] not in longest or s["h"] > longest[s["i"]]["h"]:
            longest[s["i"]] = s
    kept, upto, removed = [], 0, 0
    for r in runs:
        source = longest[r["lo"]]
        r |= {"from_doc": None if source["from_d"] == NO_ID else source["from_d"], "from_line": source["from_i"]}
        kept += lines[upto : r["lo"]]
        removed += sum(1 for x in lines[r["lo"] : r["hi"] + 1] if x.strip(BLANK))
        upto = r["hi"] + 1
    return "\n".join(kept + lines[upto:]), n_lines, removed, runs
