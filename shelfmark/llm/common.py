"""What the operators share: tables, work folders, row-local Arrow passes, connected components."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.session import work_folder

# UDF code travels with the plan, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that are turned into Python objects at a time. Spark bounds Arrow batches by bytes.
SLICE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the shared checkpoint folder.

    The cluster's folder is used as it is set; only where none is set, as in tests, a folder of the
    session is made.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_folder(spark, "checkpoints"))
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh table in the shared folder and read it again."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_text_columns(
    docs: DataFrame,
    make: Callable[[], Callable[[list[bytes | None]], list[pa.Array]]],
    fields: str,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """One pass over the texts, without a shuffle: ``row`` (a struct of the columns to keep, all by
    default) and the ``fields`` that the function returned by ``make`` computes from UTF-8 texts.

    ``make`` runs once per task. The kept columns sit in a struct, so no name can clash.
    """
    keep = docs.columns if keep is None else keep
    inner = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    packed = docs.select(inner.alias("row"), F.col(f"`{text}`").cast("string").cast("binary").alias("utf8"))
    added = T._parse_datatype_string(fields)
    schema = T.StructType([packed.schema["row"], *added.fields])
    names, types = schema.names, [T_to_arrow(f.dataType) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                columns = work(part.column(1).to_pylist())
                columns = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    return packed.mapInArrow(run, schema)


def T_to_arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def unpacked(df: DataFrame, *more: Column) -> DataFrame:
    """The kept columns of ``with_text_columns`` as they were, and ``more``."""
    names = df.schema["row"].dataType.names
    return df.select(*[F.col("row").getField(n).alias(n) for n in names], *more)


def first_of_each(rows: DataFrame, keys: list[str], order: list[str], n: int, salts: int = 64) -> DataFrame:
    """The first ``n`` rows of each key, and their number ``r``.

    A key's rows are limited in parts first, so a key with a large share of all rows is spread.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(salts))
    some = rows.withColumn("part", part).withColumn("r", F.row_number().over(Window.partitionBy(*keys, "part").orderBy(*order)))
    some = some.filter(F.col("r") <= n).drop("part")
    return some.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("r") <= n)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of links (a, b): a row (node, root) per linked node, root the least node.

    Alternating large-star and small-star steps: every node points to the least node that it or a
    neighbour knows. Minima are aggregated before the shuffle, and the joins are inner equi-joins
    that AQE can split when a hub has a large share of the links. Each round is checkpointed.
    """

    def ordered(df: DataFrame, a: Column, b: Column) -> DataFrame:
        return df.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v")

    a, b, u, v = F.col("a"), F.col("b"), F.col("u"), F.col("v")
    stars = checkpointed(ordered(links, a, b).distinct())
    seen = None
    for _ in range(rounds):
        # Large star: all larger neighbours of u join the least node around u.
        both = stars.union(stars.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u")
        large = ordered(large, v, F.col("m")).distinct()
        # Small star: all smaller neighbours of u, and u, join the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m")
        stars = checkpointed(ordered(small, v, F.col("m")).union(least.select("u", F.col("m").alias("v"))).distinct())
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return stars.select(u.alias("node"), v.alias("root")).union(
        stars.select(v.alias("node"), v.alias("root")).distinct()
    )
