"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.pagecheck import quarantine
from shelfmark.site import DEFAULT_SITE, Site
from shelfmark.sources.tables import empty_reviews

# What is kept in parquet is mostly text, of which this codec leaves about two thirds of what the default leaves.
PARQUET = {"compression": "zstd"}
# CSV takes as many bytes as its texts have. One task reads a packed file, so a file has so many rows at most.
PACKED_CSV = {"compression": "gzip", "maxRecordsPerFile": "20000"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", order: list[str] | None = None, packed: bool = False) -> None:
    """CSV with a header. CSV has no arrays, so they are written as JSON; null is an empty field.

    Rows are sorted only if ``order`` asks for it: files then follow each other in that order.
    With ``packed`` the files are compressed; readers unpack them. Their names follow each other as long as
    a task writes 1,000 of them at most, which is 20 million rows.
    """
    cols = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ]
    options = {"header": "true", "escape": '"', "emptyValue": "", "nullValue": "", **(PACKED_CSV if packed else {})}
    ordered = df.orderBy(*order) if order else df
    ordered.select(*cols).write.mode(mode).options(**options).csv(path)


def write_reviews(reviews: DataFrame, path: str, copies: list[str] | None = None, packed: bool = False) -> DataFrame:
    """Write the table once as parquet, then CSV copies from what was written.

    The copies read the written files, so the job is not run again for them, nor after the loss of
    an executor. Returns the written table.
    """
    reviews.write.mode("overwrite").options(**PARQUET).parquet(path)
    written = reviews.sparkSession.read.schema(reviews.schema).parquet(path)
    for copy in copies or []:
        write_csv(written, copy, packed=packed)
    return written


def stored_below(folder: str):
    """A function that writes a table below the folder, under a name, and reads it again."""

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.options(**PARQUET).parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    return stored


def write_empty_reviews(spark, path: str, site: Site = DEFAULT_SITE) -> None:
    """A header without rows, for a run that found nothing.

    Spark writes no header for a table without partitions, hence the single empty one.
    """
    write_csv(empty_reviews(spark, site).coalesce(1), path)


def write_quarantine(pages_with_reviews: DataFrame, path: str) -> None:
    """Pages without reviews, by reason."""
    quarantine(pages_with_reviews).write.mode("overwrite").options(**PARQUET).partitionBy("reason").parquet(path)
