"""From documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept and is written and read again, so a lost executor costs
one stage's work at most. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm import decontaminate, lines, packing, simhash, toxicity
from shelfmark.llm.common import stored, table, unpacked
from shelfmark.llm.queries import THRESHOLD, remainder


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold.

    Null and empty texts have a score too. Repeated rows are judged alike, null ids are not learned from,
    an empty table stays empty, and columns may have any names.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=remainder("doc_id", 4) != 2)
    return unpacked(toxicity.with_toxicity(docs, model).filter(F.col("score") < THRESHOLD))


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later copies of repeated line runs; ``n_chars`` follows the text.

    A null text stays null, an emptied one stays in place. Repeated rows are treated alike, null ids come
    after all others, an empty table stays empty, and columns may have any names.
    """
    found = lines.without_repeated_lines(docs)
    changed = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return found.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row, that of the smallest id.

    Ids may be repeated or null: a row is chosen by its id and text, so a group never loses all its
    rows to another group that shares an id. Rows without an id come after all others of their group.
    Of rows alike in id and text the one with the least hash stays. Columns may have any names.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("digest"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select("doc_id", "text", key.alias("key"), F.struct(F.xxhash64(row), row.alias("row")).alias("ranked"))
    marked = simhash.near_duplicates(keyed.select("doc_id", "text", "key"), shingle=3, max_bits=3, keep=("key",))
    # Narrow rows, aggregated before the shuffle however large a group is.
    chosen = marked.groupBy("root").agg(F.min("key").alias("key")).select("key").distinct()
    digest, none, number = F.col("key.digest"), F.col("key.none"), F.coalesce(F.col("key.id"), F.lit(0))
    named = [digest.alias("digest"), none.alias("none"), number.alias("id")]
    kept = keyed.select(*named, "ranked").join(chosen.select(*named), ["digest", "none", "id"], "left_semi")
    # Rows that are alike lie in one partition already.
    one = F.row_number().over(Window.partitionBy("digest", "none", "id").orderBy("ranked.col1"))
    kept = kept.withColumn("n", one).filter("n = 1")
    return kept.select(*[F.col("ranked.row").getField(c).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item.

    Null and empty texts hold none and stay, as do repeated rows without one; an empty table stays empty,
    and columns may have any names.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences.

    A null or empty text has one piece, the id that ends a document. Repeated rows and null ids are packed
    like others; an empty table gives no piece. Only ``doc_id`` and ``text`` are read.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", delete_repeated_lines),
    ("simhash_near_dedup", keep_one_of_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

# Scores of a trained model, 64-bit hashes of shingles and tokens have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
