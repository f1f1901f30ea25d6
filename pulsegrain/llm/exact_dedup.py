"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Each level keeps only rows whose key still repeats. The surviving keys of a
level travel to the next scan as a bitmap of fixed size, so the wide text is
never shuffled to find out whether it must be read. A bitmap may let a unique
row through, never hold a repeated one back; the full hash decides.

Defined cases: null text counts as empty, and empty texts equal each other;
texts are equal when they agree after lower-casing A-Z only. The largest id of
a group stays; null ids are smaller than any other, and a row that repeats both
id and text of the row that stays shares its fate. An empty table gives an
empty result. Other columns are never looked at.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.llm.bitmaps import bitmap, marked, whole_rows

PREFIX_CHARS = 64


def lower_ascii(text: Column) -> Column:
    """Null as empty, A-Z lower-cased, every other character kept."""
    value = F.coalesce(text, F.lit(""))
    plain = F.octet_length(value) == F.char_length(value)
    return F.when(plain, F.lower(value)).otherwise(F.translate(value, string.ascii_uppercase, string.ascii_lowercase))


def _bytes(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit("")))


def _prefix(text: Column) -> Column:
    return F.xxhash64(lower_ascii(F.substring(text, 1, PREFIX_CHARS)))


def _surviving(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``_hit``: length and prefix of the row's text both repeat, as far as the bitmaps can tell."""
    sized = rows.select(F.col(text).alias("_text"), _bytes(F.col(text)).alias("_size"))
    sizes = bitmap(sized.groupBy("_size").count().where("count > 1"), F.col("_size"))
    prefixed = marked(sized, F.col("_size"), sizes).where("_hit").select("_size", _prefix(F.col("_text")).alias("_prefix"))
    repeated = prefixed.groupBy("_size", "_prefix").count().where("count > 1")
    keys = bitmap(repeated.select(F.xxhash64("_size", "_prefix").alias("_key")), F.col("_key"))
    return marked(rows.withColumn("_key", F.xxhash64(_bytes(F.col(text)), _prefix(F.col(text)))), F.col("_key"), keys).drop("_key")


def _digest(text: Column) -> Column:
    return F.sha2(lower_ascii(text).cast("binary"), 256)


def duplicate_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of texts whose length and prefix repeat: _sha, keep_id, group_size.

    Only the texts of rows that survive the first two levels are hashed whole.
    """
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    hashed = _surviving(rows, "_text").where("_hit").select("_id", _digest(F.col("_text")).alias("_sha"))
    return hashed.groupBy("_sha").agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def label_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    The digest is asked for every row here, so every text is hashed once more
    than the groups need; a unique row meets no group and keeps itself.
    """
    rows = docs.select(F.col(id).alias("_id"), _digest(F.col(text)).alias("text_sha256"))
    groups = duplicate_groups(docs, id, text)
    joined = rows.join(groups, rows.text_sha256 == groups._sha, "left")
    grouped = F.col("_sha").isNotNull()
    keep = F.when(grouped, F.col("keep_id")).otherwise(F.col("_id"))
    return joined.select(
        F.col("_id").alias(id), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that the bitmaps clear pass without a shuffle. The others join on hash
    and id together, so a large group of copies is no hot key.
    """
    sides = _surviving(whole_rows(docs, _id=F.col(id), _text=F.col(text)), "_text")
    suspects = sides.where("_hit").select("_row", "_id", _digest(F.col("_text")).alias("_sha"))
    stay = duplicate_groups(docs, id, text).select(F.col("_sha").alias("_stay"), F.col("keep_id").alias("_keep"))
    kept = suspects.join(stay, (F.col("_sha") == F.col("_stay")) & F.col("_id").eqNullSafe(F.col("_keep")), "left_semi")
    # Rows that repeat id and text of the row that stays: one of them is kept.
    kept = kept.groupBy("_sha").agg(F.first("_row").alias("_row"))
    return sides.where(~F.col("_hit")).select("_row.*").unionByName(kept.select("_row.*"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = """
WITH hashed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)"""
