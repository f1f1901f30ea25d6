"""Fixed-size bitmaps of keys, to tell in a scan which rows can matter.

A bitmap lets some foreign keys through and never holds a true one back, so
what follows stays exact; it only has fewer rows to shuffle. Its size is fixed
and does not grow with the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain.session import written

BITS = 1 << 22  # 128 rows of 4 KB are broadcast


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS)) + 1


def bitmap(keys: DataFrame, key: Column) -> DataFrame:
    """The places of the keys, as at most BITS / 32768 + 1 rows."""
    place = _place(key)
    return keys.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))


def marked(rows: DataFrame, key: Column, bits: DataFrame) -> DataFrame:
    """Adds ``_hit``: whether the bitmap holds the row's key."""
    place = _place(key)
    joined = rows.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number("_place"))
    joined = joined.join(F.broadcast(bits), "_bucket", "left")
    position = F.bitmap_bit_position(F.col("_place"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (position % 8).cast("int") + 1)) != 0
    return joined.withColumn("_hit", F.coalesce(hit, F.lit(False))).drop("_place", "_bucket", "_bits")


def whole_rows(rows: DataFrame, **keys: Column) -> DataFrame:
    """Each row as one struct ``_row`` beside keys, so no column name can clash."""
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), *[v.alias(k) for k, v in keys.items()])


def row_key(id: Column, text: Column) -> Column:
    """64 bits that tell a row by its id and its text; null ids and texts count as such."""
    return F.xxhash64(id, F.coalesce(text, F.lit("")), id.isNull())


def without_rows(rows: DataFrame, key: Column, dropped: DataFrame) -> DataFrame:
    """Rows whose key is not in ``dropped``, a one-column table of keys that are never null.

    The keys are stored once, and rows that the bitmap clears pass without a shuffle.
    """
    gone = written(dropped.select(F.col(dropped.columns[0]).alias("_gone")).distinct(), "gone")
    sides = marked(whole_rows(rows, _id=key), F.col("_id"), bitmap(gone, F.col("_gone")))
    checked = sides.where("_hit").join(gone, F.col("_id") == F.col("_gone"), "left_anti")
    return sides.where(~F.col("_hit")).select("_row.*").unionByName(checked.select("_row.*"))


def once_each(rows: DataFrame, key: Column) -> DataFrame:
    """One row of those that share a key.

    Keys that repeat are counted without the rows; only rows that may have such
    a key are gathered, after each task has put its own together.
    """
    repeated = rows.select(key.alias("_key")).groupBy("_key").count().where("count > 1").select("_key")
    sides = marked(whole_rows(rows, _key=key), F.col("_key"), bitmap(repeated, F.col("_key")))
    one = sides.where("_hit").groupBy("_key").agg(F.first("_row").alias("_row"))
    return sides.where(~F.col("_hit")).select("_row.*").unionByName(one.select("_row.*"))
