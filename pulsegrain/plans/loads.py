"""Staged files to raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain import lexicons
from pulsegrain.functions import values as vl
from pulsegrain.operators import rows
from pulsegrain.sources import files


def prepared_comments(staged: DataFrame) -> DataFrame:
    """Staged comments renamed, dated, filled and deduplicated.

    Of several copies the one with the most likes stays.
    """
    df = rows.rename_by_mapping(staged, lexicons.COMMENT_COLUMNS)
    df = df.withColumn("commented_at", vl.parse_iso_timestamp(F.col("commented_at")))
    df = rows.fill_missing(df, {"content": lexicons.MISSING_TEXT})
    return rows.dedup_subset(df, lexicons.COMMENT_KEY, [F.desc("like_count")])


def prepared_reviews(staged: DataFrame) -> DataFrame:
    """Staged reviews renamed, dated, filled and deduplicated; the best rating stays."""
    df = rows.rename_by_mapping(staged, lexicons.REVIEW_COLUMNS)
    df = df.withColumn("purchased_at", vl.parse_any_date(F.col("purchased_at"))) \
        .withColumn("rating", vl.first_integer(F.col("rating")))
    df = rows.fill_missing(df, {"content": lexicons.MISSING_TEXT})
    return rows.dedup_subset(df, lexicons.REVIEW_KEY, [F.desc("rating")])


def _load_day(prepared: DataFrame, root: str, day: str, partition: str) -> DataFrame:
    files.overwrite_partitions(prepared.withColumn(partition, F.lit(day).cast("date")), root, partition)
    return files.read_partitions(prepared.sparkSession, root)


def comment_load(staged: DataFrame, root: str, day: str, partition: str = "ds") -> DataFrame:
    """The raw comment table at ``root`` after loading what was staged on one day.

    The rows replace that day's partition, so loading twice changes nothing.
    Late rows and rows without a time are kept; other days are not touched.
    Where nothing was staged, the day stays as it was.
    """
    return _load_day(prepared_comments(staged), root, day, partition)


def review_load(staged: DataFrame, root: str, day: str, partition: str = "ds") -> DataFrame:
    """As ``comment_load`` for the raw review table."""
    return _load_day(prepared_reviews(staged), root, day, partition)
