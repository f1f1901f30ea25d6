"""Files and partitioned tables: read, write, replace, append."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsegrain.functions import values as vl
from pulsegrain.operators.numbering import number_rows
from pulsegrain.session import new_path, written

VIDEOS = (
    "items array<struct<id:struct<videoId:string>,"
    "snippet:struct<title:string,publishedAt:string,channelTitle:string>>>"
)
COMMENTS = (
    "videoId string, items array<struct<snippet:struct<topLevelComment:struct<"
    "snippet:struct<textDisplay:string,likeCount:int,publishedAt:string>>>>>, nextPageToken string"
)


# -- reading

def read_partition(spark: SparkSession, root: str, day: str, columns: Sequence[str], partition: str = "ds") -> DataFrame:
    """One run-date partition; other directories are not listed for data."""
    return spark.read.parquet(root).where(F.col(partition) == F.lit(day).cast("date")).select(*columns)


def read_partitions(spark: SparkSession, root: str) -> DataFrame:
    """All run-date partitions, the date as a column."""
    return spark.read.parquet(root)


def read_filtered(df: DataFrame, condition: Column, columns: Sequence[str]) -> DataFrame:
    return df.where(condition).select(*columns)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True) -> DataFrame:
    """A CSV table. Without line ends in its values, ``multi_line=False`` lets many tasks read one file."""
    return spark.read.csv(path, schema=schema, header=True, multiLine=multi_line, escape='"')


def read_wordlist(spark: SparkSession, path: str) -> DataFrame:
    """One entry per line as column ``word``; blank lines dropped."""
    words = spark.read.text(path).select(F.trim("value").alias("word"))
    return words.where(F.col("word") != "").distinct()


def read_videos(spark: SparkSession, path: str) -> DataFrame:
    """Video rows out of search responses."""
    item = spark.read.json(path, schema=VIDEOS).select(F.explode("items").alias("i"))
    return item.select(
        F.col("i.id.videoId").alias("video_id"), F.col("i.snippet.title").alias("title"),
        F.col("i.snippet.publishedAt").alias("published_at"), F.col("i.snippet.channelTitle").alias("channel_title"),
    )


def read_comments(spark: SparkSession, path: str) -> DataFrame:
    """Comment rows out of comment-thread responses."""
    item = spark.read.json(path, schema=COMMENTS).select("videoId", F.explode("items").alias("i"))
    inner = "i.snippet.topLevelComment.snippet"
    return item.select(
        F.col("videoId").alias("video_id"), F.col(f"{inner}.textDisplay").alias("comment"),
        F.col(f"{inner}.likeCount").alias("like_count"), F.col(f"{inner}.publishedAt").alias("published_at"),
    )


def read_catalogue(df: DataFrame, template: str, brand: str, model: str, year: str, spec: str) -> DataFrame:
    """A product list with one description text per row."""
    columns = [F.col(c).cast("string") for c in (brand, model, year, spec)]
    return df.withColumn("description", vl.filled(template, *columns))


# -- writing

def write_by_source(df: DataFrame, root: str, source: str) -> str:
    """Parquet under one directory per query or product.

    Rebalancing gathers a source into few files and splits a source with most
    of the rows over several tasks.
    """
    df.hint("rebalance", source).write.mode("overwrite").partitionBy(source).parquet(root)
    return root


def write_csv(df: DataFrame, path: str) -> str:
    df.write.csv(path, header=True, mode="overwrite", escape='"')
    return path


def overwrite_partitions(df: DataFrame, root: str, partition: str = "ds") -> str:
    """Replace exactly the partitions present in ``df``; running twice changes nothing."""
    balanced = df.hint("rebalance", partition)
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(root)
    return root


def full_refresh(df: DataFrame, path: str) -> str:
    """Replace the whole table."""
    df.write.mode("overwrite").parquet(path)
    return path


# -- load rules

def replace_from_date(target: DataFrame, new: DataFrame, ts: str, run_date: str) -> DataFrame:
    """Target rows before the run date and new rows from it on; loading twice changes nothing.

    Stored rows without a time stay. New rows without one, or from before the
    run date, do not fit the rule; ``rejected_from_date`` gives them.
    """
    day = F.lit(run_date).cast("timestamp_ntz")
    stays = F.coalesce(F.col(ts) < day, F.lit(True))
    return target.where(stays).unionByName(new.where(F.col(ts) >= day))


def rejected_from_date(new: DataFrame, ts: str, run_date: str) -> DataFrame:
    """The new rows that ``replace_from_date`` does not load: undated, or dated before the run date."""
    return new.where(~F.coalesce(F.col(ts) >= F.lit(run_date).cast("timestamp_ntz"), F.lit(False)))


def load_from_date(spark: SparkSession, path: str, new: DataFrame, ts: str, run_date: str) -> str:
    """``replace_from_date`` on a stored table, via a new version beside the old one.

    The table is read while its successor is written, so it is not
    overwritten in place; the caller swaps the returned path in.
    """
    fresh = new_path(spark, "load")
    replace_from_date(spark.read.parquet(path), new, ts, run_date).write.parquet(fresh)
    return fresh


def insert_if_absent(target: DataFrame, new: DataFrame, keys: Sequence[str], id_column: str, order: str) -> DataFrame:
    """New rows whose key the target lacks, one per key, with ids after the target's highest.

    ``order`` is a numeric column of ``new`` by which ids are given out.
    """
    absent = (
        new.groupBy(*keys).agg(F.min(order).alias(order))
        .join(target.select(*keys).distinct(), list(keys), "left_anti")
    )
    # Numbering reads its input several times; the keys alone are stored for it.
    absent = written(absent, "absent")
    highest = target.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    numbered = number_rows(absent, order, keys, name="_no")
    return numbered.withColumn(id_column, F.col("_no") + highest).select(*keys, id_column)


def merge_fields(old: DataFrame, new: DataFrame, key: str, json: str) -> DataFrame:
    """Keys of the new JSON object replace those of the old one; the others stay.

    Bad or missing JSON counts as empty. One row per ``key`` and JSON entry.
    """
    before = old.select(key, F.explode(vl.json_map(F.col(json))).alias("field", "old_value"))
    after = new.select(key, F.explode(vl.json_map(F.col(json))).alias("field", "new_value"))
    return before.join(after, [key, "field"], "full").select(
        key, "field", F.coalesce("new_value", "old_value").alias("value")
    )


def merge_json(json: Column, changes: Column) -> Column:
    """A JSON object text with some entries set or replaced, given as a map of strings."""
    old = vl.json_map(json)
    kept = F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(changes), k))
    return F.to_json(F.map_concat(kept, changes))


def json_fields(df: DataFrame, key: str, json: str) -> DataFrame:
    """One row per entry of a JSON object: key, field, and the value as JSON text, whatever its type.

    Bad JSON, missing JSON and JSON that is no object have no entries.
    """
    rows = df.select(F.col(key).alias("_id"), F.col(json).alias("_json"))
    entries = df.sparkSession.tvf.variant_explode(F.try_parse_json(F.col("_json").outer()))
    found = rows.lateralJoin(entries).where(F.col("key").isNotNull())
    return found.select(F.col("_id").alias(key), F.col("key").alias("field"), F.to_json("value").alias("value"))


def merge_results(stored: DataFrame, steps: Sequence[DataFrame], key: str, json: str = "result") -> DataFrame:
    """Stored JSON objects with the entries of the steps' objects set or replaced: key, json.

    Every step has one object per key and entries of its own. Entries that no
    step has stay as they are, nested values included, so merging the same
    steps again changes nothing. Keys of either side stay.
    """
    new = None
    for step in steps:
        fields = json_fields(step, key, json)
        new = fields if new is None else new.unionByName(fields)
    old = json_fields(stored, key, json).withColumnRenamed("value", "old_value")
    merged = old.join(new, [key, "field"], "full").select(key, "field", F.coalesce("value", "old_value").alias("value"))
    name = F.expr("substring(to_json(array(field)), 2, length(to_json(array(field))) - 2)")
    # The entries of one object.
    entries = F.array_sort(F.collect_list(F.struct("field", F.concat(name, F.lit(":"), F.col("value")).alias("entry"))))
    objects = merged.groupBy(key).agg(F.array_join(F.transform(entries, lambda e: e["entry"]), ",").alias("_inner"))
    keys = stored.select(key)
    for step in steps:
        keys = keys.unionByName(step.select(key))
    whole = keys.distinct().join(objects, key, "left")
    return whole.select(key, F.concat(F.lit("{"), F.coalesce("_inner", F.lit("")), F.lit("}")).alias(json))


def collected_since(df: DataFrame, ts: str, mark: Column) -> DataFrame:
    """Rows newer than the stored mark."""
    return df.where(F.col(ts) > mark)


def next_mark(df: DataFrame, ts: str, last_run: object | None = None, days_back: int = 7):
    """The mark to store after a run: the newest timestamp, else ``days_back`` before ``last_run``."""
    newest = df.agg(F.max(ts)).first()[0]
    if newest is not None:
        return newest
    return None if last_run is None else last_run - timedelta(days=days_back)


# -- profile

def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Row and NULL counts per column of each table: one aggregate per table."""
    parts = []
    for name, df in tables.items():
        counted = df.agg(
            F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
        )
        cells = [
            F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"), F.col(c).alias("n_null"))
            for i, c in enumerate(df.columns, 1)
        ]
        parts.append(counted.select(F.lit(name).alias("table_name"), F.col("_rows").alias("n_rows"), F.inline(F.array(*cells))))
    profile = parts[0]
    for part in parts[1:]:
        profile = profile.unionAll(part)
    return profile
