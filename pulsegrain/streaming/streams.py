"""Incremental forms of ingest, deduplication and trend.

Each function runs the data available now and returns; the next call goes on
from the checkpoint, so a file or event is handled exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsegrain.sources import files


def stream_files(spark: SparkSession, path: str, schema: StructType, per_trigger: int = 1000) -> DataFrame:
    """New Parquet files under ``path`` as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def stream_ingest(stream: DataFrame, ts: str, target: str, checkpoint: str) -> None:
    """Append new rows to a table partitioned by day; the file sink's log makes it exactly-once."""
    (
        stream.withColumn("ds", F.to_date(ts)).writeStream.format("parquet").partitionBy("ds")
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def stored_mark(spark: SparkSession, root: str, before: int | None = None):
    """The newest time that the batches before ``before`` have taken in, None without one."""
    if not _exists(spark, f"{root}/marks"):
        return None
    marks = spark.read.schema("mark timestamp_ntz, batch long").option("recursiveFileLookup", "false").parquet(f"{root}/marks")
    return (marks if before is None else marks.where(F.col("batch") < before)).agg(F.max("mark")).first()[0]


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system of the path holds it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def ingest_batch(rows: DataFrame, batch: int, ts: str, root: str) -> None:
    """Take in the rows that are newer than the stored mark, and move the mark.

    Rows and mark of a batch lie under its id, and the mark it starts from is
    that of the batches before it, so a repeated batch writes the same again.
    Rows without a time are never newer.
    """
    mark = stored_mark(rows.sparkSession, root, batch)
    fresh = rows.where(F.col(ts).isNotNull()) if mark is None else files.collected_since(rows, ts, F.lit(mark))
    fresh.write.mode("overwrite").parquet(f"{root}/rows/batch={batch}")
    taken = rows.sparkSession.read.schema(fresh.schema).parquet(f"{root}/rows/batch={batch}")
    newest = taken.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("mark"))
    newest.where("mark IS NOT NULL").write.mode("overwrite").parquet(f"{root}/marks/batch={batch}")


def stream_since(stream: DataFrame, ts: str, root: str, checkpoint: str) -> None:
    """``ingest_batch`` on the micro-batches of a stream."""
    (
        stream.writeStream.foreachBatch(lambda rows, batch: ingest_batch(rows, batch, ts, root)).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def stream_dedup(stream: DataFrame, keys: Sequence[str], ts: str, delay: str, target: str, checkpoint: str) -> None:
    """Append the first row per key; keys older than the watermark are forgotten."""
    (
        stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
        .writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def stream_trend(
    stream: DataFrame, ts: str, key: str, window: str, delay: str, target: str, checkpoint: str
) -> None:
    """Counts per time window and key, kept current as a table of changed windows.

    Each micro-batch writes the windows it changed into its own directory, so
    a repeated batch replaces itself; ``read_trend`` takes the newest count of
    every window. State holds one row per open window and key.
    """
    counts = (
        stream.withWatermark(ts, delay).groupBy(F.window(ts, window).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), key, "n")
    )

    def store(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{target}/batch={batch}")

    (
        counts.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def read_trend(spark: SparkSession, target: str, key: str) -> DataFrame:
    """The current count per window and key: counts only grow, so the largest is the newest."""
    return spark.read.parquet(target).groupBy("window_start", key).agg(F.max("n").alias("n"))
