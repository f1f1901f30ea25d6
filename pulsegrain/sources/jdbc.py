"""Database tables through JDBC. Addresses and accounts are always arguments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def scan_options(
    url: str, table: str, properties: Mapping[str, str] | None = None, *, partition_column: str | None = None,
    lower: object | None = None, upper: object | None = None, partitions: int | None = None, fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; with a partition column the table is read in parallel ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    split = (partition_column, lower, upper, partitions)
    if any(v is not None for v in split):
        if any(v is None for v in split):
            raise ValueError("a parallel read needs partition_column, lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions),
        }
    return options


def sink_options(
    url: str, table: str, properties: Mapping[str, str] | None = None, *, batch_size: int = 5000, connections: int = 8,
    truncate: bool = False,
) -> dict[str, str]:
    """Writer options; ``connections`` bounds the tasks that write at once."""
    options = {
        "url": url, "dbtable": table, "batchsize": str(batch_size), "numPartitions": str(connections),
        "rewriteBatchedStatements": "true", **(properties or {}),
    }
    return options | ({"truncate": "true"} if truncate else {})


def jdbc_scan(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None, **split) -> DataFrame:
    return spark.read.format("jdbc").options(**scan_options(url, table, properties, **split)).load()


def jdbc_append(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, **options) -> None:
    df.write.format("jdbc").options(**sink_options(url, table, properties, **options)).mode("append").save()


def jdbc_full_refresh(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, **options) -> None:
    """Empty the table, keeping its definition, and fill it again."""
    chosen = sink_options(url, table, properties, truncate=True, **options)
    df.write.format("jdbc").options(**chosen).mode("overwrite").save()
