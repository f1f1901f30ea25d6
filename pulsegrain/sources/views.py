"""The engine's tables over the supplied Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of a text table, with every core given a share of it.

    A small file of one row group would be read and worked on by one task. A
    table of a normal size has more splits than there are cores and passes
    through without a shuffle.
    """
    scan = table(spark, folder, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def sentences(spark: SparkSession, folder: str) -> DataFrame:
    """The sentence fact: one dated, labelled, liked sentence per line item."""
    items = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part")
    return items.join(parts, items.l_partkey == parts.p_partkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("p_name").alias("sentence"),
        F.col("p_brand").alias("brand"),
        F.when(F.col("l_returnflag") == "A", "1").when(F.col("l_returnflag") == "R", "0").alias("sentiment_label"),
        F.col("l_discount").alias("sentiment_score"),
        F.col("l_quantity").cast("int").alias("like_count"),
        F.col("l_shipdate").alias("commented_at"),
    )


def brands(spark: SparkSession, folder: str) -> DataFrame:
    """The brand list, from the product table rather than the fact."""
    return table(spark, folder, "part").select(F.col("p_brand").alias("brand")).distinct()


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One review per line item: product name, rating, purchase date."""
    items = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part")
    return items.join(parts, items.l_partkey == parts.p_partkey).select(
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("content"),
        F.col("p_size").alias("rating"),
        F.col("l_shipdate").alias("purchased_at"),
    )


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """Long comments with their labels where there are any."""
    documents = texts(spark, folder, "documents", "doc_id", "text", "source", "lang")
    labels = table(spark, folder, "labels").withColumnRenamed("doc_id", "labelled_id")
    return documents.join(labels, F.col("doc_id") == F.col("labelled_id"), "left").select(
        F.col("doc_id").alias("comment_id"), F.col("text").alias("content"), "source", "lang",
        F.col("quality").alias("label"), "toxic",
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """One report request per order: cohort, hobby, keywords, time."""
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return joined.join(nations, joined.c_nationkey == nations.n_nationkey).select(
        F.col("o_orderkey").alias("request_id"),
        F.col("c_custkey").alias("user_id"),
        F.col("n_nationkey").alias("hobby_id"),
        F.col("n_name").alias("hobby"),
        F.col("c_mktsegment").alias("gender"),
        F.col("o_orderpriority").alias("age_group"),
        F.array("o_orderstatus", "c_mktsegment").alias("keywords"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("updated_at"),
    )


def activity(spark: SparkSession, folder: str) -> DataFrame:
    """The event log with a zoned timestamp, as watermarks need it."""
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
