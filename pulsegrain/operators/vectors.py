"""Vector tables and nearest-neighbour search."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from pulsegrain.functions.text import tokens_of
from pulsegrain.operators.numbering import number_rows
from pulsegrain.session import written

# Vectors and queries of one cell of the search grid, and queries whose products are held at once.
VECTOR_BLOCK = 50_000
QUERY_BLOCK = 10_000
QUERIES_AT_ONCE = 100


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def mean_vectors(df: DataFrame, group: str, embedding: str) -> DataFrame:
    """The mean vector per group, added up vector by vector in each task; null vectors do not count."""
    known = df.where(F.col(embedding).isNotNull()).select(group, array_to_vector(embedding).alias("_v"))
    return known.groupBy(group).agg(vector_to_array(Summarizer.mean(F.col("_v"))).alias("query"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of length 1; a zero vector stays zero."""
    values = column.combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks)
    rows = values.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(values), -1)
    lengths = np.linalg.norm(rows, axis=1)
    return rows / np.where(lengths == 0, 1.0, lengths)[:, None]


def _cell(k: int, schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A cell of the grid: the k best vectors of a block for each query of a block."""

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        vectors, queries = _matrix(left.column("embedding")), _matrix(right.column("query"))
        ids = left.column("id").to_numpy()
        kinds, groups = left.column("filter").to_pylist(), right.column("filter").to_pylist()
        of_kind: dict = {}
        for i, value in enumerate(kinds):
            of_kind.setdefault(value, []).append(i)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for value in sorted(set(groups), key=repr):
            rows = np.array(of_kind.get(value, []), np.int64)
            asked = np.array([q for q, g in enumerate(groups) if g == value], np.int64)
            if value is None or not len(rows):
                continue
            for first in range(0, len(asked), QUERIES_AT_ONCE):
                part = asked[first:first + QUERIES_AT_ONCE]
                sims = np.round(queries[part] @ vectors[rows].T, 6) + 0.0
                if len(rows) > k:
                    least = np.partition(sims, -k, axis=1)[:, -k]
                    q, v = np.nonzero(sims >= least[:, None])
                else:
                    q, v = np.nonzero(np.ones_like(sims, bool))
                order = np.lexsort((ids[rows[v]], -sims[q, v], q))
                q, v = q[order], v[order]
                starts = np.searchsorted(q, np.arange(len(part)))
                keep = np.arange(len(q)) - starts[q] < k
                found.append((part[q[keep]], ids[rows[v[keep]]], sims[q[keep], v[keep]]))
        if not found:
            return schema.empty_table()
        at, near, similarity = (np.concatenate(c) for c in zip(*found))
        return pa.table([right.column("query_id").take(pa.array(at)), pa.array(near, pa.int64()), pa.array(similarity)], schema=schema)

    return best


def vector_topk(
    vectors: DataFrame, queries: DataFrame, k: int, key: str, embedding: str = "embedding",
    query_id: str = "query_id", query: str = "query", same: str | None = None,
) -> DataFrame:
    """The ``k`` nearest vectors per query by cosine, similarity rounded to 6, ties by id.

    ``same`` names a column of both tables that must be equal (a metadata
    filter). Vectors and queries are dealt into blocks of bounded size by a hash
    of their id, and every pair of blocks is a cell of a grid: a matrix product
    that passes on k rows per query, ranked over all cells in the end. The
    vectors are read once whatever the number of queries, and nothing passes
    through the driver. A query or a row without a vector has no neighbours; all vectors have one length.
    """
    spark = vectors.sparkSession
    asked = queries.where(F.col(query).isNotNull()).select(
        F.col(query_id).alias("query_id"), F.col(query).cast("array<double>").alias("query"),
        (F.col(same) if same else F.lit(0)).cast("string").alias("filter"))
    rows = vectors.where(F.col(embedding).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(embedding).alias("embedding"), (F.col(same) if same else F.lit(0)).cast("string").alias("filter"))
    asked = written(asked, "queries")
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    vector_blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-vectors.select(key).count() // VECTOR_BLOCK))

    def blocks(id: Column, n: int) -> Column:
        return F.pmod(F.xxhash64(id), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = rows.withColumn("_vector_block", blocks(F.col("id"), vector_blocks)).withColumn("_query_block", every(query_blocks))
    right = asked.withColumn("_query_block", blocks(F.col("query_id"), query_blocks)).withColumn("_vector_block", every(vector_blocks))
    kind = asked.schema["query_id"]
    schema = to_arrow_schema(StructType([StructField("query_id", kind.dataType), StructField("id", LongType()), StructField("similarity", DoubleType())]))
    cell = ["_vector_block", "_query_block"]
    near = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_cell(k, schema), f"query_id {kind.dataType.simpleString()}, id long, similarity double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), F.asc("id")))
    return near.withColumn("rank", rank).where(F.col("rank") <= k)


def vector_table(
    frames: Sequence[tuple[str, DataFrame]], key: str, text: str, embedding: str, batch: int = 1000
) -> DataFrame:
    """Texts of several sources as one vector table: id with source prefix, text, source, vector, batch."""
    stacked = None
    for source, frame in frames:
        part = frame.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("text"),
                            F.lit(source).alias("brand"), F.col(embedding).alias("embedding"))
        stacked = part if stacked is None else stacked.unionByName(part)
    numbered = number_rows(stacked, "_key", ["brand"], name="_no")
    return numbered.select(
        F.concat("brand", F.lit("_"), (F.col("_no") - 1).cast("string")).alias("id"), "text", "brand", "embedding",
        F.floor((F.col("_no") - 1) / batch).alias("batch"),
    )


def hashed_embedding(df: DataFrame, key: str, text: str, name: str = "embedding", dimensions: int = 64) -> DataFrame:
    """Add a vector of length 1 of hashed term counts, for texts that come without an embedding.

    A term's dimension is the first four hexadecimal digits of its MD5, modulo
    ``dimensions``. Ids are unique; a text without a term has the zero vector.
    """
    place = F.conv(F.left(F.md5(F.col("_term").cast("binary")), F.lit(4)), 16, 10).cast("int") % dimensions
    found = df.select(F.col(key).alias("_id"), F.explode(tokens_of(F.col(text))).alias("_term")).select("_id", place.alias("_dim"))
    counts = found.groupBy("_id", "_dim").agg(F.count(F.lit(1)).alias("_n"))
    # At most ``dimensions`` entries.
    vectors = counts.groupBy("_id").agg(
        F.map_from_entries(F.collect_list(F.struct("_dim", "_n"))).alias("_m"), F.sqrt(F.sum(F.col("_n") * F.col("_n"))).alias("_length"))
    joined = df.join(vectors, F.col(key).eqNullSafe(F.col("_id")), "left")
    values = F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda d: F.coalesce(F.element_at("_m", d) / F.col("_length"), F.lit(0.0)))
    return joined.withColumn(name, values).select(*df.columns, name)
