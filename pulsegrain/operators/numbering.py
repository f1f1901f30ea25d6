"""Consecutive row numbers without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, NumericType, StringType, StructType

from pulsegrain.session import written

# Rows that one task may number, and their bytes; the rows are cut into ranges of about so many.
ROWS_PER_RANGE = 1_000_000
BYTES_PER_RANGE = 64 << 20


def _bytes_of(df: DataFrame) -> Column:
    """About the bytes of a row: the lengths of its texts and arrays, eight for all else."""
    size = F.lit(8 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, ArrayType) and isinstance(field.dataType.elementType, NumericType):
            size = size + 8 * F.greatest(F.size(column), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return size


def number_rows(
    df: DataFrame,
    key: str,
    then_by: Sequence[str] = (),
    groups: Sequence[str] = (),
    name: str = "row_no",
    rows_per_range: int | None = None,
) -> DataFrame:
    """Number rows 1, 2, … by ``key`` then ``then_by``, within ``groups`` if given.

    Keys are of any type that has an order; rows without one come first. The
    rows are range-partitioned by groups, key, ``then_by`` and a hash of the
    row, then by chance, so rows that share a key or lack one, and even rows
    that are equal in every column, spread over several ranges: rows that are
    equal up to ``then_by`` get consecutive numbers in an order of no meaning.
    The sorted ranges are stored once, their sizes are counted, and each row's
    place in its range is moved up by the ranges before. No range is numbered as a whole by a window.
    """
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_bytes_of(df))).first()
    ranges = max(1, -(-rows // (rows_per_range or ROWS_PER_RANGE)), -(-(size or 0) // BYTES_PER_RANGE))
    # Columns of any name may be there already.
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    fields = [f"_row.`{c}`" for c in (*groups, key, *then_by)]
    mixed = whole.withColumn("_hash", F.xxhash64("_row")).withColumn("_chance", F.rand(42))
    order = [F.col(f).asc_nulls_first() for f in fields] + [F.col("_hash"), F.col("_chance")]
    ranged = mixed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # A row's place: its range in the upper bits, its position there in the lower 33.
    placed = written(ranged.select("_row", F.monotonically_increasing_id().alias("_at")), "ranges")
    part = F.shiftright("_at", 33)
    names = [f"_g{i}" for i in range(len(groups))]
    grouped = placed.withColumns({n: F.col(f"_row.`{g}`") for n, g in zip(names, groups)}).withColumn("_part", part)
    sizes = grouped.groupBy(*names, "_part").agg(F.count(F.lit(1)).alias("_size"), F.min("_at").alias("_first"))
    # One row per range and group.
    before = F.sum("_size").over(Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.withColumn("_start", F.coalesce(before, F.lit(0))).select(
        *[F.col(n).alias(f"_s{n}") for n in names], F.col("_part").alias("_p"), "_first", "_start")
    same = F.col("_part") == F.col("_p")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_s{n}"))
    numbered = grouped.join(starts, same).withColumn("_no", F.col("_start") + F.col("_at") - F.col("_first") + 1)
    return numbered.select("_row.*", F.col("_no").cast("long").alias(name))


def assign_ids(df: DataFrame, key: str, prefix: str | Column, then_by: Sequence[str] = (), name: str = "id") -> DataFrame:
    """A running id from 0 over all rows, with a prefix such as the source."""
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    numbered = number_rows(df, key, then_by, name="_no")
    return numbered.withColumn(name, F.concat(head, F.lit("_"), (F.col("_no") - 1).cast("string"))).drop("_no")


def number_batches(df: DataFrame, key: str, size: int, then_by: Sequence[str] = (), name: str = "batch") -> DataFrame:
    """Rows in order of ``key`` cut into batches of ``size``, batches from 0."""
    numbered = number_rows(df, key, then_by, name="_no")
    return numbered.withColumn(name, F.floor((F.col("_no") - 1) / size)).drop("_no")
