"""The size of Arrow and scan batches, which is what a task holds of long texts at once."""

from __future__ import annotations

from pyspark.sql import SparkSession

MOST = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1_000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20,
    "spark.sql.parquet.columnarReaderBatchSize": 512,
}


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's limits to MOST where they are higher or absent."""
    for name, most in MOST.items():
        now = spark.conf.get(name, None)
        value = int(now) if now and now.strip().lstrip("-").isdigit() else 0
        if value <= 0 or value > most:
            spark.conf.set(name, str(most))
