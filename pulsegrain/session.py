"""Session settings and the folder that all executors can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def build_session(app: str = "pulsegrain", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; extra settings go in ``conf``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables, from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a folder of
    its own, since driver and executors are one process there.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="pulsegrain-")
    return _local_folder


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage, and lost executors cannot lose it.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)



def removed(df: DataFrame) -> None:
    """Deletes the table that ``written`` gave as ``df``, once nothing will read it again."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
        if path.getParent().toUri().getPath() == folder.toUri().getPath():
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query go as soon as it ends; a table that is read twice there is computed twice."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
