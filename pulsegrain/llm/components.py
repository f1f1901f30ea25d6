"""Connected components of a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.session import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for every node of an edge.

    ``edges`` has columns u and v of one type. Each round links every node's
    larger neighbours, then its smaller ones, to the smallest neighbour it has;
    the number of rounds grows with the logarithm of the nodes. A round is a
    written table, so lost executors cost one round at most.
    """
    now = written(edges.where("u <> v").select("u", "v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        if (new := _state(after)) == state:
            break
        now, state = after, new
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
