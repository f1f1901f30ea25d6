"""Keyword matching and key lookups."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pulsegrain.functions import values as vl
from pulsegrain.operators import runs
from pulsegrain.session import written


def match_keywords(df: DataFrame, text: str, keywords: Sequence[str], regex: bool = False) -> DataFrame:
    """One row per text and listed keyword it contains.

    A keyword counts once per text. The list is part of the expression, so
    there is no join.
    """
    hits = F.array(*[F.when(vl.contains(F.col(text), k, regex), F.lit(k)) for k in keywords])
    return df.withColumn("keyword", F.explode(F.array_compact(hits)))


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], spread_by: str, salts: int = 8, how: str = "inner") -> DataFrame:
    """Equi-join that splits each key of ``big`` over ``salts`` tasks.

    ``small`` is repeated per salt. A key with a third of all rows is then
    handled by several tasks; where Spark sees that ``small`` is below the
    broadcast limit it broadcasts it instead.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


# A table up to this estimate is handed to every executor.
BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, texts: Sequence[str]) -> bool:
    """Whether a stored table is small enough to broadcast, by its rows and text lengths."""
    length = sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(64))
    return (df.agg(F.sum(length.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES


def hot_key_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], rows: str, spread_by: str, salts: int = 32, hottest: int = 1000
) -> DataFrame:
    """Equi-join that splits only the hot keys of ``big``.

    ``small`` has one row per key, and its column ``rows`` tells how many rows
    the key has in ``big``. A key is hot above 1/``hottest`` of all rows, so
    there are fewer than ``hottest`` of them: that list is broadcast to mark
    the rows to salt, and only those keys of ``small`` are repeated.
    """
    total = small.agg(F.sum(rows)).scalar()
    is_hot = F.col(rows) * hottest > F.col("_total")
    sized = small.withColumn("_total", total)
    hot = F.broadcast(sized.where(is_hot).select(*on, F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")).otherwise(0)
    left = big.join(hot, list(on), "left").withColumn("_salt", salt).drop("_hot")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = sized.withColumn("_salt", F.explode(copies)).drop("_total")
    return left.join(right, [*on, "_salt"]).drop("_salt")


def split_hot_join(
    big: DataFrame, small: DataFrame, on: str, counts: DataFrame, spread_by: str, salts: int = 32, always: int | None = None,
) -> DataFrame:
    """Equi-join on one column that splits the hot keys of ``big`` over ``salts`` tasks; both sides may repeat a key.

    ``counts`` tells the rows ``n`` of each key in ``big``. Fewer than HOTTEST
    keys hold more than 1/HOTTEST of all rows: that list is broadcast to both
    sides. ``always`` names a key that is hot without a count.
    """
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    hot = counts.withColumn("_all", whole).where(F.col("n") * HOTTEST > F.col("_all")).select(on)
    if always is not None:
        hot = hot.unionAll(big.sparkSession.range(1).select(F.lit(always).cast("long").alias(on)))
    hot = written(hot, "hot-keys").withColumn("_hot", F.lit(True))
    left = big.join(F.broadcast(hot), on, "left")
    left = left.withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")).otherwise(0)).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [on, "_salt"]).drop("_salt")


# Words of 64 bits of the set of runs that a scan has where they are too many to be held, a power of two; it does not grow with the keywords.
SET_WORDS = 1 << 18

# A run is hot above 1/HOTTEST of all texts that offer a filed run, so there are fewer than HOTTEST of them.
HOTTEST = 1000


def known_runs(hashed: DataFrame) -> Broadcast:
    """The runs of a table with their hash ``_run`` and their length ``size`` for a scan: held if they are few enough, else a set that may hold others, never lacks one."""
    sizes = sorted(r["size"] for r in hashed.select("size").distinct().collect())  # at most as many as a run has characters
    distinct = hashed.select("_run").distinct()
    if distinct.count() * 32 <= BROADCAST_BYTES:
        hashes = np.sort(distinct.toArrow().column("_run").to_numpy().view(np.uint64))
        return hashed.sparkSession.sparkContext.broadcast(runs.known(sizes, hashes))
    bits = (SET_WORDS * 64).bit_length() - 1
    place = F.shiftrightunsigned("_run", 64 - bits)
    words = hashed.groupBy(F.shiftright(place, 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))).alias("bits"))
    found, held = words.toArrow(), np.zeros(SET_WORDS, np.int64)  # SET_WORDS rows at most
    held[found.column("w").to_numpy()] = found.column("bits").to_numpy()
    return hashed.sparkSession.sparkContext.broadcast(runs.Known(sizes, np.unpackbits(held.view(np.uint8), bitorder="little").astype(bool)))


def _with_hash(df: DataFrame) -> DataFrame:
    """The rows with the hash ``_run`` of their ``run`` and its length ``size``."""
    sized = df.withColumn("size", F.length("run"))
    return sized.mapInArrow(runs.hashed("run", sized.columns), StructType([*sized.schema.fields, StructField("_run", LongType())]))


def keyword_index(df: DataFrame, lexicon: DataFrame, text: str, gram: int = 5) -> DataFrame:
    """Each keyword under the rarest of its character runs: keyword, run, n.

    Runs have ``gram`` characters; a shorter keyword is its own run. ``n`` is the
    number of texts that hold the run, counted over ``df``. A keyword with a run
    that no text holds cannot be found and has no entry.
    """
    words = lexicon.select("keyword").where(F.length("keyword") > 0).distinct()
    parts = written(words.mapInArrow(runs.runs_of(gram), "keyword string, run string, size int, _run long"), "keyword-runs")
    counts = df.select(text).mapInArrow(runs.counted(known_runs(parts)), "_run long, n long").groupBy("_run").agg(F.sum("n").alias("n"))
    found = parts.join(counts, "_run", "left").groupBy("keyword").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "run")).alias("rarest"))
    return found.where("rarest.n > 0").select("keyword", "rarest.run", "rarest.n")


def match_keyword_table(
    df: DataFrame, lexicon: DataFrame, text: str, gram: int = 5, salts: int = 32, also: str | None = None
) -> DataFrame:
    """As ``match_keywords`` with the keywords in column ``keyword`` of a table of any size.

    Every keyword is filed under its rarest run of characters (``keyword_index``),
    and a text is compared with the keywords whose runs it holds, so the work
    follows the matches and not texts times keywords. Runs are hashes over the
    bytes of many texts at once (``runs``). An index of checked size is handed to
    every task, which compares at the places of the runs, and no text is shuffled.
    With a larger one a text offers the runs that are filed, an equi-join on the
    run finds candidates, and a containment test settles them; the runs with the
    most texts, by the index's own counts, are split over ``salts`` tasks. Null
    texts and empty keywords match nothing. With ``also``, every row that has a
    text comes once more under that name, so one scan gives both what matches
    and what there is.
    """
    index = written(keyword_index(df, lexicon, text, gram), "keyword-index")
    columns = [StructField(f.name, f.dataType) for f in df.schema.fields]
    if fits_broadcast(index, ["keyword", "run"]):
        found = index.select("keyword", "run").toArrow()
        words = df.sparkSession.sparkContext.broadcast(runs.filed(*(found.column(c).cast(pa.string()).combine_chunks() for c in ("keyword", "run"))))
        return df.mapInArrow(runs.matched(words, text, df.columns, also), StructType([*columns, StructField("keyword", StringType())]))
    filed = written(_with_hash(index), "keyword-index")
    offered = df.mapInArrow(runs.offered(known_runs(filed), text, df.columns, also is not None), StructType([*columns, StructField("_run", LongType())]))
    counts = filed.groupBy("_run").agg(F.max("n").alias("n"))
    filed = filed.select("keyword", "_run")
    if also is not None:
        # 0 is every text's run; it is hot by definition.
        filed = filed.unionByName(df.sparkSession.range(1).select(F.lit(also).alias("keyword"), F.lit(0).cast("long").alias("_run")))
    found = split_hot_join(offered, filed, "_run", counts, spread_by=text, salts=salts, always=None if also is None else 0)
    fits = F.col(text).contains(F.col("keyword")) | (F.col("_run") == 0)
    return found.where(fits).select(*df.columns, "keyword")


def dimension_lookup(fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Fact rows with the columns of their dimension row."""
    return fact.join(dimension, F.col(fact_key) == F.col(dimension_key))


def exists_semi(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``other``."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_semi")


def drop_stopwords(tokens: DataFrame, stopwords: DataFrame, token: str = "token") -> DataFrame:
    """Token rows whose token is not in the ``word`` column of a stopword table."""
    return tokens.join(stopwords, F.col(token) == F.col("word"), "left_anti")


def align_groups(values: DataFrame, group: str, first: str, second: str, item: str, value: str) -> DataFrame:
    """Two groups' values side by side per item: one conditional aggregate, no self-join."""
    return (
        values.where(F.col(group).isin(first, second)).groupBy(item)
        .agg(
            F.max(F.when(F.col(group) == first, F.col(value))).alias("first_value"),
            F.max(F.when(F.col(group) == second, F.col(value))).alias("second_value"),
        )
        .where(F.col("first_value").isNotNull() & F.col("second_value").isNotNull())
        .orderBy(F.desc("first_value"), item)
    )
