"""Filters, projections, validation, deduplication and unions of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrain.functions import text as tx
from pulsegrain.functions import values as vl


def rename_by_mapping(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns under their new names."""
    return df.select([F.col(old).alias(new) for old, new in mapping.items()])


def fill_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns) if columns else None)


def drop_latin_only(df: DataFrame, text: str) -> DataFrame:
    """Drop rows whose whole text is ASCII letters and whitespace; NULL stays."""
    return df.where(~F.coalesce(tx.is_latin_only(F.col(text)), F.lit(False)))


def drop_blank(df: DataFrame, text: str) -> DataFrame:
    return df.where(~F.coalesce(tx.is_blank(F.col(text)), F.lit(False)))


def keep_any_keyword(df: DataFrame, text: str, terms: Sequence[str]) -> DataFrame:
    return df.where(vl.contains_any(F.col(text), terms))


def keep_regex(df: DataFrame, text: str, terms: Sequence[str]) -> DataFrame:
    """Keep rows matching the regex alternation of ``terms``."""
    return df.where(F.col(text).rlike("|".join(terms)))


def tag_first_keyword(df: DataFrame, text: str, terms: Sequence[str]) -> DataFrame:
    """Add the first listed term found in the text; drop rows without one."""
    return keep_any_keyword(df, text, terms).withColumn("keyword", vl.first_match(F.col(text), terms))


def lexicon_hits(df: DataFrame, text: str, lexicons: Mapping[str, Sequence[str]]) -> DataFrame:
    """One hit-count column per lexicon; rows without any hit are dropped before counting."""
    kept = keep_any_keyword(df, text, [t for terms in lexicons.values() for t in terms])
    return kept.withColumns({f"{n}_hits": vl.occurrence_total(F.col(text), t) for n, t in lexicons.items()})


def check_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``errors``, the sorted names of the rules a row breaks, and ``valid``.

    A rule that gives NULL counts as broken.
    """
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in sorted(rules.items())]
    return df.withColumn("errors", F.array_compact(F.array(*broken))).withColumn("valid", F.size("errors") == 0)


def count_duplicates(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one in every column."""
    return (
        df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    )


def dedup_rows(df: DataFrame) -> DataFrame:
    """One copy of each row; copies meet in the map-side aggregate first."""
    return df.distinct()


def dedup_subset(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The best row per key under ``order``.

    The rank filter lets Spark cut each task to one row per key before the
    shuffle, so a hot key moves one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def union_frames(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
