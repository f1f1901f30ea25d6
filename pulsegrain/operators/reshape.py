"""Splitting, unpivoting, pivoting and nesting."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain.functions import text as tx
from pulsegrain.functions import values as vl


def explode_sentences(
    df: DataFrame, text: str, name: str = "sentence", position: str = "pos", each: Callable[[Column], Column] | None = None
) -> DataFrame:
    """One row per sentence, positions from 0, the other columns carried along.

    ``each`` is applied to the sentences before they become rows, so that later
    filters on the result do not compute it again.
    """
    rest = [c for c in df.columns if c not in (text, name, position)]
    sentences = tx.sentences_of(F.col(text))
    if each is not None:
        sentences = F.transform(sentences, each)
    return df.select(*rest, F.posexplode(sentences).alias(position, name))


def explode_lines(df: DataFrame, text: str, name: str = "line", position: str = "pos") -> DataFrame:
    """One row per non-blank line, positions from 0."""
    rest = [c for c in df.columns if c not in (text, name, position)]
    return df.select(*rest, F.posexplode(tx.lines_of(F.col(text))).alias(position, name))


def flatten_children(df: DataFrame, children: str, fields: Sequence[str]) -> DataFrame:
    """One row per child struct with the parent's columns."""
    parent = [c for c in df.columns if c != children]
    return df.select(*parent, F.explode(children).alias("_child")).select(
        *parent, *[F.col(f"_child.{f}").alias(f) for f in fields]
    )


def zip_explode(df: DataFrame, arrays: Sequence[str], position: str = "pos") -> DataFrame:
    """Parallel arrays to rows, cut to the shortest array; positions from 0."""
    rest = [c for c in df.columns if c not in arrays]
    shortest = F.least(*[F.size(a) for a in arrays]) if len(arrays) > 1 else F.size(arrays[0])
    cut = df.select(*rest, *[F.slice(a, F.lit(1), F.greatest(shortest, F.lit(0))).alias(a) for a in arrays])
    return cut.select(*rest, F.posexplode(F.arrays_zip(*arrays)).alias(position, "_z")).select(
        *rest, position, *[F.col(f"_z.{a}").alias(a) for a in arrays]
    )


def unpivot_flags(df: DataFrame, text: str, keywords: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per kept column set and keyword present in the text."""
    flags = df.select(*keep, *[F.col(text).contains(k).alias(k) for k in keywords])
    return flags.unpivot(list(keep), list(keywords), "keyword", "is_present").where("is_present")


def pivot_label_counts(
    df: DataFrame, group: Sequence[str], label: str, positive: object = "1", negative: object = "0"
) -> DataFrame:
    """Label values to columns, with total and shares (0 where the total is 0)."""
    counts = (
        df.where(F.col(label).isin(positive, negative)).groupBy(*group)
        .pivot(label, [negative, positive]).agg(F.count(F.lit(1)))
        .withColumnsRenamed({str(negative): "negative_count", str(positive): "positive_count"})
        .fillna(0, subset=["negative_count", "positive_count"])
        .withColumn("total", F.col("negative_count") + F.col("positive_count"))
    )
    return counts.withColumns({
        "positive_ratio": vl.safe_ratio(F.col("positive_count"), F.col("total"), 6),
        "negative_ratio": vl.safe_ratio(F.col("negative_count"), F.col("total"), 6),
    })


def rank_matrix(
    df: DataFrame, item: str, cohort: str, label: str, cohorts: Sequence[str]
) -> DataFrame:
    """Items as rows, listed cohorts as columns, rank labels in the cells, '' where absent."""
    return df.groupBy(item).pivot(cohort, list(cohorts)).agg(F.min(label)).fillna("", subset=list(cohorts))


def wide_from_long(
    df: DataFrame, row: Sequence[str], column: str, value: str, columns: Sequence[str]
) -> DataFrame:
    """Long to wide over a fixed column list, missing cells 0."""
    return df.groupBy(*row).pivot(column, list(columns)).agg(F.sum(value)).fillna(0, subset=list(columns))


def parse_numbered_list(df: DataFrame, text: str) -> DataFrame:
    """"1. name - reason" lines to (pos, name, reason).

    The number is optional; without exactly one " - " the whole line is the
    name and the reason is ''.
    """
    lines = explode_lines(df, text, "_line")
    body = F.element_at(F.split("_line", r"\. ", 2), -1)
    parts = F.split(body, " - ")
    paired = F.size(parts) == 2
    rest = [c for c in lines.columns if c != "_line"]
    return lines.select(
        *rest,
        tx.strip_whitespace(F.when(paired, parts[0]).otherwise(body)).alias("name"),
        F.when(paired, tx.strip_whitespace(F.get(parts, F.lit(1)))).otherwise(F.lit("")).alias("reason"),
    )


def edge_list(df: DataFrame, center: Column, term: str, score: str, rank: str | Column, highlight: int = 5) -> DataFrame:
    """Edges centre -> term with a drawing size in [50, 150] and the top few marked."""
    position = F.col(rank) if isinstance(rank, str) else rank
    return df.select(
        center.alias("center"),
        F.col(term).alias("term"),
        F.col(score).cast("double").alias("weight"),
        F.greatest(F.lit(50.0), F.least(F.col(score) * 3.0, F.lit(150.0))).alias("size"),
        (position <= highlight).alias("highlighted"),
    )


def nested_trend(trend: DataFrame) -> DataFrame:
    """Rows (brand, month, keyword, ratios) to one JSON text per brand.

    A month holds one entry per keyword and a brand one per calendar month, so
    the collected lists stay small however many sentences stand behind them.
    """
    cell = F.struct("ratio", "pos_ratio", "neg_ratio")
    months = trend.groupBy("brand", "month").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("keyword", cell)))).alias("by_keyword")
    )
    brands = months.groupBy("brand").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("month", F.to_json("by_keyword"))))).alias("m")
    )
    parts = F.transform(F.map_entries("m"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"]))
    return brands.select("brand", F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")).alias("trend"))
