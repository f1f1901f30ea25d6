"""Best rows per group, recent months, calendars and ordered lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrain import lexicons
from pulsegrain.functions import values as vl
from pulsegrain.operators import match

LABELS = {"1": "pos", "0": "neg"}


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their rank.

    Spark applies the rank limit in every task before the shuffle as well, so
    a hot group arrives as ``n`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(name, rank).where(F.col(name) <= n)


def top_comment(
    df: DataFrame, keywords: Sequence[str] | DataFrame, text: str = "sentence", key: str = "id",
    by_score: bool = True, first_match: bool = False, carry: Sequence[str] = (), regex: bool = False,
) -> DataFrame:
    """The best sentence per brand, keyword and label.

    Order: score (unless ``by_score`` is off), likes, then text and id.
    ``first_match`` files a sentence under its first listed keyword only.
    """
    labelled = df.where(F.col("sentiment_label").isin(*LABELS))
    if first_match:
        hits = labelled.withColumn("keyword", vl.first_match(F.col(text), keywords)).where("keyword IS NOT NULL")
    elif isinstance(keywords, DataFrame):
        hits = match.match_keyword_table(labelled, keywords, text)
    else:
        hits = match.match_keywords(labelled, text, keywords, regex)
    order = ([F.desc("sentiment_score")] if by_score else []) + [F.desc("like_count"), F.asc(text), F.asc(key)]
    best = top_per_group(hits, ["brand", "keyword", "sentiment_label"], order, 1)
    return best.select(
        "brand", "keyword", vl.mapped(F.col("sentiment_label"), LABELS).alias("sentiment"),
        F.col(text).alias("sentence"), "sentiment_score", "like_count", *carry,
    )


def top_comment_grid(df: DataFrame, brands: DataFrame, keywords: Sequence[str], text: str = "sentence", key: str = "id",
                     placeholder: str = lexicons.NO_COMMENT, regex: bool = False) -> DataFrame:
    """``top_comment`` over every listed brand, keyword and label; a placeholder where none fits."""
    best = top_comment(df, keywords, text, key, regex=regex).select("brand", "keyword", "sentiment", "sentence")
    grid = (
        brands.select("brand").distinct()
        .withColumn("keyword", F.explode(F.array(*[F.lit(k) for k in keywords])))
        .withColumn("sentiment", F.explode(F.array(*[F.lit(s) for s in LABELS.values()])))
    )
    return grid.join(best, ["brand", "keyword", "sentiment"], "left").fillna(placeholder, subset=["sentence"])


def recent_valid_months(trend: DataFrame, n: int = 6) -> DataFrame:
    """The newest ``n`` months per brand in which some keyword has a labelled share."""
    months = trend.where((F.col("pos_ratio") > 0) | (F.col("neg_ratio") > 0)).select("brand", "month").distinct()
    return top_per_group(months, ["brand"], [F.desc("month")], n)


def month_slice_percent(trend: DataFrame, nth_newest: int = 1, n: int = 6) -> DataFrame:
    """Label shares in per cent per keyword in the n-th newest valid month.

    Two windows over the trend rows, of which a brand has one per month and
    keyword, so the trend is computed once.
    """
    labelled = F.max((F.col("pos_ratio") > 0) | (F.col("neg_ratio") > 0)).over(Window.partitionBy("brand", "month"))
    newest = F.dense_rank().over(Window.partitionBy("brand").orderBy(F.desc("month")))
    valid = trend.withColumn("_valid", labelled).where("_valid").withColumn("_newest", newest)
    return valid.where((F.col("_newest") == nth_newest) & (F.col("_newest") <= n)).select(
        "brand", "month", "keyword",
        F.round(F.col("pos_ratio") * 100, 2).alias("pos_pct"),
        F.round(F.col("neg_ratio") * 100, 2).alias("neg_pct"),
    )


def calendar_percent(trend: DataFrame, brands: DataFrame, keywords: Sequence[str], as_of: str, months: int = 6) -> DataFrame:
    """Keyword shares in per cent for the months before ``as_of``, gaps as 0."""
    labels = [vl.month_of(as_of, back) for back in range(1, months + 1)]
    grid = (
        brands.select("brand").distinct()
        .withColumn("month", F.explode(F.array(*labels)))
        .withColumn("keyword", F.explode(F.array(*[F.lit(k) for k in keywords])))
    )
    return grid.join(trend, ["brand", "month", "keyword"], "left").select(
        "brand", "month", "keyword", F.round(F.coalesce("ratio", F.lit(0.0)) * 100, 2).alias("pct")
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], updated: str, tie: str) -> DataFrame:
    """The newest row per key."""
    return top_per_group(df, keys, [F.desc(updated), F.desc(tie)], 1).drop("rank")


def cohort_top(df: DataFrame, cohort: Sequence[str], item: str, n: int = 3, suffix: str = "위") -> DataFrame:
    """The most requested items per cohort with a rank label."""
    counts = df.groupBy(*cohort, item).agg(F.count(F.lit(1)).alias("n"))
    best = top_per_group(counts, cohort, [F.desc("n"), F.asc(item)], n)
    return best.withColumn("label", F.concat(F.col("rank").cast("string"), F.lit(suffix)))


def sorted_rows(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order)


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows: each task keeps n, so no full sort takes place."""
    return df.orderBy(*order).limit(n)


def head_tail(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first and the last ``n`` rows by a unique key."""
    head = df.orderBy(F.asc(key)).limit(n).withColumn("part", F.lit("head"))
    tail = df.orderBy(F.desc(key)).limit(n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def _stored_and_spare(stored: DataFrame, item: str, order: str, defaults: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` stored items (p = 0) and all defaults (p = 1), each with its place ``o``."""
    first = stored.groupBy(item).agg(F.min(order).cast("double").alias("o")).orderBy("o", item).limit(n)
    spare = stored.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(d) for d in defaults])).alias("o", "item"))
    return first.select(F.lit(0).alias("p"), "o", F.col(item).alias("item")).unionByName(
        spare.select(F.lit(1).alias("p"), F.col("o").cast("double").alias("o"), "item")
    )


def stored_or_default(stored: DataFrame, item: str, order: str, defaults: Sequence[str], n: int = 3) -> DataFrame:
    """The first ``n`` stored items if there are that many, else the defaults."""
    # At most n + len(defaults) rows.
    both = _stored_and_spare(stored, item, order, defaults, n)
    enough = F.count_if(F.col("p") == 0).over(Window.partitionBy()) >= n
    kept = both.withColumn("_enough", enough).where(F.col("_enough") == (F.col("p") == 0))
    return kept.select(F.row_number().over(Window.orderBy("o", "item")).alias("position"), "item")


def backfill_top(stored: DataFrame, item: str, order: str, defaults: Sequence[str], n: int = 9) -> DataFrame:
    """The first ``n`` stored items, topped up from the defaults without repeats."""
    both = _stored_and_spare(stored, item, order, defaults, n)
    # At most n + len(defaults) rows from here on.
    once = both.groupBy("item").agg(F.min(F.struct("p", "o")).alias("at"))
    position = F.row_number().over(Window.orderBy("at.p", "at.o", "item"))
    return once.select(position.alias("position"), "item").where(F.col("position") <= n)
