"""Keyword, month and sentiment measures over a sentence table.

The sentence table has ``brand, sentence, sentiment_label ('1'/'0'/other),
sentiment_score, like_count, commented_at``. Measures over a keyword list are
conditional aggregates: one pass over the sentences with map-side combine, and
nothing is multiplied by the number of keywords before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrain.functions import values as vl

# Scores are summed as whole millionths.
UNITS = 1_000_000


def _flagged(df: DataFrame, keywords: Sequence[str], keep: Sequence[str | Column], text: str, regex: bool) -> DataFrame:
    """The kept columns plus one boolean per keyword, so each test runs once."""
    return df.select(
        *keep, *[vl.contains(F.col(text), k, regex).alias(f"_has{i}") for i, k in enumerate(keywords)]
    )


def unstacked(df: DataFrame, keywords: Sequence[str], group: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Columns ``_<field><i>`` to one row per keyword."""
    cells = [
        F.struct(F.lit(k).alias("keyword"), *[F.col(f"_{f}{i}").alias(f) for f in fields])
        for i, k in enumerate(keywords)
    ]
    return df.select(*group, *[c for c in df.columns if not c.startswith("_") and c not in group],
                     F.inline(F.array(*cells)))


def total_of(prefix: str, n: int) -> Column:
    return reduce(lambda a, b: a + b, [F.col(f"_{prefix}{i}") for i in range(n)])


def keyword_counts(df: DataFrame, keywords: Sequence[str], group: Sequence[str] = ("brand",),
                   text: str = "sentence", regex: bool = False) -> DataFrame:
    """Sentences containing each keyword, with the total over all keywords."""
    flags = _flagged(df, keywords, group, text, regex)
    counts = flags.groupBy(*group).agg(*[F.count_if(f"_has{i}").alias(f"_n{i}") for i in range(len(keywords))])
    return unstacked(counts.withColumn("total", total_of("n", len(keywords))), keywords, group, ["n"])


def keyword_doc_counts(df: DataFrame, keywords: Sequence[str], group: Sequence[str] = ("brand",),
                       text: str = "sentence") -> DataFrame:
    """Sentences containing each keyword; keywords without a hit are absent."""
    return keyword_counts(df, keywords, group, text).where("n > 0").select(*group, "keyword", "n")


def keyword_percentage(df: DataFrame, keywords: Sequence[str], group: Sequence[str] = ("brand",),
                       text: str = "sentence") -> DataFrame:
    """Each keyword's share in per cent of all keyword hits of its group; 0 without hits."""
    return keyword_counts(df, keywords, group, text).select(
        *group, "keyword", vl.safe_ratio(F.col("n"), F.col("total"), 2, 100).alias("pct")
    )


def month_counts(df: DataFrame, keywords: Sequence[str], text: str = "sentence", regex: bool = False) -> DataFrame:
    """Per brand and month: hits ``_n<i>``, positive ``_p<i>`` and negative ``_m<i>`` ones, and their ``total``.

    Rows are grouped by the first day of the month; the label is made of the result.
    """
    n = range(len(keywords))
    flags = _flagged(df, keywords, ["brand", vl.month_start(F.col("commented_at")).alias("month"), "sentiment_label"], text, regex)
    counts = flags.groupBy("brand", "month").agg(
        *[F.count_if(f"_has{i}").alias(f"_n{i}") for i in n],
        *[F.count_if(F.col(f"_has{i}") & (F.col("sentiment_label") == "1")).alias(f"_p{i}") for i in n],
        *[F.count_if(F.col(f"_has{i}") & (F.col("sentiment_label") == "0")).alias(f"_m{i}") for i in n],
    )
    return counts.withColumns({"month": vl.month_label(F.col("month")), "total": total_of("n", len(keywords))})


def keyword_month_trend(df: DataFrame, keywords: Sequence[str], text: str = "sentence", regex: bool = False) -> DataFrame:
    """Per month: keyword share of all hits, and positive and negative share of its own hits.

    Months and keywords without a hit are absent.
    """
    cells = unstacked(month_counts(df, keywords, text, regex), keywords, ["brand", "month"], ["n", "p", "m"])
    return cells.where("n > 0").select(
        "brand", "month", "keyword",
        vl.safe_ratio(F.col("n"), F.col("total"), 4).alias("ratio"),
        vl.safe_ratio(F.col("p"), F.col("n"), 4).alias("pos_ratio"),
        vl.safe_ratio(F.col("m"), F.col("n"), 4).alias("neg_ratio"),
    )


def month_share(df: DataFrame, keywords: Sequence[str], text: str = "sentence") -> DataFrame:
    """A keyword's share of its month's hits, by a window over the counted cells."""
    cells = unstacked(month_counts(df, keywords, text), keywords, ["brand", "month"], ["n"]).where("n > 0")
    whole = F.sum("n").over(Window.partitionBy("brand", "month"))
    return cells.select("brand", "month", "keyword", "n", vl.safe_ratio(F.col("n"), whole, 4).alias("share"))


def keyword_occurrence_rate(df: DataFrame, keywords: Sequence[str], text: str = "sentence", digits: int = 6) -> DataFrame:
    """Per month: occurrences of the keyword per sentence holding any keyword; may exceed 1.

    Occurrences are counted inside each sentence, so a keyword with a space is
    not found across two sentences.
    """
    n = len(keywords)
    hits = df.where(vl.contains_any(F.col(text), keywords)).select(
        "brand", vl.month_start(F.col("commented_at")).alias("month"),
        *[vl.occurrence_count(F.col(text), k).alias(f"_has{i}") for i, k in enumerate(keywords)],
    )
    months = hits.groupBy("brand", "month").agg(
        F.count(F.lit(1)).alias("sentences"), *[F.sum(f"_has{i}").alias(f"_n{i}") for i in range(n)]
    )
    return unstacked(months, keywords, ["brand", "month"], ["n"]).select(
        "brand", vl.month_label(F.col("month")).alias("month"), "keyword",
        vl.safe_ratio(F.col("n"), F.col("sentences"), digits).alias("rate"),
    )


def sentiment_sums(df: DataFrame, keywords: Sequence[str], group: Sequence[str] = ("brand",),
                   text: str = "sentence", regex: bool = False) -> DataFrame:
    """Per group: label counts, and per keyword hits and score sums by label.

    Sums are of whole units, so the result does not depend on the order in
    which tasks finish.
    """
    n = range(len(keywords))
    flags = _flagged(df, keywords, [*group, "sentiment_label", vl.in_units(F.col("sentiment_score"), UNITS).alias("_score")], text, regex)

    def with_label(i: int, label: str) -> Column:
        return F.col(f"_has{i}") & (F.col("sentiment_label") == label) & F.col("_score").isNotNull()

    return flags.groupBy(*group).agg(
        F.count_if(F.col("sentiment_label") == "1").alias("positive"),
        F.count_if(F.col("sentiment_label") == "0").alias("negative"),
        *[F.count_if(f"_has{i}").alias(f"_n{i}") for i in n],
        *[a for i in n for s, label in (("p", "1"), ("m", "0")) for a in (
            F.sum(F.when(with_label(i, label), F.col("_score"))).alias(f"_{s}sum{i}"),
            F.count_if(with_label(i, label)).alias(f"_{s}n{i}"),
        )],
    )


def mean_score(total: Column, count: Column) -> Column:
    """Mean of a score sum in units; 0 where nothing was summed."""
    return F.coalesce(vl.mean_of_units(total, count, UNITS, 4), F.lit(0.0))


def keyword_sentiment_score(df: DataFrame, keywords: Sequence[str], group: Sequence[str] = ("brand",),
                            text: str = "sentence", regex: bool = False) -> DataFrame:
    """Mean score of positive and of negative sentences per keyword; 0 for a missing label.

    A keyword without any sentence is absent.
    """
    sums = sentiment_sums(df, keywords, group, text, regex)
    cells = unstacked(sums, keywords, group, ["n", "psum", "pn", "msum", "mn"]).where("n > 0")
    return cells.select(
        *group, "keyword",
        mean_score(F.col("psum"), F.col("pn")).alias("pos"), mean_score(F.col("msum"), F.col("mn")).alias("neg"),
    )


def overall_sentiment_ratio(df: DataFrame, group: Sequence[str] = ("brand",)) -> DataFrame:
    """Positive and negative share of the sentences with one of the two labels."""
    counts = df.where(F.col("sentiment_label").isin("1", "0")).groupBy(*group).agg(
        F.count_if(F.col("sentiment_label") == "1").alias("p"), F.count(F.lit(1)).alias("t")
    )
    return counts.select(
        *group,
        vl.safe_ratio(F.col("p"), F.col("t"), 4).alias("pos"),
        vl.safe_ratio(F.col("t") - F.col("p"), F.col("t"), 4).alias("neg"),
    )


def filtered_sentiment(df: DataFrame, keywords: Sequence[str], group: Sequence[str] = ("brand",), text: str = "sentence") -> DataFrame:
    """Label shares and mean scores of the sentences matching the keyword alternation."""
    kept = df.where(F.col(text).rlike("|".join(keywords))).where(F.col("sentiment_label").isin("1", "0"))
    score = vl.in_units(F.col("sentiment_score"), UNITS)
    positive = F.col("sentiment_label") == "1"
    sums = kept.groupBy(*group).agg(
        F.count(F.lit(1)).alias("t"), F.count_if(positive).alias("p"),
        F.sum(F.when(positive, score)).alias("ps"), F.sum(F.when(~positive, score)).alias("ms"),
    )
    return sums.select(
        *group,
        vl.safe_ratio(F.col("p"), F.col("t"), 4).alias("pos_ratio"),
        vl.safe_ratio(F.col("t") - F.col("p"), F.col("t"), 4).alias("neg_ratio"),
        mean_score(F.col("ps"), F.col("p")).alias("pos_mean"),
        mean_score(F.col("ms"), F.col("t") - F.col("p")).alias("neg_mean"),
    )


def group_mean_rating(df: DataFrame, item: str, rating: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Mean whole-number rating per brand derived from the item name; 0 for a listed brand without rows."""
    brand = vl.category_of(F.col(item), rules)
    means = df.select(brand.alias("brand"), F.col(rating).cast("long").alias("r")).where("brand IS NOT NULL") \
        .groupBy("brand").agg(F.sum("r").alias("s"), F.count("r").alias("n")) \
        .select("brand", vl.mean_of_units(F.col("s"), F.col("n"), 1, 2).alias("mean"))
    names = list(dict.fromkeys(label for _, label in rules))
    listed = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(b) for b in names])).alias("brand"))
    return listed.join(means, "brand", "left").select("brand", F.coalesce("mean", F.lit(0.0)).alias("mean_rating"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts per value combination, with their share of all rows."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    whole = df.agg(F.count(F.lit(1))).scalar()
    return counts.select(*columns, "n", vl.safe_ratio(F.col("n"), whole, 6).alias("share"))


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Row count after each named stage."""
    counts = [d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(s).alias("stage"), "n") for s, d in stages.items()]
    return reduce(lambda a, b: a.unionAll(b), counts)


def cohort_sum(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*group).agg(F.sum(value).alias("total"))
