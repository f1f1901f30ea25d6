"""Keyword, sentiment and ranking measures."""

from pyspark.sql import functions as F

from pulsegrain import lexicons
from pulsegrain.functions import values as vl
from pulsegrain.operators import metrics, ranking, reshape, rows
from pulsegrain.registry.base import (
    BEST, GRID, HITS, KEYWORDS, OVERALL, REQUESTS, SCORES, SENTENCES, SHARE, SPACE, TREND, keyword_table, query, sql_any,
    sql_list, sql_text,
)
from pulsegrain.registry.reshaping import COHORT_TOP
from pulsegrain.sources import views

RATING_RULES = [("ring", "samsung"), ("gear", "apple"), ("no such item", "other")]


def _s(spark, sf):
    return views.sentences(spark, sf)


def _trend(spark, sf):
    return metrics.keyword_month_trend(_s(spark, sf), KEYWORDS)


@query("row_count", f"""SELECT 'raw' AS stage, count(*) AS n FROM documents
  UNION ALL SELECT 'distinct', count(*) FROM (SELECT DISTINCT text, lang FROM documents)
  UNION ALL SELECT 'not_latin', count(*) FROM (SELECT DISTINCT text, lang FROM documents) WHERE NOT regexp_full_match(text, '([a-zA-Z]|{SPACE})+')""")
def _(spark, sf):
    raw = views.table(spark, sf, "documents").select("text", "lang")
    distinct = rows.dedup_rows(raw)
    return metrics.stage_counts({"raw": raw, "distinct": distinct, "not_latin": rows.drop_latin_only(distinct, "text")})


@query("keyword_doc_counts", f"WITH {HITS} SELECT brand, keyword, count(*) AS n FROM hits GROUP BY ALL")
def _(spark, sf):
    return metrics.keyword_doc_counts(_s(spark, sf), KEYWORDS)


@query("keyword_percentage", f"WITH {SHARE} SELECT * FROM share")
def _(spark, sf):
    return metrics.keyword_percentage(_s(spark, sf), KEYWORDS)


@query("keyword_month_trend", f"WITH {TREND} SELECT * FROM trend")
def _(spark, sf):
    return _trend(spark, sf)


@query("keyword_occurrence_rate", f"""WITH {SENTENCES}, {keyword_table(KEYWORDS)},
f AS (SELECT brand, strftime(commented_at, '%Y-%m') AS month, sentence FROM sentences WHERE {sql_any('sentence', KEYWORDS)})
SELECT brand, month, keyword, round(sum((length(sentence) - length(replace(sentence, keyword, ''))) // length(keyword)) / count(*), 6) AS rate
FROM f CROSS JOIN keywords GROUP BY ALL""")
def _(spark, sf):
    return metrics.keyword_occurrence_rate(_s(spark, sf), KEYWORDS)


@query("keyword_sentiment_score", f"WITH {SCORES} SELECT * FROM scores")
def _(spark, sf):
    return metrics.keyword_sentiment_score(_s(spark, sf), KEYWORDS)


@query("overall_sentiment_ratio", f"WITH {SENTENCES}, {OVERALL} SELECT * FROM overall")
def _(spark, sf):
    return metrics.overall_sentiment_ratio(_s(spark, sf))


@query("filtered_sentiment_ratio", f"""WITH {SENTENCES}
SELECT brand, round(p / t, 4) AS pos_ratio, round((t - p) / t, 4) AS neg_ratio,
       coalesce(round(ps / p, 4), 0.0) AS pos_mean, coalesce(round(ms / (t - p), 4), 0.0) AS neg_mean FROM (
  SELECT brand, count(*) AS t, count(*) FILTER (sentiment_label = '1') AS p,
         CAST(sum(CAST(sentiment_score AS DECIMAL(18,6))) FILTER (sentiment_label = '1') AS DOUBLE) AS ps,
         CAST(sum(CAST(sentiment_score AS DECIMAL(18,6))) FILTER (sentiment_label = '0') AS DOUBLE) AS ms
  FROM sentences WHERE regexp_matches(sentence, '{"|".join(KEYWORDS)}') AND sentiment_label IN ('1', '0') GROUP BY brand)""")
def _(spark, sf):
    return metrics.filtered_sentiment(_s(spark, sf), KEYWORDS)


@query("group_mean_rating", """WITH r AS (SELECT CASE WHEN contains(p_name, 'ring') THEN 'samsung' WHEN contains(p_name, 'gear') THEN 'apple' END AS brand,
  p_size AS rating FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT b.brand, coalesce(round(sum(rating) / count(rating), 2), 0.0) AS mean_rating
FROM (SELECT unnest(['samsung', 'apple', 'other']) AS brand) b LEFT JOIN r ON r.brand = b.brand GROUP BY b.brand""")
def _(spark, sf):
    return metrics.group_mean_rating(views.reviews(spark, sf), "item_name", "rating", RATING_RULES)


@query("value_counts", f"WITH {SENTENCES} SELECT brand, sentiment_label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM sentences GROUP BY ALL")
def _(spark, sf):
    return metrics.value_counts(_s(spark, sf), ["brand", "sentiment_label"])


@query("group_size", f"WITH {HITS} SELECT month, keyword, sentiment_label, count(*) AS n FROM hits GROUP BY ALL")
def _(spark, sf):
    s = _s(spark, sf).withColumn("month", vl.month_label(F.col("commented_at")))
    flags = reshape.unpivot_flags(s, "sentence", KEYWORDS, ["month", "sentiment_label"])
    return flags.groupBy("month", "keyword", "sentiment_label").agg(F.count(F.lit(1)).alias("n"))


@query("cohort_sum", f"WITH {REQUESTS} SELECT age_group, gender, hobby, CAST(sum(1) AS BIGINT) AS total FROM requests GROUP BY ALL")
def _(spark, sf):
    return metrics.cohort_sum(views.requests(spark, sf).withColumn("count", F.lit(1)), ["age_group", "gender", "hobby"], "count")


# -- windows

@query("top_comment", f"""WITH {HITS}, {BEST}, {GRID}
SELECT brand, keyword, sentiment, coalesce(sentence, {sql_text(lexicons.NO_COMMENT)}) AS sentence FROM grid LEFT JOIN best USING (brand, keyword, sentiment)""")
def _(spark, sf):
    return ranking.top_comment_grid(_s(spark, sf), views.brands(spark, sf), KEYWORDS)


@query("top_liked_comment", f"""WITH {SENTENCES}, f AS (SELECT *, list_filter({sql_list(KEYWORDS)}, lambda k: contains(sentence, k))[1] AS keyword FROM sentences
  WHERE sentiment_label IN ('1', '0'))
SELECT brand, keyword, CASE sentiment_label WHEN '1' THEN 'pos' ELSE 'neg' END AS sentiment, sentence, like_count FROM f WHERE keyword IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY brand, keyword, sentiment_label ORDER BY like_count DESC, sentence, id) = 1""")
def _(spark, sf):
    best = ranking.top_comment(_s(spark, sf), KEYWORDS, by_score=False, first_match=True)
    return best.select("brand", "keyword", "sentiment", "sentence", "like_count")


@query("top_comment_with_source", f"""WITH {HITS}, {BEST} SELECT brand, keyword, sentiment, sentence,
  round(sentiment_score, 4) AS score, like_count, order_id FROM best""")
def _(spark, sf):
    best = ranking.top_comment(_s(spark, sf), KEYWORDS, carry=["order_id"])
    return best.select("brand", "keyword", "sentiment", "sentence", F.round("sentiment_score", 4).alias("score"), "like_count", "order_id")


@query("month_share", f"WITH {TREND} SELECT brand, month, keyword, n, round(n / sum(n) OVER (PARTITION BY brand, month), 4) AS share FROM cells")
def _(spark, sf):
    return metrics.month_share(_s(spark, sf), KEYWORDS)


RECENT = """recent AS (SELECT brand, month, CAST(row_number() OVER (PARTITION BY brand ORDER BY month DESC) AS INTEGER) AS rank
  FROM (SELECT DISTINCT brand, month FROM trend WHERE pos_ratio > 0 OR neg_ratio > 0))"""


@query("recent_valid_months", f"WITH {TREND}, {RECENT} SELECT * FROM recent WHERE rank <= 6")
def _(spark, sf):
    return ranking.recent_valid_months(_trend(spark, sf))


@query("month_slice_percent", f"""WITH {TREND}, {RECENT} SELECT brand, month, keyword, round(pos_ratio * 100, 2) AS pos_pct,
  round(neg_ratio * 100, 2) AS neg_pct FROM trend JOIN (SELECT brand, month FROM recent WHERE rank = 1) USING (brand, month)""")
def _(spark, sf):
    return ranking.month_slice_percent(_trend(spark, sf))


@query("top3_per_cohort", f"WITH {COHORT_TOP} SELECT age_group, gender, hobby, n, CAST(rank AS INTEGER) AS rank, label FROM top")
def _(spark, sf):
    return ranking.cohort_top(views.requests(spark, sf), ["age_group", "gender"], "hobby")
