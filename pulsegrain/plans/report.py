"""The report: keyword shares and trends, sentiment, related terms, recommendations.

All steps read one stored table of enriched comments, whose ``content`` holds the
sentences of a comment that share brand, label and score, one a line. Requests
are a table, and any number of them is answered at once: the sentences are
matched once against the keywords of all requests, the counted cells are stored,
and requests meet only those. Each step gives one JSON object per request, which
is merged into the request's stored result (``files.merge_results``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrain import lexicons
from pulsegrain.functions import values as vl
from pulsegrain.operators import match, metrics, ranking, reshape, terms, vectors
from pulsegrain.session import written
from pulsegrain.sources import files

#: The keyword of a sentence as such: its cells hold the counts of all sentences.
ANY = ""

STEP_FIELDS = "keyword_share map<string,map<string,double>>, " \
    "keyword_trend map<string,map<string,map<string,struct<ratio:double,pos_ratio:double,neg_ratio:double>>>>, " \
    "overall map<string,struct<pos:double,neg:double>>, " \
    "sentiment map<string,map<string,struct<pos:double,neg:double>>>, " \
    "comments map<string,map<string,map<string,string>>>"


def as_comments(sentences: DataFrame, key: str, carry: Sequence[str]) -> DataFrame:
    """Enriched sentences as they are stored: one row per comment, brand, label and score, its sentences line by line."""
    group = [key, *carry, "brand", "sentiment_label", "sentiment_score"]
    # The lines of one comment.
    lines = F.transform(F.array_sort(F.collect_list(F.struct("pos", "sentence"))), lambda e: e["sentence"])
    return sentences.groupBy(*group).agg(F.array_join(lines, "\n").alias("content"))


def keyword_cells(comments: DataFrame, requests: DataFrame, key: str = "id", text: str = "content") -> DataFrame:
    """Counts per keyword, brand, month and label, out of one scan of the stored comments.

    Columns: keyword, brand, month (null without a date), sentiment_label, n,
    units and scored (sum and number of the scores), best (the sentence with the
    highest score, most likes, first by text and id, under negated score and likes). The cells of the keyword
    ANY count every sentence. ``requests`` has an array column ``keywords``.
    """
    lines = reshape.explode_lines(comments, text, "sentence").select(
        "brand", "sentiment_label", vl.month_label(vl.month_start(F.col("commented_at"))).alias("month"),
        vl.in_units(F.col("sentiment_score"), metrics.UNITS).alias("_units"), "sentiment_score", "like_count", "sentence", key,
    )
    wanted = requests.select(F.explode("keywords").alias("keyword")).where(F.col("keyword") != ANY)
    hits = match.match_keyword_table(lines, wanted, "sentence", also=ANY)
    order = F.struct((-F.col("sentiment_score")).alias("score"), (-F.col("like_count")).alias("likes"), "sentence", F.col(key).alias("id"))
    return hits.groupBy("keyword", "brand", "month", "sentiment_label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_units").alias("units"), F.count("_units").alias("scored"), F.min(order).alias("best"),
    )


def cell_sums(cells: DataFrame) -> DataFrame:
    """The cells added up per keyword and brand, and within those per month and per label, by grouping sets.

    ``level`` is 'brand', 'month' or 'label'; ``p`` and ``m`` count the positive and negative sentences.
    """
    base = ["keyword", "brand"]
    label = F.col("sentiment_label")
    sums = cells.withColumn("_label", label).groupingSets(
        [base, [*base, "month"], [*base, "sentiment_label"]], "keyword", "brand", "month", "sentiment_label",
    ).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("_label") == "1", F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("_label") == "0", F.col("n")).otherwise(0)).alias("m"),
        F.sum("units").alias("units"), F.sum("scored").alias("scored"), F.min("best").alias("best"),
        F.grouping_id().alias("_level"),
    )
    level = F.when(F.col("_level") == 3, "brand").when(F.col("_level") == 1, "month").otherwise("label")
    return sums.withColumn("level", level).withColumn("best", F.col("best.sentence")).drop("_level")


def _nested(rows: DataFrame, keys: Sequence[str], value: Column, name: str, request: str) -> DataFrame:
    """Rows to one JSON object per request, nested by ``keys`` in turn."""
    def by_key(a: Column, b: Column) -> Column:
        return F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)

    now = rows.select(request, *keys, value.alias("_v"))
    for depth in range(len(keys) - 1, -1, -1):
        outer = [request, *keys[:depth]]
        # Entries of one level: brands, months or the keywords of a request.
        entries = F.array_sort(F.collect_list(F.struct(F.col(keys[depth]).alias("key"), F.col("_v").alias("value"))), by_key)
        now = now.groupBy(*outer).agg(F.map_from_entries(entries).alias("_v"))
    return now.select(request, F.to_json(F.struct(F.col("_v").alias(name))).alias("result"))


def _wanted(requests: DataFrame, request: str) -> DataFrame:
    return requests.select(request, F.explode(F.array_distinct("keywords")).alias("keyword"))


def keyword_shares(sums: DataFrame, requests: DataFrame, request: str = "request_id") -> DataFrame:
    """Per request and brand each keyword's share in per cent of the hits of the request's keywords; 0 without hits."""
    counts = sums.where("level = 'brand'")
    brands = counts.where(F.col("keyword") == ANY).select("brand")
    # A few brands for every request.
    grid = _wanted(requests, request).withColumn("_one", F.lit(1)).join(F.broadcast(brands.withColumn("_one", F.lit(1))), "_one")
    found = grid.join(counts.select("keyword", "brand", "n"), ["keyword", "brand"], "left").fillna(0, ["n"])
    whole = F.sum("n").over(Window.partitionBy(request, "brand"))
    return found.select(request, "brand", "keyword", vl.safe_ratio(F.col("n"), whole, 2, 100).alias("pct"))


def keyword_trends(sums: DataFrame, requests: DataFrame, request: str = "request_id") -> DataFrame:
    """Per request, brand and month each keyword's share of the hits, and the positive and negative share of its own."""
    months = sums.where((F.col("level") == "month") & F.col("month").isNotNull())
    whole = F.sum("n").over(Window.partitionBy(request, "brand", "month"))
    return _wanted(requests, request).join(months, "keyword").select(
        request, "brand", "month", "keyword",
        vl.safe_ratio(F.col("n"), whole, 4).alias("ratio"),
        vl.safe_ratio(F.col("p"), F.col("n"), 4).alias("pos_ratio"),
        vl.safe_ratio(F.col("m"), F.col("n"), 4).alias("neg_ratio"),
    )


def request_trends(comments: DataFrame, requests: DataFrame, request: str = "request_id", key: str = "id", text: str = "content") -> DataFrame:
    """The monthly trend of every request, whatever the number of requests and keywords."""
    return keyword_trends(cell_sums(written(keyword_cells(comments, requests, key, text), "cells")), requests, request)


def report_keywords(sums: DataFrame, requests: DataFrame, request: str = "request_id") -> list[DataFrame]:
    """Step 1 as JSON per request: shares per brand, trends per brand and month."""
    cell = F.struct("ratio", "pos_ratio", "neg_ratio")
    return [
        _nested(keyword_shares(sums, requests, request), ["brand", "keyword"], F.col("pct"), "keyword_share", request),
        _nested(keyword_trends(sums, requests, request), ["brand", "month", "keyword"], cell, "keyword_trend", request),
    ]


def keyword_scores(sums: DataFrame, requests: DataFrame, request: str = "request_id") -> DataFrame:
    """Per request, brand and keyword the mean score of positive and negative sentences; keywords without a sentence are absent."""
    labels = sums.where("level = 'label'")

    def mean(label: str) -> Column:
        mine = F.col("sentiment_label") == label
        return metrics.mean_score(F.sum(F.when(mine, F.col("units"))), F.sum(F.when(mine, F.col("scored"))))

    scores = labels.groupBy("keyword", "brand").agg(mean("1").alias("pos"), mean("0").alias("neg"))
    return _wanted(requests, request).join(scores, "keyword").select(request, "brand", "keyword", "pos", "neg")


def overall_ratios(sums: DataFrame) -> DataFrame:
    """Positive and negative share of a brand's labelled sentences."""
    whole = F.col("p") + F.col("m")
    return sums.where((F.col("level") == "brand") & (F.col("keyword") == ANY) & (whole > 0)).select(
        "brand", vl.safe_ratio(F.col("p"), whole, 4).alias("pos"), vl.safe_ratio(F.col("m"), whole, 4).alias("neg"))


def best_comments(sums: DataFrame, requests: DataFrame, request: str = "request_id", placeholder: str = lexicons.NO_COMMENT) -> DataFrame:
    """Per request, brand and keyword the best positive and negative sentence; a placeholder where there is none."""
    labels = sums.where(F.col("level") == "label")
    brands = sums.where((F.col("level") == "brand") & (F.col("keyword") == ANY)).select("brand")
    sides = F.explode(F.array(F.struct(F.lit("1").alias("sentiment_label"), F.lit("pos").alias("sentiment")),
                              F.struct(F.lit("0").alias("sentiment_label"), F.lit("neg").alias("sentiment")))).alias("s")
    grid = _wanted(requests, request).withColumn("_one", F.lit(1)).join(F.broadcast(brands.withColumn("_one", F.lit(1))), "_one") \
        .select(request, "brand", "keyword", sides).select(request, "brand", "keyword", "s.*")
    found = grid.join(labels.select("keyword", "brand", "sentiment_label", "best"), ["keyword", "brand", "sentiment_label"], "left")
    return found.select(request, "brand", "keyword", "sentiment", F.coalesce("best", F.lit(placeholder)).alias("sentence"))


def report_sentiment(sums: DataFrame, requests: DataFrame, request: str = "request_id") -> list[DataFrame]:
    """Step 2 as JSON per request: overall shares, keyword scores and the best sentence per cell."""
    pair = F.struct("pos", "neg")
    overall = requests.select(request).withColumn("_one", F.lit(1)).join(F.broadcast(overall_ratios(sums).withColumn("_one", F.lit(1))), "_one")
    return [
        _nested(overall, ["brand"], pair, "overall", request),
        _nested(keyword_scores(sums, requests, request), ["brand", "keyword"], pair, "sentiment", request),
        _nested(best_comments(sums, requests, request), ["brand", "keyword", "sentiment"], F.col("sentence"), "comments", request),
    ]


def step_rows(results: DataFrame, request: str = "request_id", json: str = "result") -> DataFrame:
    """Stored results back to rows (request, section, brand, month, keyword, metric, value, sentence); unused cells are ''."""
    told = results.select(request, F.from_json(json, STEP_FIELDS).alias("r"))

    def level(df: DataFrame, column: str, name: str) -> DataFrame:
        rest = [c for c in df.columns if c != column]
        return df.select(*rest, F.explode(column).alias(name, "v"))

    def out(df: DataFrame, section: str, metric: Column, value: Column, sentence: Column | None = None) -> DataFrame:
        def cell(name: str) -> Column:
            return F.col(name) if name in df.columns else F.lit("").alias(name)
        return df.select(request, F.lit(section).alias("section"), cell("brand"), cell("month"), cell("keyword"), metric.alias("metric"),
                         value.alias("value"), (F.lit("") if sentence is None else sentence).alias("sentence"))

    def fields(df: DataFrame, section: str, names: Sequence[str]) -> DataFrame:
        cells = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col("v")[n].alias("value")) for n in names])).alias("c")
        return out(df.select("*", cells), section, F.col("c.metric"), F.col("c.value"))

    share = level(level(told.select(request, F.col("r.keyword_share").alias("v")), "v", "brand"), "v", "keyword")
    trend = level(level(level(told.select(request, F.col("r.keyword_trend").alias("v")), "v", "brand"), "v", "month"), "v", "keyword")
    overall = level(told.select(request, F.col("r.overall").alias("v")), "v", "brand")
    score = level(level(told.select(request, F.col("r.sentiment").alias("v")), "v", "brand"), "v", "keyword")
    best = level(level(level(told.select(request, F.col("r.comments").alias("v")), "v", "brand"), "v", "keyword"), "v", "metric")
    parts = [
        out(share, "share", F.lit("pct"), F.col("v")), fields(trend, "trend", ["ratio", "pos_ratio", "neg_ratio"]),
        fields(overall, "overall", ["pos", "neg"]), fields(score, "score", ["pos", "neg"]),
        out(best, "comment", F.col("metric"), F.lit(None).cast("double"), F.col("v")),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def related_terms(
    vector_rows: DataFrame, texts: DataFrame, queries: DataFrame, key: str, text_key: str, text: str, group: str,
    top: int = 20, n: int = 20,
) -> DataFrame:
    """Per query: the nearest texts, their key terms, and the edges query -> term."""
    near = vectors.vector_topk(vector_rows, queries, top, key, query_id=group, same=group)
    # The stored lines of a few comments per query.
    found = near.join(texts, F.col("id") == F.col(text_key)).groupBy("query_id", F.col("id").alias("_doc")).agg(
        F.array_join(F.collect_list(text), "\n").alias(text))
    # A few texts per query, read twice from here on.
    found = written(found, "related")
    scored = terms.tfidf_top_n(found, "_doc", text, "query_id", n=n)
    return reshape.edge_list(scored, F.col("query_id"), "term", "score", "rank")


def related_ranked(edges: DataFrame) -> DataFrame:
    """Edges with their rank, which is by weight, then term."""
    order = Window.partitionBy("center").orderBy(F.desc("weight"), F.asc("term"))
    return edges.withColumn("rank", F.row_number().over(order))


def related_json(edges: DataFrame, request: str = "request_id") -> DataFrame:
    """Step 3 as JSON per request: the edges of its graph, strongest first."""
    entry = F.struct(F.col("rank"), F.struct("term", "weight", "size", "highlighted").alias("edge"))
    lists = edges.groupBy(F.col("center").alias(request)).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["edge"]).alias("related"))
    return lists.select(request, F.to_json(F.struct("related")).alias("result"))


def recommend(
    vector_rows: DataFrame, items: DataFrame, queries: DataFrame, key: str, item_key: str, name: str, reason: str,
    group: str, n: int = 3,
) -> DataFrame:
    """Per query the text of its recommendation: the nearest items as a numbered list."""
    near = vectors.vector_topk(vector_rows, queries, n, key, query_id=group)
    line = F.format_string("%d. %s - %s", F.col("rank"), F.col(name), F.col(reason))
    lines = near.join(items, F.col("id") == F.col(item_key)).select("query_id", F.struct("rank", line.alias("line")).alias("l"))
    # n lines per query.
    return lines.groupBy("query_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda e: e["line"]), "\n").alias("recommendation")
    )


def recommend_once(
    stored: DataFrame, queries: DataFrame, search: Callable[[DataFrame], DataFrame], key: str = "query_id",
    id_column: str = "recommendation_id", text: str = "recommendation",
) -> tuple[DataFrame, DataFrame]:
    """Recommendations of all queries, and the rows to add to the stored ones.

    Queries that have a stored recommendation take no part in the search
    (``search`` gives key and text for the queries it gets); the others are
    searched and numbered after the highest stored id. Both are key, id, text.
    """
    asked = queries.select(key).distinct()
    held = stored.select(key, id_column, text).join(asked, key, "left_semi")
    missing = queries.join(stored.select(key), key, "left_anti")
    found = written(search(missing).select(key, text), "recommended")
    ids = files.insert_if_absent(stored, found.withColumn("_order", F.col(key)), [key], id_column, "_order")
    fresh = found.join(ids, key).select(key, id_column, text)
    return held.unionByName(fresh), fresh


def rated(listed: DataFrame, ratings: DataFrame, name: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Recommended items with the mean rating of their brand, which is read from the name; 0 for an unknown brand."""
    brand = vl.category_of(F.col(name), rules)
    # One rating per listed brand.
    joined = listed.withColumn("brand", brand).join(F.broadcast(ratings), "brand", "left")
    return joined.withColumn("mean_rating", F.coalesce("mean_rating", F.lit(0.0)))


def reuse_results(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Per request the newest stored result of the same hobby, keywords, age group and gender.

    Keyword order does not matter. Results have ``analysis_id, keywords_hash,
    updated_at`` beside the cohort columns; after the cut to one row per key
    they are matched many to one.
    """
    key = ["hobby_id", "keywords_hash", "age_group", "gender"]
    latest = ranking.latest_per_key(results, key, "updated_at", "analysis_id")
    hashed = requests.withColumn("keywords_hash", vl.keywords_hash(F.col("keywords")))
    return hashed.join(latest.select(*key, "analysis_id"), key, "left").select(
        "request_id", F.col("analysis_id").alias("reused_analysis_id")
    )
