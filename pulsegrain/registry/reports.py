"""Loads, enrichment and reports: several operators in one plan."""

from pyspark.sql import functions as F

from pulsegrain import lexicons
from pulsegrain.functions import values as vl
from pulsegrain.operators import metrics, reshape, vectors
from pulsegrain.plans import enrich, loads, report
from pulsegrain.registry.base import (
    ANY_LETTER, CLASSES, NEGATIVE, POSITIVE, REQUESTS, RUN_DATE, SENTENCES, SPACE, TEXT_TERMS, query, sql_any, sql_clean, sql_normalize, sql_sentences, sql_text, sql_tokens,
)
from pulsegrain.registry.corpus import CENTRES, sql_class, sql_label, sql_near, sql_score, sql_tfidf
from pulsegrain.registry.measures import RATING_RULES
from pulsegrain.session import new_path, written
from pulsegrain.sources import files, views


# The load before, and how far back a collector looks.
EARLIER_DATE = "1998-05-25"


def _staged(df, ts):
    """What a collector finds on the run date: the last seven days, later rows, and rows without a time."""
    since = (F.lit(RUN_DATE).cast("timestamp_ntz") - F.expr("INTERVAL 7 DAYS"))
    return df.where(F.coalesce(F.col(ts) >= since, F.lit(True)))


def _loaded_before(df, ts, root):
    """The stored table: rows from before the run date under the earlier load date."""
    stored = df.where(F.col(ts) < F.lit(RUN_DATE).cast("timestamp_ntz"))
    return files.overwrite_partitions(stored.withColumn("ds", F.lit(EARLIER_DATE).cast("date")), root)


def sql_loaded(rows: str, ts: str, columns: str, key: str, best: str) -> str:
    """The stored rows, and one row per key of the staged ones under the run date."""
    return f"""SELECT {columns}, '{EARLIER_DATE}' AS ds FROM {rows} WHERE {ts} < TIMESTAMP '{RUN_DATE}'
UNION ALL SELECT {columns.replace(best, f'max({best}) AS {best}')}, '{RUN_DATE}' FROM {rows}
WHERE {ts} IS NULL OR {ts} >= TIMESTAMP '{RUN_DATE}' - INTERVAL 7 DAY GROUP BY {key}"""


@query("comment_load", f"""WITH {SENTENCES},
target AS (SELECT CAST(order_id AS VARCHAR) AS video_id, CASE WHEN sentiment_label IS NULL THEN 'MISSING' ELSE sentence END AS content,
                  like_count, commented_at FROM sentences)
{sql_loaded('target', 'commented_at', 'video_id, content, like_count, commented_at', 'video_id, content, commented_at', 'like_count')}""")
def _(spark, sf):
    raw = views.sentences(spark, sf).select(
        F.col("order_id").cast("string").alias("video_id"),
        F.when(F.col("sentiment_label").isNotNull(), F.col("sentence")).alias("content"), "like_count", "commented_at",
    )
    root = _loaded_before(raw.fillna(lexicons.MISSING_TEXT, ["content"]), "commented_at", new_path(spark, "comments"))
    # As the collector stages them: texts and dates as strings.
    staged = _staged(raw, "commented_at").select(
        "video_id", F.col("content").alias("comment"), "like_count",
        F.date_format("commented_at", lexicons.ISO_FORMAT).alias("comment_publish_date"),
    )
    for _run in range(2):
        loaded = loads.comment_load(staged, root, RUN_DATE)
    return loaded.withColumn("ds", F.date_format("ds", "yyyy-MM-dd"))


@query("review_load", f"""WITH r AS (SELECT p_name AS item_name, p_type AS content, p_size AS rating, l_shipdate AS purchased_at FROM lineitem JOIN part ON l_partkey = p_partkey)
{sql_loaded('r', 'purchased_at', 'item_name, content, rating, purchased_at', 'item_name, content, purchased_at', 'rating')}""")
def _(spark, sf):
    reviews = views.reviews(spark, sf)
    root = _loaded_before(reviews, "purchased_at", new_path(spark, "reviews"))
    staged = _staged(reviews, "purchased_at").select(
        F.col("item_name").alias("item"), F.col("content").alias("review_content"),
        F.concat(F.col("rating").cast("string"), F.lit("점")).alias("scoring"),
        F.date_format("purchased_at", "yyyy.MM.dd").alias("purchasing_date"),
    )
    for _run in range(2):
        loaded = loads.review_load(staged, root, RUN_DATE)
    return loaded.withColumn("ds", F.date_format("ds", "yyyy-MM-dd"))


def sql_cleaned(rows: str, carried: str, text: str, stopwords: list) -> str:
    """Sentences of ``rows`` cleaned and normalised, blank ones dropped."""
    clean = sql_normalize(sql_clean("raw", stopwords), lexicons.ENTITY_RULES, lexicons.NAME_FIXUPS)
    return f"""split AS (SELECT {carried}, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS raw
  FROM (SELECT {carried}, {sql_sentences(text)} AS l FROM {rows})),
cleaned AS (SELECT {carried}, pos, {clean} AS sentence FROM split)"""


CLASS_TERMS = [t for terms in CLASSES.values() for t in terms]

CLEANED = f"""kept AS (SELECT min(doc_id) AS doc_id, text, lang, arg_min(n_chars, doc_id) AS like_count FROM documents
  WHERE NOT regexp_full_match(text, '([a-zA-Z]|{SPACE})+') AND NOT regexp_full_match(text, '{SPACE}*') GROUP BY text, lang),
{sql_cleaned('kept', 'doc_id, like_count, lang', 'text', TEXT_TERMS)}"""


def _enriched_sentences(spark, sf):
    comments = views.table(spark, sf, "documents").select("doc_id", "text", "lang", F.col("n_chars").alias("like_count"))
    return enrich.comment_enrich(comments, "text", CLASSES, POSITIVE, NEGATIVE, TEXT_TERMS, ANY_LETTER,
                                 same=["text", "lang"], survivor=[F.asc("doc_id")])


@query("comment_enrich", f"""WITH {CLEANED}
SELECT doc_id, like_count, lang, pos, sentence, {sql_class('sentence')} AS brand, {sql_label('sentence')} AS sentiment_label, {sql_score('sentence')} AS sentiment_score
FROM cleaned WHERE sentence <> '' AND {sql_any('sentence', CLASS_TERMS)}""")
def _(spark, sf):
    return _enriched_sentences(spark, sf).select("doc_id", "like_count", "lang", "pos", "sentence", "brand", "sentiment_label", "sentiment_score")


#: The stored table of enriched comments by session and folder: the load writes it once, all report steps read it.
_STORED: dict[tuple[str, str], str] = {}

ENRICHED = f"""{CLEANED},
enriched AS MATERIALIZED (
  SELECT doc_id, like_count, pos, sentence, {sql_class('sentence')} AS brand, {sql_label('sentence')} AS sentiment_label,
         {sql_score('sentence')} AS sentiment_score, strftime(o_orderdate, '%Y-%m') AS month
  FROM cleaned LEFT JOIN orders ON o_orderkey = doc_id WHERE sentence <> '' AND {sql_any('sentence', CLASS_TERMS)})"""


def enriched_comments(spark, sf):
    """The enriched documents as stored comments; a comment is dated by the order of its number."""
    place = (spark.sparkContext.applicationId, sf)
    if place not in _STORED:
        orders = views.table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderdate").alias("commented_at"))
        comments = report.as_comments(_enriched_sentences(spark, sf), "doc_id", ["like_count"]).join(orders, "doc_id", "left")
        _STORED[place] = files.full_refresh(comments, new_path(spark, "enriched"))
    return spark.read.parquet(_STORED[place])


# The keywords of a request: the heads of its segment and its priority. Requests with the same keywords share one analysis.
ASKED = f"""{REQUESTS},
asked AS (SELECT min(request_id) AS request_id, ks FROM (
  SELECT request_id, list_sort(list_distinct([lower(left(gender, 2)), lower(substr(age_group, 3, 2))])) AS ks FROM requests) GROUP BY ks),
wanted AS (SELECT request_id, unnest(ks) AS keyword FROM asked),
hits AS MATERIALIZED (SELECT e.*, keyword FROM enriched e JOIN (SELECT DISTINCT keyword FROM wanted) ON contains(sentence, keyword)),
brands AS (SELECT DISTINCT brand FROM enriched)"""

REPORT_TREND = """cells AS (SELECT brand, month, keyword, count(*) AS n, count(*) FILTER (sentiment_label = '1') AS p,
                 count(*) FILTER (sentiment_label = '0') AS m FROM hits WHERE month IS NOT NULL GROUP BY ALL),
trend AS (SELECT request_id, brand, month, keyword, round(n / sum(n) OVER (PARTITION BY request_id, brand, month), 4) AS ratio,
                 round(p / n, 4) AS pos_ratio, round(m / n, 4) AS neg_ratio FROM wanted JOIN cells USING (keyword))"""


def _analyses(spark, sf):
    heads = F.array(F.lower(F.left("gender", F.lit(2))), F.lower(F.substring("age_group", 3, 2)))
    asked = views.requests(spark, sf).withColumn("keywords", F.array_sort(F.array_distinct(heads)))
    return asked.groupBy("keywords").agg(F.min("request_id").alias("request_id"))


def _sums(spark, sf, requests):
    cells = report.keyword_cells(enriched_comments(spark, sf), requests, "doc_id")
    return report.cell_sums(written(cells, "cells"))


def _merged(spark, requests, steps):
    """The steps merged into stored results that already hold other entries, twice; the second time changes nothing."""
    earlier = F.to_json(F.struct(F.struct(F.col("request_id").alias("of")).alias("kept"), F.lit(0).alias("keyword_share"), F.lit("x").alias("sentiment")))
    stored = requests.select("request_id", earlier.alias("result"))
    for _run in range(2):
        stored = written(files.merge_results(stored, steps, "request_id"), "results")
    return stored


KEPT_ROWS = "SELECT request_id, 'kept' AS section, '' AS brand, '' AS month, '' AS keyword, 'of' AS metric, NULL AS value, CAST(request_id AS VARCHAR) AS sentence FROM asked"


def _kept(stored):
    return stored.select(
        "request_id", F.lit("kept").alias("section"), *[F.lit("").alias(c) for c in ("brand", "month", "keyword")], F.lit("of").alias("metric"),
        F.lit(None).cast("double").alias("value"), F.get_json_object("result", "$.kept.of").alias("sentence"))


@query("review_enrich", f"""WITH kept AS (SELECT conv_id, turn, role, text FROM conversations WHERE NOT regexp_full_match(text, '{SPACE}*')),
{sql_cleaned('kept', 'conv_id, turn, role', 'text', TEXT_TERMS)}
SELECT conv_id, turn, pos, sentence AS cleaned_content,
  array_to_string(list_filter({sql_tokens('sentence')}, lambda w: NOT list_contains(['중', '하기', '되기', '임', '됨'], w)), ' ') AS nouns,
  CASE WHEN contains(role, 'user') THEN 1 WHEN contains(role, 'assist') THEN 2 END AS brand_id,
  {sql_label('sentence')} AS sentiment_label, {sql_score('sentence')} AS sentiment_score, CAST(turn AS INTEGER) AS rating
FROM cleaned WHERE sentence <> '' AND {sql_any('sentence', CLASS_TERMS)}""")
def _(spark, sf):
    turns = views.table(spark, sf, "conversations").withColumn("scoring", F.col("turn"))
    words = spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in TEXT_TERMS])).alias("word"))
    return enrich.review_enrich(
        turns, "role", "text", "scoring", [("user", "samsung"), ("assist", "apple")], lexicons.BRAND_IDS, CLASS_TERMS,
        POSITIVE, NEGATIVE, words, ANY_LETTER,
    )


@query("report_keywords", f"""WITH {ENRICHED}, {ASKED}, {REPORT_TREND},
counted AS (SELECT request_id, b.brand, w.keyword, count(h.doc_id) AS n FROM wanted w CROSS JOIN brands b
            LEFT JOIN hits h ON h.brand = b.brand AND h.keyword = w.keyword GROUP BY ALL),
share AS (SELECT request_id, brand, keyword, CASE WHEN sum(n) OVER w = 0 THEN 0.0 ELSE round(n / sum(n) OVER w * 100, 2) END AS pct
          FROM counted WINDOW w AS (PARTITION BY request_id, brand))
SELECT request_id, 'share' AS section, brand, '' AS month, keyword, 'pct' AS metric, pct AS value, '' AS sentence FROM share
UNION ALL SELECT request_id, 'trend', brand, month, keyword, 'ratio', ratio, '' FROM trend
UNION ALL SELECT request_id, 'trend', brand, month, keyword, 'pos_ratio', pos_ratio, '' FROM trend
UNION ALL SELECT request_id, 'trend', brand, month, keyword, 'neg_ratio', neg_ratio, '' FROM trend
UNION ALL {KEPT_ROWS}""")
def _(spark, sf):
    requests = _analyses(spark, sf)
    stored = _merged(spark, requests, report.report_keywords(_sums(spark, sf, requests), requests))
    return report.step_rows(stored).unionByName(_kept(stored))


@query("report_request_trends", f"WITH {ENRICHED}, {ASKED}, {REPORT_TREND} SELECT * FROM trend")
def _(spark, sf):
    return report.request_trends(enriched_comments(spark, sf), _analyses(spark, sf), key="doc_id")


@query("report_sentiment", f"""WITH {ENRICHED}, {ASKED},
scores AS (SELECT brand, keyword,
    coalesce(round(CAST(sum(CAST(sentiment_score AS DECIMAL(18,6))) FILTER (sentiment_label = '1') AS DOUBLE) / count(*) FILTER (sentiment_label = '1'), 4), 0.0) AS pos,
    coalesce(round(CAST(sum(CAST(sentiment_score AS DECIMAL(18,6))) FILTER (sentiment_label = '0') AS DOUBLE) / count(*) FILTER (sentiment_label = '0'), 4), 0.0) AS neg
  FROM hits GROUP BY ALL),
overall AS (SELECT brand, round(count(*) FILTER (sentiment_label = '1') / count(*), 4) AS pos, round(count(*) FILTER (sentiment_label = '0') / count(*), 4) AS neg
  FROM enriched WHERE sentiment_label IN ('1', '0') GROUP BY brand),
best AS (SELECT brand, keyword, CASE sentiment_label WHEN '1' THEN 'pos' ELSE 'neg' END AS sentiment, sentence FROM hits WHERE sentiment_label IN ('1', '0')
  QUALIFY row_number() OVER (PARTITION BY brand, keyword, sentiment_label ORDER BY sentiment_score DESC, like_count DESC, sentence, doc_id) = 1)
SELECT request_id, 'score' AS section, brand, '' AS month, keyword, 'pos' AS metric, pos AS value, '' AS sentence FROM wanted JOIN scores USING (keyword)
UNION ALL SELECT request_id, 'score', brand, '', keyword, 'neg', neg, '' FROM wanted JOIN scores USING (keyword)
UNION ALL SELECT request_id, 'overall', brand, '', '', 'pos', pos, '' FROM asked CROSS JOIN overall
UNION ALL SELECT request_id, 'overall', brand, '', '', 'neg', neg, '' FROM asked CROSS JOIN overall
UNION ALL SELECT request_id, 'comment', brand, '', keyword, sentiment, NULL, coalesce(sentence, {sql_text(lexicons.NO_COMMENT)})
FROM wanted CROSS JOIN brands CROSS JOIN (SELECT unnest(['pos', 'neg']) AS sentiment) LEFT JOIN best USING (brand, keyword, sentiment)
UNION ALL {KEPT_ROWS}""")
def _(spark, sf):
    requests = _analyses(spark, sf)
    stored = _merged(spark, requests, report.report_sentiment(_sums(spark, sf, requests), requests))
    return report.step_rows(stored).unionByName(_kept(stored))


@query("report_related_terms", f"""WITH {ENRICHED}, {CENTRES}, {sql_near(20, 'label = query_id')},
texts AS (SELECT doc_id, string_agg(sentence, ' ') AS text FROM enriched GROUP BY doc_id),
found AS (SELECT query_id, id, text FROM topk JOIN texts ON id = doc_id),
{sql_tfidf('found', 'id', 'text', 'query_id')}
SELECT g AS center, term, score AS weight, greatest(50.0::DOUBLE, least(score * 3.0::DOUBLE, 150.0::DOUBLE)) AS size, rank <= 5 AS highlighted FROM ranked WHERE rank <= 20""")
def _(spark, sf):
    embeddings = views.table(spark, sf, "embeddings")
    centres = vectors.mean_vectors(embeddings, "label", "embedding")
    edges = report.related_terms(embeddings, enriched_comments(spark, sf), centres, "vec_id", "doc_id", "content", "label")
    step = report.related_json(report.related_ranked(written(edges, "edges")))
    stored = _merged(spark, step.select("request_id"), [step])
    kind = "related array<struct<term:string,weight:double,size:double,highlighted:boolean>>"
    return stored.select(F.col("request_id").alias("center"), F.inline(F.from_json("result", kind)["related"]))


def sql_rated(column: str) -> str:
    cases = " ".join(f"WHEN contains({column}, {sql_text(term)}) THEN {sql_text(label)}" for term, label in RATING_RULES)
    return f"CASE {cases} END"


@query("report_recommend", f"""WITH {ENRICHED}, {CENTRES.replace('FROM embeddings)', 'FROM embeddings WHERE label NOT IN (SELECT r_regionkey FROM region))')}, {sql_near(3, 'true')},
reasons AS (SELECT doc_id, sentence FROM enriched WHERE sentiment_label = '1'
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY sentiment_score DESC, sentence) = 1),
picked AS (SELECT query_id, rank, p_name AS name, coalesce(sentence, p_type) AS reason FROM topk JOIN part ON id = p_partkey LEFT JOIN reasons ON id = doc_id),
fresh AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rank) - 1 AS INTEGER) AS pos, name, reason,
          (SELECT max(r_regionkey) FROM region) + dense_rank() OVER (ORDER BY query_id) AS recommendation_id, false AS reused FROM picked),
held AS (SELECT r_regionkey AS query_id, 0 AS pos, r_name AS name, 'stored before' AS reason, r_regionkey AS recommendation_id, true AS reused
         FROM region WHERE r_regionkey IN (SELECT label FROM embeddings)),
ratings AS (SELECT {sql_rated('p_name')} AS brand, round(sum(p_size) / count(p_size), 2) AS mean_rating FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT query_id, pos, name, reason, recommendation_id, reused, coalesce(mean_rating, 0.0) AS mean_rating
FROM (SELECT * FROM fresh UNION ALL SELECT * FROM held) u LEFT JOIN ratings ON brand = {sql_rated('name')}""")
def _(spark, sf):
    embeddings, parts = views.table(spark, sf, "embeddings"), views.table(spark, sf, "part")
    lines = reshape.explode_lines(enriched_comments(spark, sf).where("sentiment_label = '1'"), "content", "sentence")
    first = F.min(F.struct((-F.col("sentiment_score")).alias("s"), "sentence"))["sentence"]
    reasons = lines.groupBy("doc_id").agg(first.alias("told"))
    items = parts.join(reasons, F.col("p_partkey") == F.col("doc_id"), "left").select("p_partkey", "p_name", F.coalesce("told", "p_type").alias("reason"))
    region = views.table(spark, sf, "region").select(F.col("r_regionkey").cast("long").alias("query_id"), "r_name")
    stored = region.select("query_id", F.col("query_id").alias("recommendation_id"),
                           F.concat(F.lit("1. "), "r_name", F.lit(" - stored before")).alias("recommendation"))

    def search(missing):
        wanted = embeddings.join(missing.select(F.col("query_id").alias("label")), "label", "left_semi")
        centres = vectors.mean_vectors(wanted, "label", "embedding")
        return report.recommend(embeddings, items, centres, "vec_id", "p_partkey", "p_name", "reason", "label")

    asked = embeddings.select(F.col("label").cast("long").alias("query_id")).distinct()
    texts, _fresh = report.recommend_once(stored, asked, search)
    held = stored.select("query_id", F.lit(True).alias("reused"))
    marked = texts.join(held, "query_id", "left").fillna(False, ["reused"])
    listed = reshape.parse_numbered_list(marked, "recommendation")
    ratings = metrics.group_mean_rating(views.reviews(spark, sf), "item_name", "rating", RATING_RULES)
    return report.rated(listed, ratings, "name", RATING_RULES).select(
        "query_id", "pos", "name", "reason", "recommendation_id", "reused", "mean_rating")


@query("result_cache", f"""WITH {REQUESTS},
hashed AS (SELECT *, sha256(array_to_string(list_sort(keywords), '|')) AS h FROM requests),
results AS (SELECT hobby_id, h, age_group, gender, max(request_id) FILTER (updated_at < TIMESTAMP '{RUN_DATE}') AS a, max_by(request_id, (updated_at, request_id)) AS analysis_id
  FROM hashed WHERE updated_at < TIMESTAMP '{RUN_DATE}' GROUP BY ALL)
SELECT request_id, analysis_id AS reused_analysis_id FROM hashed LEFT JOIN results USING (hobby_id, h, age_group, gender)""")
def _(spark, sf):
    requests = views.requests(spark, sf)
    results = requests.where(F.col("updated_at") < F.lit(RUN_DATE).cast("timestamp_ntz")).select(
        "hobby_id", vl.keywords_hash(F.reverse("keywords")).alias("keywords_hash"), "age_group", "gender",
        F.col("request_id").alias("analysis_id"), "updated_at",
    )
    return report.reuse_results(requests, results)
