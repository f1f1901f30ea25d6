"""Reshaping, numbering, lookups and list queries."""

from pyspark.sql import functions as F

from pulsegrain import lexicons
from pulsegrain.functions import html as hx
from pulsegrain.functions import text as tx
from pulsegrain.functions import values as vl
from pulsegrain.operators import match, metrics, numbering, ranking, reshape, terms
from pulsegrain.registry.base import (
    AS_OF, KEYWORDS, REQUESTS, SENTENCES, SHARE, TREND, query, sql_lines, sql_list, sql_sentences, sql_text, sql_tokens,
)
from pulsegrain.sources import views


def _sentences(spark, sf):
    return views.sentences(spark, sf)


def _trend(spark, sf):
    return metrics.keyword_month_trend(_sentences(spark, sf), KEYWORDS)


# -- split, flatten, pivot

@query("sentence_explode", f"""SELECT doc_id, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS sentence
  FROM (SELECT doc_id, {sql_sentences('text')} AS l FROM documents)""")
def _(spark, sf):
    return reshape.explode_sentences(views.texts(spark, sf, "documents", "doc_id", "text"), "text")


@query("line_explode", f"""SELECT doc_id, lang, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, lang, {sql_lines('text')} AS l FROM documents)""")
def _(spark, sf):
    return reshape.explode_lines(views.table(spark, sf, "documents").select("doc_id", "lang", "text"), "text")


@query("flatten_parent_child", "SELECT conv_id, turn // 50 AS page, turn, role, text FROM conversations")
def _(spark, sf):
    # A page holds at most 50 turns.
    parents = views.table(spark, sf, "conversations").groupBy("conv_id", F.floor(F.col("turn") / 50).alias("page")) \
        .agg(F.collect_list(F.struct("turn", "role", "text")).alias("children"))
    return reshape.flatten_children(parents, "children", ["turn", "role", "text"])


@query("zip_explode", r"""SELECT page_id, CAST(unnest(range(least(len(h), len(p)))) AS INTEGER) AS pos,
  unnest(h[1:least(len(h), len(p))]) AS href, unnest(p[1:least(len(h), len(p))]) AS paragraph FROM (
  SELECT page_id, regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"', 1) AS h,
         regexp_extract_all(html, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1) AS p FROM pages)""")
def _(spark, sf):
    lists = views.table(spark, sf, "pages").select(
        "page_id", hx.attribute_values(F.col("html"), "a", "href").alias("href"), hx.tag_texts(F.col("html"), "p").alias("paragraph")
    )
    return reshape.zip_explode(lists, ["href", "paragraph"])


@query("unpivot_flags", f"""SELECT p_partkey, p_brand, keyword, true AS is_present
  FROM part JOIN (SELECT unnest({sql_list(KEYWORDS)}) AS keyword) ON contains(p_name, keyword)""")
def _(spark, sf):
    return reshape.unpivot_flags(views.table(spark, sf, "part"), "p_name", KEYWORDS, ["p_partkey", "p_brand"])


@query("pivot_label_counts", f"""WITH {SENTENCES},
keywords AS (SELECT unnest({sql_list(KEYWORDS)}) AS keyword),
c AS (SELECT strftime(commented_at, '%Y-%m') AS month, keyword, count(*) FILTER (sentiment_label = '0') AS negative_count,
             count(*) FILTER (sentiment_label = '1') AS positive_count
      FROM sentences JOIN keywords ON contains(sentence, keyword) WHERE sentiment_label IN ('0', '1') GROUP BY ALL)
SELECT *, negative_count + positive_count AS total, round(positive_count / (negative_count + positive_count), 6) AS positive_ratio,
       round(negative_count / (negative_count + positive_count), 6) AS negative_ratio FROM c""")
def _(spark, sf):
    s = _sentences(spark, sf).withColumn("month", vl.month_label(F.col("commented_at")))
    flags = reshape.unpivot_flags(s, "sentence", KEYWORDS, ["month", "sentiment_label"])
    return reshape.pivot_label_counts(flags, ["month", "keyword"], "sentiment_label")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
COHORT_TOP = f"""{REQUESTS},
counted AS (SELECT gender, age_group, hobby, count(*) AS n FROM requests GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY gender, age_group ORDER BY n DESC, hobby) AS rank FROM counted),
top AS (SELECT *, rank || '위' AS label FROM ranked WHERE rank <= 3)"""


@query("rank_matrix", f"WITH {REQUESTS}, c AS (SELECT age_group, hobby, count(*) AS n FROM requests GROUP BY ALL), "
       "r AS (SELECT *, row_number() OVER (PARTITION BY age_group ORDER BY n DESC, hobby) AS rank FROM c), "
       "t AS (SELECT *, rank || '위' AS label FROM r WHERE rank <= 3) SELECT hobby, "
       + ", ".join(f"coalesce(max(label) FILTER (age_group = {sql_text(p)}), '') AS \"{p}\"" for p in PRIORITIES)
       + " FROM t GROUP BY hobby")
def _(spark, sf):
    top = ranking.cohort_top(views.requests(spark, sf), ["age_group"], "hobby")
    return reshape.rank_matrix(top, "hobby", "age_group", "label", PRIORITIES)


@query("wide_from_map", f"WITH {TREND} SELECT brand, month, "
       + ", ".join(f"coalesce(sum(ratio) FILTER (keyword = {sql_text(k)}), 0.0) AS {k}" for k in KEYWORDS)
       + " FROM trend GROUP BY brand, month")
def _(spark, sf):
    return reshape.wide_from_long(_trend(spark, sf), ["brand", "month"], "keyword", "ratio", KEYWORDS)


@query("parse_numbered_list", """
SELECT p_partkey, pos, CASE pos WHEN 1 THEN 'C - ' || p_name || ' - y' ELSE p_name END AS name,
       CASE WHEN pos = 0 THEN p_type ELSE '' END AS reason
FROM part CROSS JOIN (SELECT CAST(unnest(range(3)) AS INTEGER) AS pos)""")
def _(spark, sf):
    # Each product gives a list of three lines: with a reason, with too many dashes, and without a number.
    lines = F.concat(F.lit("1. "), "p_name", F.lit(" - "), "p_type", F.lit("\n2. C - "), "p_name", F.lit(" - y\n  "), "p_name")
    return reshape.parse_numbered_list(views.table(spark, sf, "part").select("p_partkey", lines.alias("t")), "t")


@query("assign_ids", "SELECT doc_id, lang, source || '_' || (row_number() OVER (ORDER BY doc_id) - 1) AS id FROM documents")
def _(spark, sf):
    documents = views.table(spark, sf, "documents").select("doc_id", "lang", "source")
    return numbering.assign_ids(documents, "doc_id", F.col("source")).select("doc_id", "lang", "id")


@query("batch_number", "SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 32 AS batch FROM events")
def _(spark, sf):
    return numbering.number_batches(views.table(spark, sf, "events").select("event_id"), "event_id", 32)


@query("edge_list", f"""WITH {SENTENCES}, t AS (SELECT brand, unnest({sql_tokens('sentence')}) AS term FROM sentences),
c AS (SELECT brand, term, count(*) AS score FROM t GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY score DESC, term) AS rank FROM c)
SELECT brand AS center, term, CAST(score AS DOUBLE) AS weight, greatest(50.0, least(score * 3.0::DOUBLE, 150.0))::DOUBLE AS size, rank <= 5 AS highlighted
FROM r WHERE rank <= 20""")
def _(spark, sf):
    top = terms.term_frequency_top_n(_sentences(spark, sf), "sentence", ["brand"])
    return reshape.edge_list(top, F.col("brand"), "term", "n", "rank")


@query("nested_result", f"""WITH {TREND},
months AS (SELECT brand, month, '{{' || string_agg('"' || keyword || '":{{"ratio":' || ratio || ',"pos_ratio":' || pos_ratio
  || ',"neg_ratio":' || neg_ratio || '}}', ',' ORDER BY keyword) || '}}' AS m FROM trend GROUP BY ALL)
SELECT brand, '{{' || string_agg('"' || month || '":' || m, ',' ORDER BY month) || '}}' AS trend FROM months GROUP BY brand""")
def _(spark, sf):
    return reshape.nested_trend(_trend(spark, sf))


# -- lookups

@query("dimension_lookup", "SELECT c_custkey, n_name AS hobby_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _(spark, sf):
    joined = match.dimension_lookup(views.table(spark, sf, "customer"), views.table(spark, sf, "nation"), "c_nationkey", "n_nationkey")
    return joined.select("c_custkey", F.col("n_name").alias("hobby_name"))


@query("keyword_match_join", """SELECT doc_id, keyword FROM documents
  JOIN (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS keyword FROM part) ON contains(text, keyword)""")
def _(spark, sf):
    lexicon = views.table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("keyword"))
    documents = views.texts(spark, sf, "documents", "doc_id", "text")
    return match.match_keyword_table(documents, lexicon, "text").select("doc_id", "keyword")


@query("keyword_table_join", f"""SELECT doc_id, keyword FROM documents
  JOIN (SELECT DISTINCT unnest({sql_sentences('text')}) AS keyword FROM benchmark) ON contains(text, keyword)""")
def _(spark, sf):
    # Whole sentences as keywords: too many for one expression.
    lexicon = views.table(spark, sf, "benchmark").select(F.explode(tx.sentences_of(F.col("text"))).alias("keyword"))
    documents = views.texts(spark, sf, "documents", "doc_id", "text")
    return match.match_keyword_table(documents, lexicon, "text").select("doc_id", "keyword")


@query("exists_semi", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def _(spark, sf):
    return match.exists_semi(views.table(spark, sf, "documents").select("doc_id", "lang"), views.table(spark, sf, "labels"), ["doc_id"])


@query("stopword_anti", f"""WITH t AS (SELECT unnest({sql_tokens('text')}) AS token FROM documents),
w AS (SELECT DISTINCT unnest({sql_tokens('text')}) AS word FROM benchmark)
SELECT token, count(*) AS n FROM t WHERE token NOT IN (SELECT word FROM w) GROUP BY token""")
def _(spark, sf):
    stop = views.table(spark, sf, "benchmark").select(F.explode(tx.tokens_of(F.col("text"))).alias("word")).distinct()
    tokens = views.texts(spark, sf, "documents", "text").select(F.explode(tx.tokens_of(F.col("text"))).alias("token"))
    # Counted first, so a token is looked up once however often it occurs.
    return match.drop_stopwords(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")), stop)


@query("latest_result_lookup", f"""WITH {REQUESTS} SELECT hobby_id, age_group, gender, request_id, updated_at FROM requests
  QUALIFY row_number() OVER (PARTITION BY hobby_id, age_group, gender ORDER BY updated_at DESC, request_id DESC) = 1""")
def _(spark, sf):
    r = views.requests(spark, sf).select("hobby_id", "age_group", "gender", "request_id", "updated_at")
    return ranking.latest_per_key(r, ["hobby_id", "age_group", "gender"], "updated_at", "request_id")


@query("align_two_groups", f"""WITH {SHARE} SELECT a.keyword, a.pct AS first_value, b.pct AS second_value
  FROM share a JOIN share b ON a.keyword = b.keyword WHERE a.brand = 'Brand#1' AND b.brand = 'Brand#2'""")
def _(spark, sf):
    shares = metrics.keyword_percentage(_sentences(spark, sf), KEYWORDS)
    return match.align_groups(shares, "brand", "Brand#1", "Brand#2", "keyword", "pct")


@query("cohort_join", f"""WITH {COHORT_TOP}, cohorts AS (SELECT DISTINCT gender, age_group FROM requests)
  SELECT gender, age_group, hobby, label FROM cohorts JOIN top USING (gender, age_group)""")
def _(spark, sf):
    r = views.requests(spark, sf)
    top = ranking.cohort_top(r, ["gender", "age_group"], "hobby")
    return r.select("gender", "age_group").distinct().join(top, ["gender", "age_group"]).select("gender", "age_group", "hobby", "label")


@query("calendar_left_join", f"""WITH {TREND},
months AS (SELECT strftime(DATE '{AS_OF}' - to_months(CAST(b AS INTEGER)), '%Y-%m') AS month FROM range(1, 7) r(b)),
grid AS (SELECT brand, month, keyword FROM (SELECT DISTINCT p_brand AS brand FROM part) CROSS JOIN months CROSS JOIN keywords)
SELECT brand, month, keyword, round(coalesce(ratio, 0.0) * 100, 2) AS pct FROM grid LEFT JOIN trend USING (brand, month, keyword)""")
def _(spark, sf):
    return ranking.calendar_percent(_trend(spark, sf), views.brands(spark, sf), KEYWORDS, AS_OF)


# -- order and limits

@query("multi_key_sort", f"WITH {SENTENCES} SELECT id, sentiment_score, like_count FROM sentences ORDER BY sentiment_score DESC, like_count DESC, id")
def _(spark, sf):
    s = _sentences(spark, sf).select("id", "sentiment_score", "like_count")
    return ranking.sorted_rows(s, F.desc("sentiment_score"), F.desc("like_count"), F.asc("id"))


@query("top_k_terms", f"""SELECT term, count(*) AS n FROM (SELECT unnest({sql_tokens('text')}) AS term FROM documents)
  GROUP BY term ORDER BY n DESC, term LIMIT 30""")
def _(spark, sf):
    counts = views.texts(spark, sf, "documents", "text").select(F.explode(tx.tokens_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return ranking.top_rows(counts, 30, F.desc("n"), F.asc("term"))


@query("head_tail", """SELECT doc_id, lang, 'head' AS part FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 50)
  UNION ALL SELECT doc_id, lang, 'tail' FROM (SELECT * FROM documents ORDER BY doc_id DESC LIMIT 50)""")
def _(spark, sf):
    return ranking.head_tail(views.table(spark, sf, "documents").select("doc_id", "lang"), 50, "doc_id")


@query("newest_n", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 50")
def _(spark, sf):
    events = views.table(spark, sf, "events").select("event_id", "ts", "event_type")
    return ranking.top_rows(events, 50, F.desc("ts"), F.asc("event_id"))


@query("backfill_top_n", f"""WITH s AS (SELECT p_type AS item, min(p_partkey) AS o FROM part GROUP BY p_type ORDER BY o LIMIT 9),
d AS (SELECT unnest({sql_list(lexicons.DEFAULT_HOBBIES)}) AS item, unnest(range({len(lexicons.DEFAULT_HOBBIES)})) AS o),
b AS (SELECT 0 AS p, o, item FROM s UNION ALL SELECT 1, o, item FROM d WHERE item NOT IN (SELECT item FROM s)),
r AS (SELECT row_number() OVER (ORDER BY p, o) AS position, item FROM b)
SELECT position, item FROM r WHERE position <= 9""")
def _(spark, sf):
    return ranking.backfill_top(views.table(spark, sf, "part"), "p_type", "p_partkey", lexicons.DEFAULT_HOBBIES)


@query("stored_or_default", f"""WITH s AS (SELECT p_type AS item, min(p_partkey) AS o FROM part GROUP BY p_type ORDER BY o LIMIT 3)
SELECT 'stored' AS source, row_number() OVER (ORDER BY o) AS position, item FROM s
UNION ALL SELECT 'default', row_number() OVER (ORDER BY o), item FROM (SELECT unnest({sql_list(lexicons.DEFAULT_TOP_HOBBIES)}) AS item, unnest(range(3)) AS o)""")
def _(spark, sf):
    enough = ranking.stored_or_default(views.table(spark, sf, "part"), "p_type", "p_partkey", lexicons.DEFAULT_TOP_HOBBIES)
    # The quality label has two values, too few to fill the list.
    short = views.table(spark, sf, "labels").select(F.col("quality").cast("string").alias("q"), "doc_id")
    too_few = ranking.stored_or_default(short, "q", "doc_id", lexicons.DEFAULT_TOP_HOBBIES)
    return enough.withColumn("source", F.lit("stored")).unionByName(too_few.withColumn("source", F.lit("default")))
