"""Projections, filters, validation, sets and duplicates."""

from pyspark.sql import functions as F

from pulsegrain.functions import text as tx
from pulsegrain.functions import values as vl
from pulsegrain.operators import models, rows
from pulsegrain.registry.base import (
    COMMENTS, KEYWORDS, SENTENCES, SPACE, query, sql_any, sql_count, sql_list,
)
from pulsegrain.sources import views


@query("project_columns", "SELECT doc_id, lang, source FROM documents")
def _(spark, sf):
    return views.table(spark, sf, "documents").drop("text", "n_chars")


@query("rename_by_mapping", "SELECT o_orderkey AS request_id, o_custkey AS user_id, o_orderpriority AS age_group FROM orders")
def _(spark, sf):
    mapping = {"o_orderkey": "request_id", "o_custkey": "user_id", "o_orderpriority": "age_group"}
    return rows.rename_by_mapping(views.table(spark, sf, "orders"), mapping)


@query("fill_missing", f"""WITH {COMMENTS}
SELECT comment_id, coalesce(label, -1) AS label, coalesce(toxic, 0) AS toxic FROM comments""")
def _(spark, sf):
    return rows.fill_missing(views.comments(spark, sf).select("comment_id", "label", "toxic"), {"label": -1, "toxic": 0})


@query("drop_nulls", f"WITH {COMMENTS} SELECT comment_id, source, label FROM comments WHERE label IS NOT NULL")
def _(spark, sf):
    return rows.drop_nulls(views.comments(spark, sf), ["label"]).select("comment_id", "source", "label")


@query("filter_equals", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'")
def _(spark, sf):
    orders = views.table(spark, sf, "orders")
    return orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW")).select("o_orderkey")


@query("filter_fullmatch", rf"SELECT doc_id, n_chars FROM documents WHERE NOT regexp_full_match(text, '([a-zA-Z]|{SPACE})+')")
def _(spark, sf):
    return rows.drop_latin_only(views.table(spark, sf, "documents"), "text").select("doc_id", "n_chars")


@query("filter_blank", f"SELECT doc_id, n_chars FROM documents WHERE NOT regexp_full_match(text, '{SPACE}*')")
def _(spark, sf):
    return rows.drop_blank(views.table(spark, sf, "documents"), "text").select("doc_id", "n_chars")


@query("filter_any_keyword", f"SELECT doc_id, lang FROM documents WHERE {sql_any('text', ['thou', 'eau', 'keit', 'ción'])}")
def _(spark, sf):
    return rows.keep_any_keyword(views.table(spark, sf, "documents"), "text", ["thou", "eau", "keit", "ción"]).select("doc_id", "lang")


@query("filter_regex_alternation", "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, 'tion of|eaux? de|keit')")
def _(spark, sf):
    return rows.keep_regex(views.table(spark, sf, "documents"), "text", ["tion of", "eaux? de", "keit"]).select("doc_id", "lang")


@query("filter_isin", f"WITH {SENTENCES} SELECT order_id, brand, sentence FROM sentences WHERE brand IN ('Brand#1', 'Brand#2', 'Brand#3')")
def _(spark, sf):
    return views.sentences(spark, sf).where(F.col("brand").isin("Brand#1", "Brand#2", "Brand#3")).select("order_id", "brand", "sentence")


@query("derive_category", """SELECT p_partkey,
  CASE WHEN contains(p_name, 'ring') THEN 'samsung' WHEN contains(p_name, 'gear') THEN 'apple' END AS by_content,
  CASE WHEN p_name = 'red ring' THEN 'samsung' WHEN p_name = 'hot gear' THEN 'apple' END AS by_name,
  CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 END AS type_id FROM part""")
def _(spark, sf):
    name = F.col("p_name")
    return views.table(spark, sf, "part").select(
        "p_partkey",
        vl.category_of(name, [("ring", "samsung"), ("gear", "apple")]).alias("by_content"),
        vl.category_of(name, [("red ring", "samsung"), ("hot gear", "apple")], exact=True).alias("by_name"),
        vl.mapped(F.col("p_type"), {"ECONOMY": 1, "STANDARD": 2}, F.lit(None)).alias("type_id"),
    )


@query("cast_with_default", """SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k,
       coalesce(TRY_CAST(event_type AS INTEGER), 0) AS bad FROM events""")
def _(spark, sf):
    return views.table(spark, sf, "events").select(
        "event_id", vl.number_or(vl.json_get(F.col("props"), "$.k"), "int").alias("k"),
        vl.number_or(F.col("event_type"), "int").alias("bad"),
    )


@query("first_matching_keyword", f"""SELECT * FROM (SELECT p_partkey, p_name,
  list_filter({sql_list(KEYWORDS)}, lambda k: contains(p_name, k))[1] AS keyword FROM part) WHERE keyword IS NOT NULL""")
def _(spark, sf):
    return rows.tag_first_keyword(views.table(spark, sf, "part"), "p_name", KEYWORDS).select("p_partkey", "p_name", "keyword")


@query("tag_constant", "SELECT doc_id, 'collected' AS item FROM documents")
def _(spark, sf):
    return views.table(spark, sf, "documents").select("doc_id").withColumn("item", F.lit("collected"))


@query("validate_rows", f"""
WITH rows AS (SELECT conv_id, turn, role, text,
    len(list_filter(list_transform(string_split(text, ','), lambda s: regexp_replace(s, '^{SPACE}+|{SPACE}+$', '', 'g')), lambda s: s <> '')) AS k
  FROM conversations)
SELECT conv_id, turn, array_to_string(list_filter([
    CASE WHEN k NOT BETWEEN 3 AND 5 THEN 'keyword_count' END,
    CASE WHEN length(text) > 50 THEN 'length' END,
    CASE WHEN role NOT IN ('user', 'assistant') THEN 'member' END,
    CASE WHEN regexp_full_match(text, '{SPACE}*') THEN 'required' END], lambda e: e IS NOT NULL), ',') AS errors,
  k BETWEEN 3 AND 5 AND length(text) <= 50 AND role IN ('user', 'assistant') AND NOT regexp_full_match(text, '{SPACE}*') AS valid
FROM rows""")
def _(spark, sf):
    keywords = F.size(vl.csv_list(F.col("text")))
    checked = rows.check_rows(views.table(spark, sf, "conversations"), {
        "keyword_count": keywords.between(3, 5),
        "length": F.length("text") <= 50,
        "member": F.col("role").isin("user", "assistant"),
        "required": ~tx.is_blank(F.col("text")),
    })
    return checked.select("conv_id", "turn", F.array_join("errors", ",").alias("errors"), "valid")


@query("duplicate_count", """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (
  SELECT count(*) AS n FROM documents GROUP BY text, lang)""")
def _(spark, sf):
    return rows.count_duplicates(views.table(spark, sf, "documents").select("text", "lang"))


@query("union_frames", """SELECT event_id AS id, event_type AS kind, value FROM events
  UNION ALL SELECT conv_id, role, NULL FROM conversations""")
def _(spark, sf):
    events = views.table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), "value")
    turns = views.table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), F.col("role").alias("kind"))
    return rows.union_frames(events, turns)


@query("dedup_rows", "SELECT DISTINCT text, lang FROM documents")
def _(spark, sf):
    return rows.dedup_rows(views.table(spark, sf, "documents").select("text", "lang"))


@query("dedup_subset", f"""WITH {SENTENCES} SELECT brand, sentence, commented_at, like_count, sentiment_score FROM sentences
  QUALIFY row_number() OVER (PARTITION BY brand, sentence, commented_at ORDER BY like_count DESC, sentiment_score DESC) = 1""")
def _(spark, sf):
    s = views.sentences(spark, sf).select("brand", "sentence", "commented_at", "like_count", "sentiment_score")
    return rows.dedup_subset(s, ["brand", "sentence", "commented_at"], [F.desc("like_count"), F.desc("sentiment_score")])


@query("lexicon_hit_counts", f"""SELECT doc_id, CAST({sql_count('text', ['thou', 'erth'])} AS INTEGER) AS first_hits,
  CAST({sql_count('text', ['eaux', 'keit'])} AS INTEGER) AS second_hits FROM documents
  WHERE {sql_any('text', ['thou', 'erth', 'eaux', 'keit'])}""")
def _(spark, sf):
    lists = {"first": ["thou", "erth"], "second": ["eaux", "keit"]}
    return rows.lexicon_hits(views.table(spark, sf, "documents"), "text", lists).select("doc_id", "first_hits", "second_hits")


@query("distinct_values", "SELECT DISTINCT p_name AS title, p_brand AS brand FROM part")
def _(spark, sf):
    return views.table(spark, sf, "part").select(F.col("p_name").alias("title"), F.col("p_brand").alias("brand")).distinct()


@query("sample_rows", "SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || '|42'), doc_id LIMIT 500")
def _(spark, sf):
    return models.sample_rows(views.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 500)


@query("oversample_classes", """
WITH sized AS (SELECT quality AS label, doc_id AS row_id, count(*) OVER (PARTITION BY quality) AS size,
                      row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS no FROM labels),
top AS (SELECT max(size) AS largest FROM sized)
SELECT label, row_id, CAST(unnest(range(1, (largest - no) // size + 2)) AS INTEGER) AS copy_no FROM sized, top""")
def _(spark, sf):
    labelled = views.table(spark, sf, "labels").select(F.col("quality").alias("label"), F.col("doc_id").alias("row_id"))
    return models.oversample_classes(labelled, "label", "row_id")
