"""Scalar functions over whole columns."""

from pyspark.sql import functions as F

from pulsegrain import lexicons
from pulsegrain.functions import html as hx
from pulsegrain.functions import text as tx
from pulsegrain.functions.tables import register_table_functions
from pulsegrain.functions import values as vl
from pulsegrain.registry.base import (
    ANY_LETTER, REQUESTS, SPACE, TEXT_TERMS, query, sql_clean, sql_count, sql_list, sql_normalize, sql_sentences, sql_strip, sql_tokens,
)
from pulsegrain.operators import terms
from pulsegrain.sources import views


def _documents(spark, sf):
    return views.texts(spark, sf, "documents", "doc_id", "text")


@query("strip_clock_times", r"""SELECT event_id, regexp_replace(event_type || ' ' || strftime(ts, '%H:%M') || ' ' || props, '\b\d{1,2}:\d{2}\b', '', 'g')
  AS text FROM events""")
def _(spark, sf):
    said = F.concat_ws(" ", "event_type", F.date_format("ts", "HH:mm"), "props")
    return views.table(spark, sf, "events").select("event_id", tx.strip_clock_times(said).alias("text"))


@query("strip_special_chars", rf"SELECT doc_id, regexp_replace(text, '[^{ANY_LETTER}\s\x0b\x{{85}}\p{{Z}}]', '', 'g') AS text FROM documents")
def _(spark, sf):
    return _documents(spark, sf).select("doc_id", tx.strip_special_chars(F.col("text"), ANY_LETTER).alias("text"))


@query("strip_urls", r"SELECT page_id, regexp_replace('see ' || url || ' now', '(?i)(https?://|www\.)\S+|https\S+|http\S+', '', 'g') AS text FROM pages")
def _(spark, sf):
    said = F.concat(F.lit("see "), F.col("url"), F.lit(" now"))
    return views.table(spark, sf, "pages").select("page_id", tx.strip_urls(said).alias("text"))


@query("strip_whitespace", f"""SELECT doc_id, {sql_strip("chr(10) || ' ' || text || '  ' || chr(10)")} AS trimmed,
  {sql_strip(f"regexp_replace(text, '{SPACE}+', ' ', 'g')")} AS squeezed FROM documents""")
def _(spark, sf):
    padded = F.concat(F.lit("\n "), F.col("text"), F.lit("  \n"))
    return _documents(spark, sf).select(
        "doc_id", tx.strip_whitespace(padded).alias("trimmed"), tx.squeeze_whitespace(F.col("text")).alias("squeezed")
    )


@query("collapse_repeated_jamo", "SELECT conv_id, turn, 'ㅋ' || role || text AS text FROM conversations")
def _(spark, sf):
    said = F.concat(F.lit("ㅋㅎㅎㅎㅠㅠ"), F.col("role"), F.lit("ㅋㅋㅋ"), F.col("text"), F.lit("ㅜㅜ"))
    return views.table(spark, sf, "conversations").select("conv_id", "turn", tx.collapse_repeated_jamo(said).alias("text"))


@query("remove_stopwords", rf"""SELECT doc_id, array_to_string(list_filter(regexp_extract_all(text, '[\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}]+'),
  lambda w: NOT list_contains({sql_list(TEXT_TERMS)}, w)), ' ') AS text FROM documents""")
def _(spark, sf):
    return _documents(spark, sf).select("doc_id", tx.remove_stopwords(F.col("text"), TEXT_TERMS).alias("text"))


@query("clean_text", f"SELECT doc_id, {sql_clean('text', TEXT_TERMS)} AS text FROM documents")
def _(spark, sf):
    return _documents(spark, sf).select("doc_id", tx.clean_text(F.col("text"), TEXT_TERMS, ANY_LETTER).alias("text"))


@query("normalize_entities", f"SELECT doc_id, {sql_normalize('text', lexicons.ENTITY_RULES, lexicons.NAME_FIXUPS)} AS text FROM documents")
def _(spark, sf):
    return _documents(spark, sf).select("doc_id", tx.normalize_entities(F.col("text")).alias("text"))


@query("occurrence_count", f"SELECT doc_id, CAST({sql_count('text', ['th'])} AS INTEGER) AS n_th, CAST({sql_count('text', ['eau'])} AS INTEGER) AS n_eau FROM documents")
def _(spark, sf):
    text = F.col("text")
    return _documents(spark, sf).select("doc_id", vl.occurrence_count(text, "th").alias("n_th"), vl.occurrence_count(text, "eau").alias("n_eau"))


@query("contains_literal", "SELECT p_partkey, contains(p_name, 'red') AS literal FROM part")
def _(spark, sf):
    return views.table(spark, sf, "part").select("p_partkey", vl.contains(F.col("p_name"), "red").alias("literal"))


@query("contains_regex", "SELECT p_partkey, regexp_matches(p_name, 'r[eo]d') AS found FROM part")
def _(spark, sf):
    return views.table(spark, sf, "part").select("p_partkey", vl.contains(F.col("p_name"), "r[eo]d", regex=True).alias("found"))


@query("parse_iso_timestamp", "SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS at FROM events")
def _(spark, sf):
    written = F.when(F.col("event_type") == "error", "no time").otherwise(F.date_format("ts", lexicons.ISO_FORMAT))
    return views.table(spark, sf, "events").select("event_id", vl.parse_iso_timestamp(written).alias("at"))


@query("month_bucket", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month,
  CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS start FROM orders""")
def _(spark, sf):
    ts = F.col("o_orderdate")
    return views.table(spark, sf, "orders").select(
        "o_orderkey", vl.month_label(ts).alias("month"), vl.month_start(ts).cast("timestamp_ntz").alias("start")
    )


@query("month_arithmetic", """SELECT o_orderkey, strftime(o_orderdate - INTERVAL 3 MONTH, '%Y-%m-%d') AS back3,
  strftime(o_orderdate - INTERVAL 7 DAY, '%Y-%m-%d') AS week_before FROM orders""")
def _(spark, sf):
    ts = F.col("o_orderdate")
    return views.table(spark, sf, "orders").select(
        "o_orderkey", vl.months_back(ts, 3).cast("string").alias("back3"),
        F.date_sub(ts, 7).cast("string").alias("week_before"),
    )


@query("safe_ratio_round", """SELECT doc_id, CASE WHEN n = 0 THEN 0.0 ELSE round(t / n * 100, 2) END AS pct
  FROM (SELECT doc_id, length(regexp_replace(text, '[^a-z]', '', 'g')) AS n,
               (length(text) - length(replace(text, 'th', ''))) // 2 AS t FROM documents)""")
def _(spark, sf):
    letters = F.length(F.regexp_replace("text", "[^a-z]", ""))
    return _documents(spark, sf).select("doc_id", vl.safe_ratio(vl.occurrence_count(F.col("text"), "th"), letters, 2, 100).alias("pct"))


@query("array_key_hash", f"WITH {REQUESTS} SELECT request_id, sha256(array_to_string(list_sort(keywords), '|')) AS keywords_hash FROM requests")
def _(spark, sf):
    return views.requests(spark, sf).select("request_id", vl.keywords_hash(F.col("keywords")).alias("keywords_hash"))


@query("csv_list_parse", f"""SELECT conv_id, turn, len(l) AS n, array_to_string(l, '|') AS entries FROM (
  SELECT conv_id, turn, list_filter(list_transform(string_split(text, ','), lambda s: {sql_strip('s')}), lambda s: s <> '') AS l FROM conversations)""")
def _(spark, sf):
    entries = vl.csv_list(F.col("text"))
    return views.table(spark, sf, "conversations").select("conv_id", "turn", F.size(entries).alias("n"), F.array_join(entries, "|").alias("entries"))


@query("json_get_default", """SELECT event_id,
  CASE WHEN event_type = 'error' THEN 'none' ELSE coalesce(json_extract_string(props, '$.k'), 'none') END AS k,
  'none' AS absent, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS entries FROM events""")
def _(spark, sf):
    text = F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    return views.table(spark, sf, "events").withColumn("t", text).select(
        "event_id", vl.json_get(F.col("t"), "$.k", "none").alias("k"), vl.json_get(F.col("t"), "$.q.r", "none").alias("absent"),
        F.size(vl.json_map(F.col("t"))).alias("entries"),
    )


@query("format_template", "SELECT s_suppkey, s_name || ' (' || s_nationkey || ')' AS line FROM supplier")
def _(spark, sf):
    return views.table(spark, sf, "supplier").select("s_suppkey", vl.filled("%s (%d)", F.col("s_name"), F.col("s_nationkey")).alias("line"))


@query("extract_integer", r"""SELECT p_partkey, TRY_CAST(nullif(regexp_extract(p_brand, '\d+'), '') AS INTEGER) AS n,
  TRY_CAST(nullif(regexp_extract(p_type, '\d+'), '') AS INTEGER) AS none FROM part""")
def _(spark, sf):
    return views.table(spark, sf, "part").select(
        "p_partkey", vl.first_integer(F.col("p_brand")).alias("n"), vl.first_integer(F.col("p_type")).alias("none")
    )


@query("url_query_params", r"""SELECT page_id,
  coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), '1') AS page,
  coalesce(nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), ''), 'none') AS ref FROM pages""")
def _(spark, sf):
    url = F.col("url")
    return views.table(spark, sf, "pages").select("page_id", vl.url_param(url, "page", "1").alias("page"), vl.url_param(url, "ref", "none").alias("ref"))


@query("noun_tokens", f"""WITH t AS (SELECT doc_id, {sql_tokens('text')} AS l FROM documents),
counts AS (SELECT token, count(*) AS n FROM (SELECT unnest(l) AS token FROM t) GROUP BY token),
parts AS (SELECT token, n, unnest(range(1, length(token) + 1)) AS k FROM counts WHERE length(token) <= {terms.MAX_STEM}),
held AS (SELECT left(token, k) AS part, sum(n) AS f FROM parts GROUP BY ALL),
stems AS (SELECT token, part AS stem FROM (
    SELECT token, k, h.part, round(pow(h.f / g.f, 1.0 / (k - 1)), 6) AS c FROM parts JOIN held h ON h.part = left(token, k) JOIN held g ON g.part = left(token, 1)
    WHERE k > 1) QUALIFY row_number() OVER (PARTITION BY token ORDER BY c DESC, k DESC) = 1
  UNION ALL SELECT token, token FROM counts WHERE length(token) > {terms.MAX_STEM}),
u AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS token FROM t),
joined AS (SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS nouns FROM u JOIN stems USING (token) WHERE NOT list_contains({sql_list(TEXT_TERMS)}, stem) GROUP BY doc_id)
SELECT doc_id, coalesce(nouns, '') AS nouns FROM documents LEFT JOIN joined USING (doc_id)""")
def _(spark, sf):
    documents = _documents(spark, sf).select("doc_id", "text")
    return terms.stemmed_nouns(documents, "doc_id", "text", terms.token_stems(documents, "text"), TEXT_TERMS)


@query("html_fields", r"""SELECT page_id, regexp_extract(html, '(?is)<title(?:\s[^>]*)?>(.*?)</title>', 1) AS title,
  regexp_extract(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1>', 1) AS heading,
  len(regexp_extract_all(html, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1)) AS paragraphs,
  contains(regexp_extract(html, '(?is)<title(?:\s[^>]*)?>(.*?)</title>', 1), 'th') AS is_target FROM pages""")
def _(spark, sf):
    html = F.col("html")
    return views.table(spark, sf, "pages").select(
        "page_id", hx.tag_text(html, "title").alias("title"), hx.tag_text(html, "h1").alias("heading"),
        F.size(hx.tag_texts(html, "p")).alias("paragraphs"), hx.tag_text(html, "title").contains("th").alias("is_target"),
    )


@query("html_links", r"""SELECT page_id, unnest(list_filter(regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"', 1),
  lambda h: h <> '' AND h <> '#' AND contains(h, 'th'))) AS link FROM pages""")
def _(spark, sf):
    return views.table(spark, sf, "pages").select("page_id", F.explode(hx.links(F.col("html"), "th")).alias("link"))


@query("array_slice_take", f"SELECT doc_id, array_to_string({sql_tokens('text')}[1:5], ' ') AS head FROM documents")
def _(spark, sf):
    return _documents(spark, sf).select("doc_id", F.array_join(vl.take_first(tx.tokens_of(F.col("text")), 5), " ").alias("head"))


# -- table functions in SQL

@query("sentence_rows", f"""SELECT doc_id, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS sentence
  FROM (SELECT doc_id, {sql_sentences('text')} AS l FROM documents)""")
def _(spark, sf):
    register_table_functions(spark)
    return spark.sql("SELECT d.doc_id, s.pos, s.sentence FROM {docs} d, LATERAL sentence_rows(d.text) s", docs=_documents(spark, sf))


@query("numbered_rows", """SELECT p_partkey, pos, CASE pos WHEN 1 THEN 'C - ' || p_name || ' - y' ELSE p_name END AS name,
       CASE WHEN pos = 0 THEN p_type ELSE '' END AS reason
FROM part CROSS JOIN (SELECT CAST(unnest(range(3)) AS INTEGER) AS pos)""")
def _(spark, sf):
    register_table_functions(spark)
    lines = F.concat(F.lit("1. "), "p_name", F.lit(" - "), "p_type", F.lit("\n2. C - "), "p_name", F.lit(" - y\n  "), "p_name")
    parts = views.texts(spark, sf, "part", "p_partkey", "p_name", "p_type").select("p_partkey", lines.alias("t"))
    return spark.sql("SELECT p.p_partkey, r.pos, r.name, r.reason FROM {parts} p, LATERAL numbered_rows(p.t) r", parts=parts)


@query("letter_counts", """SELECT source AS part, count(*) AS texts, CAST(sum(length(regexp_replace(text, '[^a-zA-Z]', '', 'g'))) AS BIGINT) AS letters,
  CAST(sum(length(regexp_replace(text, '[^aeiou]', '', 'g'))) AS BIGINT) AS vowels FROM documents GROUP BY source""")
def _(spark, sf):
    register_table_functions(spark)
    documents = views.table(spark, sf, "documents").select(F.col("source").alias("part"), "text")
    return spark.sql("SELECT * FROM letter_counts(TABLE(SELECT part, text FROM {docs}) PARTITION BY part)", docs=documents)
