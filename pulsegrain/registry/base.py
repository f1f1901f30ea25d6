"""Where queries and their SQL twins are filed, and the pieces they share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Keywords, classes and word lists for the supplied tables.
KEYWORDS = ["small", "red", "hot", "widget", "gear"]
TEXT_TERMS = ["the", "of", "and", "to", "in"]
CLASSES = {"first": ["the", "tion", "and"], "second": ["les", "eau", "que"]}
POSITIVE = ["on", "er", "la"]
NEGATIVE = ["in", "th", "de"]
RUN_DATE = "1998-06-01"
EVENT_DATE = "2024-01-15"
AS_OF = "2001-11-15"
ANY_LETTER = r"\p{L}\p{N}"

SPACE = r"[\s\x0b\x{85}\p{Z}]"


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """File a query under ``key`` with the SQL that must give the same rows."""

    def file(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return file


# -- SQL pieces

def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values: Sequence[str]) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


def sql_strip(column: str) -> str:
    return f"regexp_replace({column}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_count(column: str, terms: Sequence[str]) -> str:
    """Occurrences of all terms in a column."""
    return "(" + " + ".join(
        f"(length({column}) - length(replace({column}, {sql_text(t)}, ''))) // {len(t)}" for t in terms
    ) + ")"


def sql_any(column: str, terms: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {sql_text(t)})" for t in terms) + ")"


def sql_sentences(column: str) -> str:
    found = rf"regexp_extract_all({column}, '[^.!?…\n]+[.!?…]*')"
    return f"list_filter(list_transform({found}, lambda s: {sql_strip('s')}), lambda s: s <> '')"


def sql_lines(column: str) -> str:
    return f"list_filter(list_transform(string_split({column}, chr(10)), lambda s: {sql_strip('s')}), lambda s: s <> '')"


def sql_tokens(column: str) -> str:
    return rf"regexp_extract_all(lower({column}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def sql_clean(column: str, stopwords: Sequence[str], keep: str = ANY_LETTER) -> str:
    """Cleaning without the jamo step, which the supplied texts do not need."""
    text = rf"regexp_replace({column}, '\b\d{{1,2}}:\d{{2}}\b', '', 'g')"
    text = rf"regexp_replace({text}, '[^{keep}\s\x0b\x{{85}}\p{{Z}}]', '', 'g')"
    text = rf"regexp_replace({text}, '(?i)(https?://|www\.)\S+|https\S+|http\S+', '', 'g')"
    words = rf"regexp_extract_all({text}, '[\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}]+')"
    return f"array_to_string(list_filter({words}, lambda w: NOT list_contains({sql_list(stopwords)}, w)), ' ')"


def sql_normalize(column: str, rules: Sequence[tuple[str, str]], fixups: Sequence[tuple[str, str]]) -> str:
    text = f"lower({column})"
    for pattern, name in rules:
        text = rf"regexp_replace({text}, '(^|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}]){pattern.replace('(max)', '(?:max)')}', '\1{name}', 'g')"
    text = sql_strip(f"regexp_replace({text}, '{SPACE}+', ' ', 'g')")
    for old, new in fixups:
        text = f"replace({text}, {sql_text(old)}, {sql_text(new)})"
    return text


SENTENCES = """sentences AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_orderkey AS order_id,
         p_name AS sentence, p_brand AS brand,
         CASE l_returnflag WHEN 'A' THEN '1' WHEN 'R' THEN '0' END AS sentiment_label,
         l_discount AS sentiment_score, CAST(l_quantity AS INTEGER) AS like_count, l_shipdate AS commented_at
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

REQUESTS = """requests AS (
  SELECT o_orderkey AS request_id, c_custkey AS user_id, n_nationkey AS hobby_id, n_name AS hobby,
         c_mktsegment AS gender, o_orderpriority AS age_group, [o_orderstatus, c_mktsegment] AS keywords,
         o_totalprice AS amount, o_orderdate AS updated_at
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

COMMENTS = """comments AS (
  SELECT d.doc_id AS comment_id, d.text AS content, d.source, d.lang, l.quality AS label, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def keyword_table(keywords: Sequence[str], name: str = "keywords") -> str:
    return f"{name} AS (SELECT unnest({sql_list(keywords)}) AS keyword)"


HITS = f"""{SENTENCES}, {keyword_table(KEYWORDS)},
hits AS (SELECT s.*, strftime(commented_at, '%Y-%m') AS month, keyword
         FROM sentences s JOIN keywords ON contains(sentence, keyword))"""

TREND = f"""{HITS},
cells AS (SELECT brand, month, keyword, count(*) AS n, count(*) FILTER (sentiment_label = '1') AS p,
                 count(*) FILTER (sentiment_label = '0') AS m FROM hits GROUP BY ALL),
trend AS (SELECT brand, month, keyword, round(n / sum(n) OVER (PARTITION BY brand, month), 4) AS ratio,
                 round(p / n, 4) AS pos_ratio, round(m / n, 4) AS neg_ratio FROM cells)"""

SHARE_STEPS = """counted AS (SELECT b.brand, k.keyword, count(h.id) AS n
            FROM (SELECT DISTINCT brand FROM sentences) b CROSS JOIN keywords k
            LEFT JOIN hits h ON h.brand = b.brand AND h.keyword = k.keyword GROUP BY ALL),
share AS (SELECT brand, keyword,
                 CASE WHEN sum(n) OVER w = 0 THEN 0.0 ELSE round(n / sum(n) OVER w * 100, 2) END AS pct
          FROM counted WINDOW w AS (PARTITION BY brand))"""

SHARE = f"{HITS}, {SHARE_STEPS}"

SCORES = f"""{HITS},
scores AS (
  SELECT brand, keyword,
         coalesce(round(CAST(sum(CAST(sentiment_score AS DECIMAL(18,6))) FILTER (sentiment_label = '1') AS DOUBLE)
                  / count(*) FILTER (sentiment_label = '1'), 4), 0.0) AS pos,
         coalesce(round(CAST(sum(CAST(sentiment_score AS DECIMAL(18,6))) FILTER (sentiment_label = '0') AS DOUBLE)
                  / count(*) FILTER (sentiment_label = '0'), 4), 0.0) AS neg
  FROM hits GROUP BY ALL)"""

OVERALL = """overall AS (
  SELECT brand, round(count(*) FILTER (sentiment_label = '1') / count(*), 4) AS pos,
         round(count(*) FILTER (sentiment_label = '0') / count(*), 4) AS neg
  FROM sentences WHERE sentiment_label IN ('1', '0') GROUP BY brand)"""

BEST = """best AS (
  SELECT brand, keyword, CASE sentiment_label WHEN '1' THEN 'pos' ELSE 'neg' END AS sentiment, sentence,
         sentiment_score, like_count, order_id
  FROM hits WHERE sentiment_label IN ('1', '0')
  QUALIFY row_number() OVER (PARTITION BY brand, keyword, sentiment_label
                             ORDER BY sentiment_score DESC, like_count DESC, sentence, id) = 1)"""

GRID = """grid AS (
  SELECT brand, keyword, sentiment FROM (SELECT DISTINCT p_brand AS brand FROM part)
  CROSS JOIN keywords CROSS JOIN (SELECT unnest(['pos', 'neg']) AS sentiment))"""
