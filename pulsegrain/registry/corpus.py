"""Term statistics, vectors, models and streams."""

from pyspark.sql import functions as F

from pulsegrain.functions import text as tx
from pulsegrain.operators import models, reshape, terms, vectors
from pulsegrain.registry.base import (
    COMMENTS, CLASSES, NEGATIVE, POSITIVE, TEXT_TERMS, query, sql_count, sql_list, sql_sentences, sql_tokens,
)
from pulsegrain.session import new_path, written
from pulsegrain.sources import files, views
from pulsegrain.streaming import streams


def _split(spark, sf):
    return reshape.explode_sentences(views.texts(spark, sf, "documents", "doc_id", "text"), "text")


# -- terms

@query("token_top_n", f"""WITH {COMMENTS}, t AS (SELECT lang, label, unnest({sql_tokens('content')}) AS token FROM comments WHERE label IS NOT NULL),
c AS (SELECT lang, label, token, count(*) AS n FROM t WHERE length(token) > 1 AND NOT list_contains({sql_list(TEXT_TERMS)}, token) GROUP BY ALL)
SELECT lang, label, token, n, CAST(row_number() OVER (PARTITION BY lang, label ORDER BY n DESC, token) AS INTEGER) AS rank FROM c QUALIFY rank <= 30""")
def _(spark, sf):
    labelled = views.comments(spark, sf).where("label IS NOT NULL").withColumn("nouns", tx.noun_tokens(F.col("content"), []))
    return terms.token_top_n(labelled, "nouns", ["lang", "label"], TEXT_TERMS)


def sql_tfidf(rows: str, key: str, text: str, group: str) -> str:
    return f"""tokens AS (SELECT {key} AS k, {group} AS g, unnest({sql_tokens(text)}) AS term FROM {rows}),
tf AS (SELECT k, g, term, count(*) AS tf FROM tokens GROUP BY ALL),
df AS (SELECT g, term, count(*) AS df FROM tf GROUP BY ALL),
size AS (SELECT {group} AS g, count(*) AS docs FROM {rows} GROUP BY ALL),
w AS (SELECT k, g, term, tf * (ln((1 + docs) / (1 + df)) + 1) AS w FROM tf JOIN df USING (g, term) JOIN size USING (g)),
norm AS (SELECT k AS nk, g AS ng, sqrt(sum(w * w)) AS norm FROM w GROUP BY ALL),
scored AS (SELECT g, term, round(sum(w / norm), 6) AS score FROM w JOIN norm ON k = nk AND g = ng GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY g ORDER BY score DESC, term) AS INTEGER) AS rank FROM scored)"""


@query("tfidf_top_n", f"WITH {sql_tfidf('documents', 'doc_id', 'text', 'lang')} SELECT g AS lang, term, score, rank FROM ranked WHERE rank <= 20")
def _(spark, sf):
    return terms.tfidf_top_n(views.texts(spark, sf, "documents", "doc_id", "text", "lang"), "doc_id", "text", "lang")


@query("term_frequency_top_n", f"""SELECT lang, term, n, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS INTEGER) AS rank FROM (
  SELECT lang, term, count(*) AS n FROM (SELECT lang, unnest({sql_tokens('text')}) AS term FROM documents) GROUP BY ALL) QUALIFY rank <= 20""")
def _(spark, sf):
    return terms.term_frequency_top_n(views.texts(spark, sf, "documents", "text", "lang"), "text", ["lang"])


SPLIT = f"s AS (SELECT list_distinct({sql_tokens('sentence')}) AS l FROM (SELECT unnest({sql_sentences('text')}) AS sentence FROM documents))"


@query("cooccurrence_top_n", f"""WITH {SPLIT} SELECT term, CAST(sum(n) AS BIGINT) AS score FROM (SELECT unnest(l) AS term, len(l) - 1 AS n FROM s)
  GROUP BY term ORDER BY score DESC, term LIMIT 20""")
def _(spark, sf):
    return terms.cooccurrence_top_n(_split(spark, sf), "sentence")


@query("cooccurrence_pairs", f"""WITH {SPLIT}, t AS (SELECT row_number() OVER () AS i, l FROM s), u AS (SELECT i, unnest(l) AS term FROM t),
c AS (SELECT a.term AS term_a, b.term AS term_b, count(*) AS n FROM u a JOIN u b ON a.i = b.i AND a.term <> b.term GROUP BY ALL)
SELECT term_a, term_b, n, CAST(row_number() OVER (PARTITION BY term_a ORDER BY n DESC, term_b) AS INTEGER) AS rank FROM c QUALIFY rank <= 20""")
def _(spark, sf):
    return terms.cooccurrence_pairs(_split(spark, sf), "sentence")


# The cosine from which two texts count as similar.
LEAST = 0.5


@query("count_vector_cosine", f"""WITH a AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({sql_tokens('text')}) AS term FROM documents) GROUP BY ALL),
b AS (SELECT item_id, term, count(*) AS n FROM (SELECT item_id, unnest({sql_tokens('text')}) AS term FROM benchmark) GROUP BY ALL),
na AS (SELECT doc_id, CAST(sum(n * n) AS BIGINT) AS s FROM a GROUP BY ALL), nb AS (SELECT item_id, CAST(sum(n * n) AS BIGINT) AS s FROM b GROUP BY ALL),
d AS (SELECT doc_id, item_id, CAST(sum(a.n * b.n) AS BIGINT) AS ab FROM a JOIN b USING (term) GROUP BY ALL)
SELECT doc_id, item_id, round(ab / sqrt(CAST(na.s AS DOUBLE) * nb.s), 6) AS cosine FROM d JOIN na USING (doc_id) JOIN nb USING (item_id) WHERE cosine >= {LEAST}""")
def _(spark, sf):
    return terms.count_vector_cosine(views.table(spark, sf, "documents"), views.table(spark, sf, "benchmark"), "doc_id", "item_id", "text", LEAST)


MATCHING = "kept AS (SELECT * FROM documents WHERE regexp_matches(text, 'thou|eaux|keit'))"


@query("keyword_extract", f"WITH {MATCHING}, {sql_tfidf('kept', 'doc_id', 'text', 'lang')} SELECT g AS lang, term, score, rank FROM ranked WHERE rank <= 20")
def _(spark, sf):
    return terms.keyword_extract(views.texts(spark, sf, "documents", "doc_id", "text", "lang"), "doc_id", "text", "lang", ["thou", "eaux", "keit"])


# -- vectors

CENTRES = """flat AS (SELECT label, unnest(range(len(embedding))) AS dim, unnest(embedding) AS x FROM embeddings),
means AS (SELECT label, dim, avg(CAST(x AS DOUBLE)) AS m FROM flat GROUP BY ALL),
centres AS (SELECT label AS query_id, list(m ORDER BY dim) AS query FROM means GROUP BY label)"""


def sql_near(k: int, condition: str) -> str:
    return f"""near AS (SELECT CAST(query_id AS BIGINT) AS query_id, vec_id AS id, round(list_cosine_similarity(query, CAST(embedding AS DOUBLE[])), 6) AS similarity
  FROM centres JOIN embeddings ON {condition}),
topk AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS INTEGER) AS rank FROM near QUALIFY rank <= {k})"""


def _centres(spark, sf):
    return vectors.mean_vectors(views.table(spark, sf, "embeddings"), "label", "embedding")


@query("vector_topk_filtered", f"WITH {CENTRES}, {sql_near(20, 'label = query_id')} SELECT query_id, id, similarity, rank FROM topk")
def _(spark, sf):
    return vectors.vector_topk(views.table(spark, sf, "embeddings"), _centres(spark, sf), 20, "vec_id", query_id="label", same="label")


@query("vector_topk", f"WITH {CENTRES}, {sql_near(3, 'true')} SELECT query_id, id, similarity, rank, label FROM topk JOIN embeddings ON id = vec_id")
def _(spark, sf):
    embeddings = views.table(spark, sf, "embeddings")
    near = vectors.vector_topk(embeddings, _centres(spark, sf), 3, "vec_id", query_id="label")
    return near.join(embeddings.select(F.col("vec_id").alias("id"), "label"), "id")


@query("vector_table_build", f"""WITH stacked AS (SELECT doc_id AS key, 'documents' AS source, text FROM documents UNION ALL SELECT item_id, 'benchmark', text FROM benchmark),
terms AS (SELECT key, source, CAST('0x' || left(md5(unnest({sql_tokens('text')})), 4) AS INTEGER) % 64 AS dim FROM stacked),
counts AS (SELECT key, source, dim, count(*) AS n FROM terms GROUP BY ALL),
maps AS (SELECT key, source, map_from_entries(list((dim, n))) AS m, sqrt(sum(n * n)) AS length FROM counts GROUP BY ALL)
SELECT source || '_' || no AS id, digest, source AS brand, no // 100 AS batch, dim, value FROM (
  SELECT source, md5(text) AS digest, no, unnest(range(64))::INTEGER AS dim, unnest(list_transform(range(64), lambda d: round(coalesce(m[d::INTEGER] / length, 0.0), 6))) AS value FROM (
    SELECT s.*, m, length, row_number() OVER (ORDER BY s.key, s.source) - 1 AS no FROM stacked s LEFT JOIN maps USING (key, source)))""")
def _(spark, sf):
    def embedded(name, key):
        return vectors.hashed_embedding(views.texts(spark, sf, name, key, "text").withColumnRenamed(key, "key"), "key", "text")

    built = vectors.vector_table([("documents", embedded("documents", "doc_id")), ("benchmark", embedded("benchmark", "item_id"))],
                                 "key", "text", "embedding", batch=100)
    path = files.full_refresh(built, new_path(spark, "vectors"))
    return spark.read.parquet(path).select(
        "id", F.md5(F.col("text").cast("binary")).alias("digest"), "brand", "batch", F.posexplode("embedding").alias("dim", "value")
    ).withColumn("value", F.round("value", 6))


# -- models

def sql_class(column: str) -> str:
    first, second = (sql_count(column, t) for t in CLASSES.values())
    return f"CASE WHEN greatest({first}, {second}) <= 0 THEN 'none' WHEN {first} >= {second} THEN 'first' ELSE 'second' END"


def sql_label(column: str) -> str:
    p, n = sql_count(column, POSITIVE), sql_count(column, NEGATIVE)
    return f"CASE WHEN {p} > {n} THEN '1' WHEN {p} < {n} THEN '0' END"


def sql_score(column: str) -> str:
    p, n = sql_count(column, POSITIVE), sql_count(column, NEGATIVE)
    return f"round(CAST(abs({p} - {n}) AS DOUBLE) / nullif({p} + {n}, 0), 6)"


# Folds that teach nothing: a quarter of the rows.
UNSEEN = ["0", "1", "2", "3"]

NEGATIONS = ["not", "no", "ne", "pas", "nicht", "kein", "ist"]

@query("sentiment_score", f"""WITH t AS (SELECT d.doc_id, {sql_tokens('text')} AS l, quality, left(md5(CAST(d.doc_id AS VARCHAR)), 1) IN {tuple(UNSEEN)} AS unseen
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
counts AS (SELECT term, count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality = 0) AS m
  FROM (SELECT quality, unnest(l) AS term FROM t WHERE quality IN (0, 1) AND NOT unseen) GROUP BY term),
w AS (SELECT sum(p) AS p, sum(m) AS m, count(*) AS v FROM counts),
lexicon AS (SELECT term, CAST(round((ln((c.p + 1.0) / (w.p + w.v)) - ln((c.m + 1.0) / (w.m + w.v))) * 1000000) AS BIGINT) AS units FROM counts c CROSS JOIN w),
u AS (SELECT doc_id, l[i] AS term, CASE WHEN list_has_any(l[greatest(i - 2, 1):i - 1], {sql_list(NEGATIONS)}) AND i > 1 THEN -1 ELSE 1 END AS sign
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM t)),
sums AS (SELECT doc_id, sum(sign * units) AS s, sum(abs(units)) AS w FROM u JOIN lexicon USING (term) GROUP BY doc_id)
SELECT doc_id, CASE WHEN s > 0 THEN '1' WHEN s < 0 THEN '0' END AS label, round(CAST(abs(s) AS DOUBLE) / nullif(w, 0), 6) AS score
FROM documents LEFT JOIN sums USING (doc_id)""")
def _(spark, sf):
    comments = views.comments(spark, sf)
    taught = comments.where(~models.fold_of(F.col("comment_id")).isin(UNSEEN))
    lexicon = written(models.learn_lexicon(taught, "content", "label"), "lexicon")
    return models.weighted_sentiment(comments, "comment_id", "content", lexicon, NEGATIONS).withColumnRenamed("comment_id", "doc_id")


def _labelled(spark, sf):
    """Documents with one of three classes from their labels."""
    return views.comments(spark, sf).where("label IS NOT NULL").withColumn(
        "class", F.when(F.col("toxic") == 1, "second").when(F.col("label") == 1, "first").otherwise("none")
    )


BAYES = f"""rows AS (SELECT d.doc_id, text, left(md5(CAST(d.doc_id AS VARCHAR)), 1) IN {tuple(UNSEEN)} AS unseen,
  CASE WHEN quality IS NULL THEN NULL WHEN toxic = 1 THEN 'second' WHEN quality = 1 THEN 'first' ELSE 'none' END AS class
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
tokens AS MATERIALIZED (SELECT doc_id, class, unseen, term, count(*) AS tf FROM (SELECT doc_id, class, unseen, unnest({sql_tokens('text')}) AS term FROM rows) GROUP BY ALL),
taught AS (SELECT class, term, sum(tf) AS n FROM tokens WHERE class IS NOT NULL AND NOT unseen GROUP BY ALL),
prior AS (SELECT class, count(*) AS r FROM rows WHERE class IS NOT NULL AND NOT unseen GROUP BY ALL),
classes AS (SELECT class, ln(r / sum(r) OVER ()) AS prior, ln((SELECT coalesce(sum(n), 0) FROM taught t WHERE t.class = p.class)
            + (SELECT count(DISTINCT term) FROM taught)) AS scale FROM prior p),
known AS (SELECT doc_id, sum(tf) AS k FROM tokens WHERE term IN (SELECT term FROM taught) GROUP BY ALL),
sums AS (SELECT doc_id, t.class, sum(tf * ln(n + 1.0)) AS w FROM tokens JOIN taught t USING (term) GROUP BY ALL),
scored AS (SELECT r.doc_id, c.class, round(prior + coalesce(w, 0) - coalesce(k, 0) * scale, 6) AS s FROM (SELECT DISTINCT doc_id FROM rows) r CROSS JOIN classes c
  LEFT JOIN known USING (doc_id) LEFT JOIN sums ON sums.doc_id = r.doc_id AND sums.class = c.class),
predicted AS (SELECT doc_id, class AS predicted FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, class) = 1)"""


def _bayes(spark, sf):
    taught = _labelled(spark, sf).where(~models.fold_of(F.col("comment_id")).isin(UNSEEN))
    return models.bayes_model(taught, "comment_id", "content", "class")


@query("train_text_classifier", f"""WITH {BAYES} SELECT class, predicted, count(*) AS n FROM rows JOIN predicted USING (doc_id) WHERE class IS NOT NULL AND unseen GROUP BY ALL""")
def _(spark, sf):
    # The confusion matrix of the rows that taught nothing.
    unseen = _labelled(spark, sf).where(models.fold_of(F.col("comment_id")).isin(UNSEEN))
    scored = models.bayes_classify(unseen, "comment_id", "content", *_bayes(spark, sf))
    return unseen.select("comment_id", "class").join(scored, "comment_id").groupBy("class", "predicted").agg(F.count(F.lit(1)).alias("n"))


@query("text_classify", f"WITH {BAYES} SELECT doc_id AS comment_id, predicted FROM predicted")
def _(spark, sf):
    return models.bayes_classify(views.comments(spark, sf), "comment_id", "content", *_bayes(spark, sf)).select("comment_id", "predicted")


@query("vectorised_udf_surface", """SELECT doc_id, CASE WHEN 3 * v > a THEN '1' ELSE '0' END AS label, CAST(v AS DOUBLE) AS score FROM (
  SELECT doc_id, length(regexp_replace(text, '[^aeiou]', '', 'g')) AS v, length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) AS a FROM documents)""")
def _(spark, sf):
    def load():
        """A stand-in for a text model: vowels make up more than a third of the letters."""

        def score(batch):
            for_each = []
            for text in batch:
                letters = sum(c.isascii() and c.isalpha() for c in text)
                vowels = sum(text.count(v) for v in "aeiou")
                for_each.append(("1" if 3 * vowels > letters else "0", float(vowels)))
            return for_each

        return score

    return models.scored_by_model(views.texts(spark, sf, "documents", "doc_id", "text"), "text", load).select("doc_id", "label", "score")


# -- streams

def _stream(spark, sf):
    schema = views.table(spark, sf, "events").schema
    stream = streams.stream_files(spark, f"{sf}/events.parquet*", schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_ingest", "SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS ds FROM events")
def _(spark, sf):
    target, checkpoint = new_path(spark, "ingested"), new_path(spark, "state")
    for _run in range(2):
        streams.stream_ingest(_stream(spark, sf), "ts", target, checkpoint)
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", F.col("ds").cast("string").alias("ds"))


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, sf):
    target, checkpoint = new_path(spark, "distinct"), new_path(spark, "state")
    streams.stream_dedup(_stream(spark, sf).select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "60 days", target, checkpoint)
    return spark.read.parquet(target).select("user_id", "event_type")


@query("stream_trend", "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(spark, sf):
    target, checkpoint = new_path(spark, "trend"), new_path(spark, "state")
    streams.stream_trend(_stream(spark, sf), "ts", "event_type", "1 day", "60 days", target, checkpoint)
    trend = streams.read_trend(spark, target, "event_type")
    return trend.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
