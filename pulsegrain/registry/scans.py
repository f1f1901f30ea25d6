"""Sources, sinks and load rules."""

from pyspark.sql import functions as F

from pulsegrain import lexicons
from pulsegrain.functions import values as vl
from pulsegrain.registry.base import EVENT_DATE, RUN_DATE, query
from pulsegrain.session import new_path
from pulsegrain.sources import files, views
from pulsegrain.streaming import streams


def _staged_events(spark, sf):
    events = views.table(spark, sf, "events").withColumn("ds", F.to_date("ts"))
    return files.overwrite_partitions(events, new_path(spark, "events"))


@query("partition_scan", f"SELECT event_id, event_type, value FROM events WHERE CAST(ts AS DATE) = DATE '{EVENT_DATE}'")
def _(spark, sf):
    return files.read_partition(spark, _staged_events(spark, sf), EVENT_DATE, ["event_id", "event_type", "value"])


@query("multi_partition_scan", "SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS ds FROM events")
def _(spark, sf):
    staged = files.read_partitions(spark, _staged_events(spark, sf))
    return staged.select("event_id", "user_id", F.col("ds").cast("string").alias("ds"))


def _profile_sql():
    columns = {
        "region": ["r_regionkey", "r_name"],
        "nation": ["n_nationkey", "n_name", "n_regionkey"],
        "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
        "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
        "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                     "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
        "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
        "documents": ["doc_id", "text", "lang", "source", "n_chars"],
        "embeddings": ["vec_id", "embedding", "label"],
        "pages": ["page_id", "url", "html"],
        "benchmark": ["item_id", "text"],
        "labels": ["doc_id", "quality", "toxic"],
        "conversations": ["conv_id", "turn", "role", "text"],
    }
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, '{c}' AS column_name, {i} AS position, "
        f"count(*) - count({c}) AS n_null FROM {t}"
        for t, cs in columns.items() for i, c in enumerate(cs, 1)
    )


@query("table_profile", _profile_sql())
def _(spark, sf):
    return files.table_profile({t: views.table(spark, sf, t) for t in views.TABLES})


@query("csv_roundtrip", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _(spark, sf):
    part = views.table(spark, sf, "part")
    return files.read_csv(spark, files.write_csv(part, new_path(spark, "csv")), part.schema, multi_line=False)


@query("catalogue_load", """SELECT p_partkey, p_brand || '의 ' || p_name || '은 ' || p_size ||
       '년에 출시된 스마트폰으로, 주요 사양은 ' || p_type || '입니다.' AS description FROM part""")
def _(spark, sf):
    listed = files.read_catalogue(views.table(spark, sf, "part"), lexicons.CATALOGUE_TEMPLATE, "p_brand", "p_name", "p_size", "p_type")
    return listed.select("p_partkey", "description")


@query("filtered_scan", "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en'")
def _(spark, sf):
    return files.read_filtered(views.table(spark, sf, "documents"), F.col("lang") == "en", ["doc_id", "source", "n_chars"])


@query("wordlist_source", "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part")
def _(spark, sf):
    path = new_path(spark, "words")
    views.table(spark, sf, "part").select(F.explode(F.split("p_name", " "))).write.text(path)
    return files.read_wordlist(spark, path)


@query("nested_json_source", """SELECT CAST(conv_id AS VARCHAR) AS video_id, text AS comment,
       CAST(turn AS INTEGER) AS like_count, role AS published_at FROM conversations""")
def _(spark, sf):
    path = new_path(spark, "responses")
    reply = F.struct(F.struct(F.struct(F.struct(
        F.col("text").alias("textDisplay"), F.col("turn").alias("likeCount"), F.col("role").alias("publishedAt"),
    ).alias("snippet")).alias("topLevelComment")).alias("snippet"))
    # A response page holds at most 50 items.
    pages = views.table(spark, sf, "conversations") \
        .groupBy(F.col("conv_id").cast("string").alias("videoId"), F.floor(F.col("turn") / 50).alias("page")) \
        .agg(F.collect_list(reply).alias("items"))
    pages.drop("page").write.json(path)
    return files.read_comments(spark, path)


@query("parquet_sink", "SELECT doc_id, lang, source, n_chars, md5(text) AS digest FROM documents")
def _(spark, sf):
    root = files.write_by_source(views.table(spark, sf, "documents"), new_path(spark, "by-source"), "source")
    return spark.read.parquet(root).select("doc_id", "lang", "source", "n_chars", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("stage_partition_overwrite", f"""SELECT event_id, strftime(ts, '%Y-%m-%d') AS ds,
       CASE WHEN CAST(ts AS DATE) >= DATE '{EVENT_DATE}' THEN event_type || '-again' ELSE event_type END AS event_type
       FROM events""")
def _(spark, sf):
    root = _staged_events(spark, sf)
    events = views.table(spark, sf, "events").withColumn("ds", F.to_date("ts"))
    again = events.where(vl.on_or_after(F.col("ts"), EVENT_DATE)).withColumn("event_type", F.concat("event_type", F.lit("-again")))
    for _run in range(2):
        files.overwrite_partitions(again, root)
    return files.read_partitions(spark, root).select("event_id", F.col("ds").cast("string").alias("ds"), "event_type")


@query("replace_from_date", f"""SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '{EVENT_DATE}' THEN value + 1 ELSE value END AS value
       FROM events""")
def _(spark, sf):
    events = views.table(spark, sf, "events").select("event_id", "ts", "value")
    path = files.full_refresh(events, new_path(spark, "target"))
    new = events.withColumn("value", F.col("value") + 1)
    for _run in range(2):
        path = files.load_from_date(spark, path, new, "ts", EVENT_DATE)
    return spark.read.parquet(path)


@query("full_refresh", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, sf):
    path = files.full_refresh(views.table(spark, sf, "customer"), new_path(spark, "refresh"))
    files.full_refresh(views.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    return spark.read.parquet(path)


@query("insert_if_absent", """SELECT doc_id, (SELECT max(analysis_id) FROM (SELECT doc_id * 10 AS analysis_id FROM labels))
       + row_number() OVER (ORDER BY doc_id) AS analysis_id
       FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _(spark, sf):
    stored = views.table(spark, sf, "labels").select("doc_id", (F.col("doc_id") * 10).alias("analysis_id"))
    new = views.table(spark, sf, "documents").select("doc_id", F.col("doc_id").alias("seen"))
    return files.insert_if_absent(stored, new, ["doc_id"], "analysis_id", "seen")


@query("merge_result_fields", """
WITH old AS (SELECT event_id, 'k' AS field, json_extract_string(props, '$.k') AS value FROM events),
fresh AS (SELECT event_id, unnest(['k', 'type']) AS field, unnest([CAST(user_id AS VARCHAR), event_type]) AS value
          FROM events WHERE event_type <> 'view')
SELECT event_id, field, coalesce(fresh.value, old.value) AS value
FROM old FULL JOIN fresh USING (event_id, field)""")
def _(spark, sf):
    events = views.table(spark, sf, "events")
    fresh = events.where(F.col("event_type") != "view").select(
        "event_id", F.to_json(F.struct(F.col("user_id").cast("string").alias("k"), F.col("event_type").alias("type"))).alias("props")
    )
    return files.merge_fields(events.select("event_id", "props"), fresh, "event_id", "props")


# The times up to which the first runs find events.
RUN_ENDS = ["2024-01-11", "2024-01-21"]


@query("incremental_since", f"""SELECT event_id, ts, event_type,
  CAST(CASE WHEN ts <= TIMESTAMP '{RUN_ENDS[0]}' THEN 0 WHEN ts <= TIMESTAMP '{RUN_ENDS[1]}' THEN 1 ELSE 2 END AS INTEGER) AS batch FROM events""")
def _(spark, sf):
    # Every run finds all events so far, and the second one comes twice.
    events = views.table(spark, sf, "events").select("event_id", "ts", "event_type")
    slices = [events.where(F.col("ts") <= F.lit(end).cast("timestamp_ntz")) for end in RUN_ENDS] + [events]
    root = new_path(spark, "since")
    for batch in (0, 1, 1, 2):
        streams.ingest_batch(slices[batch], batch, "ts", root)
    return spark.read.parquet(f"{root}/rows")


@query("date_filter", f"SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '{RUN_DATE}'")
def _(spark, sf):
    items = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return items.where(vl.on_or_after(F.col("l_shipdate"), RUN_DATE))
