"""Sources, sinks, load rules and streams on small tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsegrain import lexicons
from pulsegrain.functions import values as vl
from pulsegrain.plans import enrich, loads, report
from pulsegrain.session import new_path, shared_folder
from pulsegrain.sources import files, jdbc
from pulsegrain.streaming import streams

STAGED = "video_id string, title string, comment string, like_count int, comment_publish_date string, ds date"


@pytest.fixture(scope="module")
def staged(spark):
    return spark.createDataFrame([
        ("v1", "t", "좋다", 1, "2025-01-02T00:00:00Z", datetime(2025, 1, 3).date()),
        ("v1", "t", "좋다", 9, "2025-01-02T00:00:00Z", datetime(2025, 1, 3).date()),
        ("v1", "t", None, 0, "2025-01-03T10:00:00Z", datetime(2025, 1, 3).date()),
        ("v2", "t", "old", 0, "2024-12-30T00:00:00Z", datetime(2025, 1, 3).date()),
    ], STAGED)


def test_comment_load_replaces_its_day(spark, staged, rows):
    root = new_path(spark, "comments")
    undated = staged.limit(1).withColumn("comment", F.lit("undated")).withColumn("comment_publish_date", F.lit("?"))
    loads.comment_load(staged.where("video_id = 'v2'"), root, "2025-01-02")
    loads.comment_load(staged.where("video_id = 'v2'"), root, "2025-01-03")
    for _run in range(2):
        once = loads.comment_load(staged.unionByName(undated), root, "2025-01-03")
    assert rows(once.select("video_id", "content", "like_count", F.col("ds").cast("string"))) == sorted([
        ("v2", "old", 0, "2025-01-02"), ("v1", "MISSING", 0, "2025-01-03"), ("v1", "undated", 1, "2025-01-03"),
        ("v1", "좋다", 9, "2025-01-03"), ("v2", "old", 0, "2025-01-03")], key=repr)
    assert loads.comment_load(staged.limit(0), root, "2025-01-03").count() == 5


def test_review_load(spark, rows):
    staged = spark.createDataFrame([("5점", "m", "2025.01.02", "t", "good", "S24"), ("5점", "m", "25.01.02", "t", "good", "S24"),
                                    ("bad", "m", "?", "t", None, "S24")],
                                   "scoring string, market string, purchasing_date string, review_title string, review_content string, item string")
    assert rows(loads.prepared_reviews(staged), "item_name", "content", "rating") == [("S24", "MISSING", None), ("S24", "good", 5)]


def test_partition_overwrite_touches_only_its_day(spark, staged, rows):
    root = new_path(spark, "staged")
    files.overwrite_partitions(staged, root)
    later = staged.withColumn("ds", F.lit("2025-01-04").cast("date"))
    files.overwrite_partitions(later, root)
    files.overwrite_partitions(later.limit(1), root)
    assert rows(files.read_partitions(spark, root).groupBy(F.col("ds").cast("string")).count()) == [("2025-01-03", 4), ("2025-01-04", 1)]
    plan = files.read_partition(spark, root, "2025-01-04", ["comment"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan and "ReadSchema: struct<comment:string>" in plan
    assert files.read_partition(spark, root, "2025-01-04", ["comment"]).columns == ["comment"]


def test_csv_keeps_awkward_texts(spark, rows):
    df = spark.createDataFrame([(1, 'a "quoted", text'), (2, "two\nlines"), (3, None)], "id int, t string")
    assert rows(files.read_csv(spark, files.write_csv(df, new_path(spark, "csv")), df.schema)) == rows(df)


def test_nested_responses(spark, rows):
    path = new_path(spark, "json")
    spark.createDataFrame([(
        '{"items":[{"id":{"videoId":"v"},"snippet":{"title":"T","publishedAt":"p","channelTitle":"c"}}]}',)], "value string").write.text(path)
    assert rows(files.read_videos(spark, path)) == [("v", "T", "p", "c")]


def test_insert_if_absent(spark, rows):
    target = spark.createDataFrame([("a", 7)], "name string, hobby_id long")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4)], "name string, o long")
    assert rows(files.insert_if_absent(target, new, ["name"], "hobby_id", "o")) == [("b", 8), ("c", 9)]


def test_merge_fields(spark, rows):
    old = spark.createDataFrame([(1, '{"a":"1","b":"2"}'), (2, "{bad"), (3, None)], "id int, j string")
    new = spark.createDataFrame([(1, '{"b":"3"}'), (2, '{"c":"4"}')], "id int, j string")
    assert rows(files.merge_fields(old, new, "id", "j")) == [(1, "a", "1"), (1, "b", "3"), (2, "c", "4")]
    merged = old.select(files.merge_json(F.col("j"), F.create_map(F.lit("b"), F.lit("x"))).alias("j"))
    assert [r[0] for r in merged.collect()] == ['{"a":"1","b":"x"}', '{"b":"x"}', '{"b":"x"}']


def test_marks(spark, staged):
    df = loads.prepared_comments(staged)
    assert files.next_mark(df, "commented_at") == datetime(2025, 1, 3, 10)
    assert files.next_mark(df.limit(0), "commented_at", datetime(2025, 1, 8)) == datetime(2025, 1, 1)
    assert files.collected_since(df, "commented_at", F.lit("2025-01-02").cast("timestamp_ntz")).count() == 1


def test_jdbc_options():
    read = jdbc.scan_options("jdbc:x", "t", {"user": "u"}, partition_column="id", lower=0, upper=100, partitions=4)
    assert read["partitionColumn"] == "id" and read["numPartitions"] == "4" and read["user"] == "u"
    with pytest.raises(ValueError):
        jdbc.scan_options("jdbc:x", "t", partition_column="id")
    assert "partitionColumn" not in jdbc.scan_options("jdbc:x", "t")
    assert jdbc.sink_options("jdbc:x", "t")["batchsize"] == "5000"
    assert jdbc.sink_options("jdbc:x", "t", truncate=True)["truncate"] == "true"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_enrichment_in_korean(spark, rows):
    df = spark.createDataFrame([("S24 화면 좋다! 날씨 좋다.",), ("S24 화면 좋다! 날씨 좋다.",), ("only english",), (" ",)], "t string")
    classes = {"samsung": lexicons.SAMSUNG_TERMS, "apple": ["아이폰"]}
    done = enrich.comment_enrich(df, "t", classes, ["좋다"], ["나쁘다"])
    assert rows(done, "sentence", "brand", "sentiment_label", "sentiment_score") == [("갤럭시 화면 좋다", "samsung", "1", 1.0)]
    whole = enrich.comment_enrich(df, "t", classes, ["좋다"], ["나쁘다"], split_first=False)
    assert rows(whole, "sentence") == [("갤럭시 화면 좋다 날씨 좋다",)]


def test_reviews_with_unknown_brand(spark, rows):
    df = spark.createDataFrame([("갤럭시 S24 256GB", "삼성 화면 좋다", "5"), ("기타", "삼성 별로", None)], "item string, t string, r string")
    done = enrich.review_enrich(df, "item", "t", "r", lexicons.REVIEW_BRANDS, lexicons.BRAND_IDS, ["삼성"], ["좋다"], ["별로"])
    assert rows(done, "brand_id", "sentiment_label", "rating", "nouns") == [(1, "1", 5, "삼성 화면 좋다"), (None, "0", 0, "삼성 별로")]


def test_results_are_reused_whatever_the_keyword_order(spark, rows):
    requests = spark.createDataFrame([(1, 5, ["b", "a"], "20s", "M"), (2, 5, ["a"], "20s", "M"), (3, 5, ["a", "b"], "30s", "M")],
                                     "request_id long, hobby_id long, keywords array<string>, age_group string, gender string")
    results = spark.createDataFrame([(10, 5, ["a", "b"], "20s", "M", 1), (11, 5, ["a", "b"], "20s", "M", 2)],
                                    "analysis_id long, hobby_id long, keywords array<string>, age_group string, gender string, updated_at long")
    stored = results.withColumn("keywords_hash", vl.keywords_hash(F.col("keywords"))).drop("keywords")
    assert rows(report.reuse_results(requests, stored)) == [(1, 11), (2, None), (3, None)]


# -- streams

EVENTS = "user string, kind string, ts timestamp"


@pytest.fixture
def feed(spark):
    path = new_path(spark, "feed")

    def add(*given):
        spark.createDataFrame(list(given), EVENTS).coalesce(1).write.mode("append").parquet(path)
        return streams.stream_files(spark, path, spark.createDataFrame([], EVENTS).schema, per_trigger=1)

    return add


def at(day, hour=0):
    return datetime(2025, 1, day, hour)


def test_ingest_takes_each_file_once(spark, feed, rows):
    target, state = new_path(spark, "t"), new_path(spark, "s")
    streams.stream_ingest(feed(("u", "a", at(1)), ("v", "a", at(2))), "ts", target, state)
    stream = feed(("w", "b", at(2)))
    for _ in range(2):
        streams.stream_ingest(stream, "ts", target, state)
    assert rows(spark.read.parquet(target), "user", "kind") == [("u", "a"), ("v", "a"), ("w", "b")]


def test_dedup_over_batches(spark, feed, rows):
    target, state = new_path(spark, "t"), new_path(spark, "s")
    feed(("u", "a", at(1)), ("u", "a", at(1, 1)))
    stream = feed(("u", "a", at(2)), ("u", "b", at(2)))
    streams.stream_dedup(stream, ["user", "kind"], "ts", "10 days", target, state)
    assert rows(spark.read.parquet(target), "user", "kind") == [("u", "a"), ("u", "b")]


def test_trend_equals_batch(spark, feed, rows):
    target, state = new_path(spark, "t"), new_path(spark, "s")
    first = [("u", k, at(d, h)) for d in (1, 2) for h in range(5) for k in "ab"]
    streams.stream_trend(feed(*first), "ts", "kind", "1 day", "10 days", target, state)
    streams.stream_trend(feed(("u", "a", at(1, 9)), ("u", "c", at(3))), "ts", "kind", "1 day", "10 days", target, state)
    got = rows(streams.read_trend(spark, target, "kind").select(F.dayofmonth("window_start").alias("d"), "kind", "n"))
    assert got == [(1, "a", 6), (1, "b", 5), (2, "a", 5), (2, "b", 5), (3, "c", 1)]


def test_rows_behind_the_watermark_are_dropped(spark, feed, rows):
    seen, seen_state, counts, count_state = (new_path(spark, n) for n in ("t", "s", "t", "s"))

    def run(stream):
        streams.stream_dedup(stream, ["user", "kind"], "ts", "1 hour", seen, seen_state)
        streams.stream_trend(stream, "ts", "kind", "1 day", "1 hour", counts, count_state)

    run(feed(("u", "a", at(1)), ("u", "b", at(5))))
    run(feed(("w", "b", at(5, 1))))
    run(feed(("late", "a", at(1, 1)), ("x", "b", at(5, 2))))
    assert rows(spark.read.parquet(seen), "user", "kind") == [("u", "a"), ("u", "b"), ("w", "b"), ("x", "b")]
    got = rows(streams.read_trend(spark, counts, "kind").select(F.dayofmonth("window_start").alias("d"), "kind", "n"))
    assert got == [(1, "a", 1), (5, "b", 3)]


def test_loads_keep_undated_rows_and_name_the_rejected(spark, rows):
    schema = "id int, ts timestamp_ntz"
    day = __import__("datetime").datetime
    target = spark.createDataFrame([(1, day(2024, 1, 1)), (2, None), (3, day(2024, 2, 2))], schema)
    new = spark.createDataFrame([(4, day(2024, 2, 1)), (5, None), (6, day(2024, 1, 31))], schema)
    assert rows(files.replace_from_date(target, new, "ts", "2024-02-01"), "id") == [(1,), (2,), (4,)]
    assert rows(files.rejected_from_date(new, "ts", "2024-02-01"), "id") == [(5,), (6,)]


def test_stop_words_may_come_from_a_table(spark, rows):
    words = spark.createDataFrame([("화면",), (None,), ("좋다",), ("좋다",)], "word string")
    df = spark.createDataFrame([("갤럭시", "삼성 화면 정말 좋다. 화면 좋다", "5"), ("갤럭시", "삼성 화면 정말 좋다. 화면 좋다", "5"), ("기타", "삼성 별로", None)], "item string, t string, r string")
    given = ["item", "t", "r", lexicons.REVIEW_BRANDS, lexicons.BRAND_IDS, ["삼성"], ["정말"], ["별로"]]
    from_table, from_list = (rows(enrich.review_enrich(df, *given, stopwords=s)) for s in (words, ["화면", "좋다"]))
    assert from_table == from_list and len(from_table) == 3


def test_marks_move_once_per_batch(spark, rows):
    from pulsegrain.session import new_path

    day = __import__("datetime").datetime
    table = spark.createDataFrame([(i, day(2024, 1, i) if i else None) for i in range(9)], "id int, ts timestamp_ntz")
    root = new_path(spark, "since")
    for last, batch, mark in ((3, 0, 3), (6, 1, 6), (6, 1, 6), (6, 2, 6), (8, 3, 8), (4, 4, 8)):
        streams.ingest_batch(table.where(f"id <= {last}"), batch, "ts", root)
        assert streams.stored_mark(spark, root) == day(2024, 1, mark)
    got = rows(spark.read.parquet(f"{root}/rows"), "id", "batch")
    assert got == [(1, 0), (2, 0), (3, 0), (4, 1), (5, 1), (6, 1), (7, 3), (8, 3)]


def test_a_stream_keeps_its_mark(spark, rows):
    from pulsegrain.session import new_path

    day = __import__("datetime").datetime
    source, root, state = (new_path(spark, n) for n in ("in", "since", "state"))
    for first, last in ((1, 4), (3, 6), (5, 7)):
        spark.createDataFrame([(i, day(2024, 1, i)) for i in range(first, last + 1)], "id int, ts timestamp_ntz").write.mode("append").parquet(source)
        streams.stream_since(streams.stream_files(spark, source, spark.read.parquet(source).schema), "ts", root, state)
    assert rows(spark.read.parquet(f"{root}/rows"), "id") == [(i,) for i in range(1, 8)]


def test_table_functions_equal_columns(spark, rows):
    from pulsegrain.functions.tables import register_table_functions
    from pulsegrain.operators import reshape

    register_table_functions(spark)
    texts = ["One. Two!  Three?", None, "", " \u00a0\n.", "1. a - b\nplain\n2. x - y - z", "3. solo\t\n- "]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    lateral = spark.sql("SELECT d.id, s.* FROM {df} d, LATERAL sentence_rows(d.t) s", df=df)
    assert rows(lateral) == rows(reshape.explode_sentences(df, "t").select("id", "pos", "sentence"))
    lateral = spark.sql("SELECT d.id, s.* FROM {df} d, LATERAL numbered_rows(d.t) s", df=df)
    assert rows(lateral) == rows(reshape.parse_numbered_list(df, "t").select("id", "pos", "name", "reason"))
    counts = spark.sql("SELECT * FROM letter_counts(TABLE(SELECT CASE WHEN id < 3 THEN 'a' END AS part, t AS text FROM {df}) PARTITION BY part)", df=df)
    assert rows(counts, "part", "texts") == [("a", 3), (None, 3)]
