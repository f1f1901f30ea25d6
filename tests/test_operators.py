"""Operators on small hand-written tables, against brute force where it says more."""

import math
import random
from collections import Counter, defaultdict
from datetime import datetime
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsegrain.operators import match, metrics, models, numbering, ranking, reshape, rows as ops, runs, terms, vectors
from pulsegrain.plans import report
from pulsegrain.session import new_path
from pulsegrain.sources import files

FACT = "id string, brand string, sentence string, sentiment_label string, sentiment_score double, like_count int, commented_at timestamp_ntz"


@pytest.fixture(scope="module")
def fact(spark):
    def make(*given):
        full = [
            (str(i), g.get("brand", "b"), g["s"], g.get("label"), g.get("score"), g.get("likes", 0), g.get("at", datetime(2025, 1, 5)))
            for i, g in enumerate(given)
        ]
        return spark.createDataFrame(full, FACT)

    return make


# -- measures

def test_percentage_counts_hits_not_sentences(fact, rows):
    df = fact({"s": "k1 k1"}, {"s": "k1 k2"}, {"s": "none"})
    assert rows(metrics.keyword_percentage(df, ["k1", "k2", "k3"])) == [("b", "k1", 66.67), ("b", "k2", 33.33), ("b", "k3", 0.0)]


def test_percentage_without_hits(fact, rows):
    assert rows(metrics.keyword_percentage(fact({"s": "x"}), ["k1", "k2"])) == [("b", "k1", 0.0), ("b", "k2", 0.0)]


def test_substring_match(fact, rows):
    assert rows(metrics.keyword_doc_counts(fact({"s": "smart"}), ["art"])) == [("b", "art", 1)]


def test_month_trend(fact, rows):
    df = fact(
        {"s": "k1", "label": "1"}, {"s": "k1 k2", "label": "0"}, {"s": "k1"}, {"s": "x", "at": datetime(2025, 2, 1)},
        {"s": "k2", "label": "1", "at": datetime(2025, 3, 1)},
    )
    assert rows(metrics.keyword_month_trend(df, ["k1", "k2"])) == [
        ("b", "2025-01", "k1", 0.75, 0.3333, 0.3333), ("b", "2025-01", "k2", 0.25, 0.0, 1.0), ("b", "2025-03", "k2", 1.0, 1.0, 0.0)]


def test_occurrence_rate_can_exceed_one(fact, rows):
    assert rows(metrics.keyword_occurrence_rate(fact({"s": "k k"}), ["k"])) == [("b", "2025-01", "k", 2.0)]


def test_sentiment_score(fact, rows):
    df = fact({"s": "k1", "label": "1", "score": 0.9}, {"s": "k1", "label": "1", "score": 0.8}, {"s": "k2", "score": 0.5})
    assert rows(metrics.keyword_sentiment_score(df, ["k1", "k2", "k3"])) == [("b", "k1", 0.85, 0.0), ("b", "k2", 0.0, 0.0)]


def test_overall_ratio(fact, rows):
    df = fact(*[{"s": "x", "label": v} for v in ("1", "1", "0", None)], {"s": "x", "brand": "c"})
    assert rows(metrics.overall_sentiment_ratio(df)) == [("b", 0.6667, 0.3333)]


def test_mean_rating(spark, rows):
    df = spark.createDataFrame([("삼성 S24 자급제", 5), ("S24", 4), ("other", 1)], "item string, rating int")
    rules = [("S24", "samsung"), ("아이폰", "apple")]
    assert rows(metrics.group_mean_rating(df, "item", "rating", rules)) == [("apple", 0.0), ("samsung", 4.5)]


def test_shares_add_up(fact):
    rng = random.Random(6)
    df = fact(*[
        {"s": " ".join(rng.choices(["k1", "k2", "k3", "x"], k=3)), "brand": rng.choice("bc"), "label": rng.choice(["1", "0", None]),
         "score": rng.random(), "at": datetime(2025, rng.randint(1, 3), 1)} for _ in range(200)
    ])
    keys = ["k1", "k2", "k3"]
    for frame, group, column, whole, slack in (
        (metrics.keyword_month_trend(df, keys), ["brand", "month"], "ratio", 1, 3e-4),
        (metrics.keyword_percentage(df, keys), ["brand"], "pct", 100, 3e-2),
        (metrics.overall_sentiment_ratio(df).withColumn("both", F.col("pos") + F.col("neg")), ["brand"], "both", 1, 2e-4),
    ):
        for r in frame.groupBy(*group).agg(F.sum(column).alias("t")).collect():
            assert r.t == pytest.approx(whole, abs=slack)


def _report_rows(fact):
    rng = random.Random(7)
    return [{"s": " ".join(rng.choices(["k1", "k2", "k3", "k4", "zz"], k=2)), "label": rng.choice(["1", "0", None]), "brand": rng.choice("xy"),
             "score": rng.randint(1, 4) / 4, "likes": rng.randint(0, 3), "at": datetime(2025, rng.randint(1, 2), 1)} for _ in range(80)]


ASKED = {1: ["k1", "k2"], 2: ["k2", "k3", "k3"], 3: ["absent"]}


def test_requests_are_answered_like_one_by_one(spark, fact, rows, monkeypatch):
    df = fact(*_report_rows(fact))
    comments = report.as_comments(df.withColumn("pos", F.lit(0)), "id", ["like_count", "commented_at"])
    requests = spark.createDataFrame(list(ASKED.items()), "request_id long, keywords array<string>")
    single = sorted(((i, *r) for i, ks in ASKED.items() for r in map(tuple, metrics.keyword_month_trend(df, list(dict.fromkeys(ks))).collect())), key=repr)
    for words in (4096, 1):
        monkeypatch.setattr(match, "SET_WORDS", words)
        assert rows(report.request_trends(comments, requests)) == single


def test_report_steps_equal_single_measures(spark, fact):
    df = fact(*_report_rows(fact), {"s": "zz", "brand": "alone"})
    comments = report.as_comments(df.withColumn("pos", F.lit(0)), "id", ["like_count", "commented_at"])
    requests = spark.createDataFrame(list(ASKED.items()), "request_id long, keywords array<string>")
    sums = report.cell_sums(report.keyword_cells(comments, requests))
    steps = [*report.report_keywords(sums, requests), *report.report_sentiment(sums, requests)]
    stored = requests.select("request_id", F.lit('{"old": {"a": [1, "x"]}, "overall": 3}').alias("result"))
    once = files.merge_results(stored, steps, "request_id")
    twice = files.merge_results(once, steps, "request_id")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert all('"old":{"a":[1,"x"]}' in r.result for r in once.collect())
    got = defaultdict(set)
    for r in report.step_rows(twice).collect():
        got[r.request_id, r.section].add((r.brand, r.month, r.keyword, r.metric, r.value, r.sentence))
    for i, ks in ASKED.items():
        ks = list(dict.fromkeys(ks))
        assert got[i, "share"] == {(r.brand, "", r.keyword, "pct", r.pct, "") for r in metrics.keyword_percentage(df, ks).collect()}
        scores = metrics.keyword_sentiment_score(df, ks).collect()
        assert got[i, "score"] == {(r.brand, "", r.keyword, m, r[m], "") for r in scores for m in ("pos", "neg")}
        overall = metrics.overall_sentiment_ratio(df).collect()
        assert got[i, "overall"] == {(r.brand, "", "", m, r[m], "") for r in overall for m in ("pos", "neg")}
        best = ranking.top_comment_grid(df, df.select("brand"), ks).collect()
        assert got[i, "comment"] == {(r.brand, "", r.keyword, r.sentiment, None, r.sentence) for r in best}


def test_merged_results(spark):
    stored = spark.createDataFrame([(1, '{"a": 1, "b": {"c": [1.5, null]}, "q\\"": "t"}'), (2, "not json"), (3, None), (4, "[1]"), (5, "{}")], "k long, result string")
    step = spark.createDataFrame([(1, '{"a": "new"}'), (2, '{"x": {"y": 0.25}}'), (9, '{"z": true}')], "k long, result string")
    got = {r.k: r.result for r in files.merge_results(stored, [step], "k").collect()}
    assert got == {1: '{"a":"new","b":{"c":[1.5,null]},"q\\"":"t"}', 2: '{"x":{"y":0.25}}', 3: "{}", 4: "{}", 5: "{}", 9: '{"z":true}'}


def test_only_missing_recommendations_are_searched(spark, rows):
    stored = spark.createDataFrame([(1, 7, "1. old - kept")], "query_id long, recommendation_id long, recommendation string")
    queries = spark.createDataFrame([(1,), (2,), (3,)], "query_id long")
    searched = []

    def search(missing):
        searched.extend(r.query_id for r in missing.collect())
        return missing.where("query_id <> 3").withColumn("recommendation", F.concat(F.lit("1. new - "), "query_id"))

    every, fresh = report.recommend_once(stored, queries, search)
    assert rows(every) == [(1, 7, "1. old - kept"), (2, 8, "1. new - 2")] and rows(fresh) == [(2, 8, "1. new - 2")]
    assert sorted(searched) == [2, 3]
    again, none = report.recommend_once(stored.unionAll(fresh), queries.where("query_id < 3"), search)
    assert rows(again) == rows(every) and none.count() == 0


# -- ranking

def test_top_comment(fact, spark, rows):
    df = fact(
        {"s": "k a", "label": "1", "score": 0.9, "likes": 3}, {"s": "k b", "label": "1", "score": 0.9, "likes": 5},
        {"s": "k c", "label": "1", "score": 0.5, "likes": 9},
    )
    brands = spark.createDataFrame([("b",)], "brand string")
    assert rows(ranking.top_comment_grid(df, brands, ["k"])) == [("b", "k", "neg", "데이터 없음"), ("b", "k", "pos", "k b")]
    assert rows(ranking.top_comment(df, ["k"], by_score=False), "sentence") == [("k c",)]
    table = spark.createDataFrame([("k",)], "keyword string")
    assert rows(ranking.top_comment(df, table), "sentence") == [("k b",)]


def test_recent_valid_months(spark, rows):
    months = [("b", f"2025-0{m}", "k", 1.0, 0.0 if m == 8 else 0.5, 0.0) for m in range(1, 9)]
    trend = spark.createDataFrame(months, "brand string, month string, keyword string, ratio double, pos_ratio double, neg_ratio double")
    assert rows(ranking.recent_valid_months(trend), "month") == [(f"2025-0{m}",) for m in range(2, 8)]
    assert rows(ranking.month_slice_percent(trend, 2), "month", "pos_pct") == [("2025-06", 50.0)]


def test_calendar(spark, rows):
    trend = spark.createDataFrame([("b", "2025-01", "k", 0.25)], "brand string, month string, keyword string, ratio double")
    got = rows(ranking.calendar_percent(trend, trend, ["k"], "2025-03-15"))
    assert got == [("b", m, "k", 25.0 if m == "2025-01" else 0.0) for m in
                   ("2024-09", "2024-10", "2024-11", "2024-12", "2025-01", "2025-02")]


def test_backfill(spark, rows):
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "item string, o int")
    got = rows(ranking.backfill_top(stored, "item", "o", ["b", "c", "d", "e", "f", "g", "h", "i", "j", "k"]))
    assert [g[1] for g in got] == list("abcdefghi")


# -- reshape

def test_numbered_list(spark, rows):
    df = spark.createDataFrame([("1. A - r\nB\n\n2. C - x - y",)], "t string")
    assert rows(reshape.parse_numbered_list(df, "t")) == [(0, "A", "r"), (1, "B", ""), (2, "C - x - y", "")]


def test_zip_is_cut_to_the_shortest(spark, rows):
    df = spark.createDataFrame([(["a", "b", "c"], ["x", "y"]), (["a"], None)], "l array<string>, r array<string>")
    assert rows(reshape.zip_explode(df, ["l", "r"])) == [(0, "a", "x"), (1, "b", "y")]


def test_edges(spark, rows):
    df = spark.createDataFrame([("t1", 10.0, 1), ("t2", 20.0, 5), ("t3", 80.0, 6)], "term string, score double, rank int")
    assert rows(reshape.edge_list(df, F.lit("c"), "term", "score", "rank"), "size", "highlighted") == [
        (150.0, False), (50.0, True), (60.0, True)]


def test_nested_trend_is_json(spark, fact):
    import json

    df = fact({"s": "k1", "label": "1"}, {"s": "k2", "at": datetime(2025, 2, 1)})
    out = reshape.nested_trend(metrics.keyword_month_trend(df, ["k1", "k2"])).collect()
    assert json.loads(out[0]["trend"]) == {
        "2025-01": {"k1": {"ratio": 1.0, "pos_ratio": 1.0, "neg_ratio": 0.0}},
        "2025-02": {"k2": {"ratio": 1.0, "pos_ratio": 0.0, "neg_ratio": 0.0}},
    }


def test_validation(spark, rows):
    df = spark.createDataFrame([(n, ["k"] * n) for n in (2, 3, 5, 6)], "n int, k array<string>")
    checked = ops.check_rows(df, {"keywords": F.size("k").between(3, 5), "never_null": F.lit(None).cast("boolean") | F.lit(True)})
    assert rows(checked, "n", "valid") == [(2, False), (3, True), (5, True), (6, False)]


def test_dedup_keeps_most_liked(spark, rows):
    df = spark.createDataFrame([("k", 1), ("k", 9), ("j", 2)], "key string, likes int")
    once = ops.dedup_subset(df, ["key"], [F.desc("likes")])
    assert rows(once) == [("j", 2), ("k", 9)] == rows(ops.dedup_subset(once, ["key"], [F.desc("likes")]))


# -- numbering

@pytest.mark.parametrize("size", [1000, 200, 31])
def test_numbers_are_consecutive(spark, rows, size):
    keys = random.Random(1).sample(range(-5000, 5000), 500)
    df = spark.createDataFrame([(k, "hot" if i % 3 else f"g{i % 7}") for i, k in enumerate(keys)], "k long, g string")
    assert rows(numbering.number_rows(df, "k", rows_per_range=size), "row_no", "k") == sorted(
        ((i, k) for i, k in enumerate(sorted(keys), 1)), key=repr)
    grouped = defaultdict(list)
    for r in numbering.number_rows(df, "k", groups=["g"], rows_per_range=size).collect():
        grouped[r.g].append((r.row_no, r.k))
    for numbered in grouped.values():
        assert sorted(numbered) == list(enumerate(sorted(k for _, k in numbered), 1))


@pytest.mark.parametrize("size", [1000, 4])
def test_oversampling_fills_every_class(spark, monkeypatch, size):
    monkeypatch.setattr(numbering, "ROWS_PER_RANGE", size)
    monkeypatch.setattr(models, "COPY_BLOCK", size)
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 100 + i) for i in range(3)], "label string, row_id long")
    out = models.oversample_classes(df, "label", "row_id").collect()
    assert Counter(r.label for r in out) == {"a": 10, "b": 10}
    copies = Counter(r.row_id for r in out if r.label == "b")
    assert max(copies.values()) - min(copies.values()) <= 1
    assert len(set(map(tuple, out))) == 20


# -- matching

def test_keyword_table_equals_brute_force(spark, rows, monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab 가나😀") for _ in range(rng.randint(0, 30))) for _ in range(60)] + ["hot aab 가나"] * 40
    words = sorted({"".join(rng.choice("ab가나😀 ") for _ in range(rng.randint(1, 5))) for _ in range(40)})
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    lexicon = spark.createDataFrame([(w,) for w in words] + [("",), ("ab",)], "keyword string")
    brute = sorted(((i, w) for i, t in enumerate(texts) for w in set(words) | {"ab"} if w in t), key=repr)
    for gram, words_of_set, hottest in ((5, 4096, 1000), (1, 4096, 5), (3, 1, 1000), (2, 4096, 1)):
        monkeypatch.setattr(match, "SET_WORDS", words_of_set)
        monkeypatch.setattr(match, "HOTTEST", hottest)
        assert rows(match.match_keyword_table(df, lexicon, "t", gram), "id", "keyword") == brute
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(match.match_keyword_table(df, lexicon, "t", 2), "id", "keyword") == brute
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(match.match_keywords(df, "t", words + (["ab"] if "ab" not in words else [])), "id", "keyword") == brute


def test_empty_keyword_table(spark):
    df = spark.createDataFrame([(1, "a")], "id long, t string")
    none = spark.createDataFrame([], "keyword string")
    assert match.match_keyword_table(df, none, "t").count() == 0


def test_keywords_are_filed_under_their_rarest_run(spark, rows):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(["aaaa"] * 30 + ["aaab", "xaab", None, "b"])], "id long, t string")
    words = spark.createDataFrame([("aaa",), ("aaab",), ("b",), ("zz",), ("aaaz",)], "keyword string")
    index = rows(match.keyword_index(texts, words, "t", 2))
    # A keyword made of the most common run has no other; one with an absent run has no entry.
    assert index == [("aaa", "aa", 32), ("aaab", "ab", 2), ("b", "b", 3)]
    found = Counter(r.keyword for r in match.match_keyword_table(texts, words, "t", 2).collect())
    assert found == {"aaa": 31, "aaab": 1, "b": 3}


def test_keyword_table_plan_has_no_collect_and_no_nested_loop(spark):
    texts = spark.range(1000).selectExpr("id", "concat('text ', id) as t")
    words = spark.range(500).selectExpr("concat('t ', id) as keyword")
    plan = match.match_keyword_table(texts, words, "t")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


# -- terms

DOCS = [(1, "g", "red ring red"), (2, "g", "blue ring"), (3, "g", "zz red ring blue"), (4, "h", "solo solo"), (5, "g", "!")]


def test_tfidf_follows_the_formula(spark, monkeypatch):
    df = spark.createDataFrame(DOCS, "id long, grp string, t string")
    expected = Counter()
    for grp in "gh":
        docs = [t.replace("!", "").split() for _, g, t in DOCS if g == grp]
        n, freq = len(docs), Counter(w for d in docs for w in set(d))
        for d in docs:
            weight = {w: c * (math.log((1 + n) / (1 + freq[w])) + 1) for w, c in Counter(d).items()}
            length = math.sqrt(sum(v * v for v in weight.values()))
            for w, v in weight.items():
                expected[grp, w] += v / length
    for limit in (match.BROADCAST_BYTES, 0):
        monkeypatch.setattr(match, "BROADCAST_BYTES", limit)
        got = {(r.grp, r.term): r.score for r in terms.tfidf_top_n(df, "id", "t", "grp").collect()}
        assert got == pytest.approx(dict(expected), abs=1e-6)


def test_hot_keys_join_like_any_other(spark, rows):
    rng = random.Random(5)
    big = [(i, rng.choice(["hot", "hot", "warm", f"k{rng.randint(0, 30)}"])) for i in range(400)]
    counts = Counter(k for _, k in big)
    small = [(k, n, f"v{k}") for k, n in counts.items()] + [("unused", 0, "v")]
    left = spark.createDataFrame(big, "id long, k string")
    right = spark.createDataFrame(small, "k string, n long, v string")
    for hottest in (2, 10, 1000):
        got = match.hot_key_join(left, right, ["k"], "n", spread_by="id", hottest=hottest)
        assert rows(got, "id", "k", "v") == sorted(((i, k, f"v{k}") for i, k in big), key=repr)


def test_cooccurrence(spark, rows):
    df = spark.createDataFrame(DOCS + DOCS[:1] * 3, "id long, grp string, t string")
    pairs = Counter()
    for _, _, t in DOCS + DOCS[:1] * 3:
        words = sorted(set(w for w in t.split() if len(w) > 1))
        pairs.update((a, b) for i, a in enumerate(words) for b in words[i + 1:])
    both = pairs + Counter({(b, a): n for (a, b), n in pairs.items()})
    for n, head in ((3, 2), (2, 1), (1000, 3), (2, 512), (1, 4)):
        got = {(r.term_a, r.rank): (r.term_b, r.n) for r in terms.cooccurrence_pairs(df, "t", n, head).collect()}
        want = {}
        for a in {a for a, _ in both}:
            ranked = sorted(((-c, y) for (x, y), c in both.items() if x == a))[:n]
            want.update({(a, i): (y, -c) for i, (c, y) in enumerate(ranked, 1)})
        assert got == want
    sums = Counter()
    for (a, b), n in pairs.items():
        sums[a] += n
        sums[b] += n
    got = {r.term: r.score for r in terms.cooccurrence_score(df, "t").collect()}
    assert {k: v for k, v in got.items() if v} == sums


@pytest.mark.parametrize("least", [0.05, 0.5, 0.8, 1.0])
def test_count_vector_cosine(spark, least):
    rng = random.Random(5)
    docs = DOCS + [(100 + i, "g", " ".join(rng.choices(["aa", "bb", "cc", "dd", "ee"], weights=[9, 4, 2, 1, 1], k=rng.randint(1, 9)))) for i in range(25)]
    df = spark.createDataFrame(docs, "a long, grp string, t string")
    other = df.withColumnRenamed("a", "b")
    nulls = spark.createDataFrame([(None, "g", "aa"), (999, "g", None)], "a long, grp string, t string")
    got = {(r.a, r.b): r.cosine for r in terms.count_vector_cosine(df.unionAll(nulls), other, "a", "b", "t", least).collect()}
    vecs = {i: Counter(w for w in t.split() if len(w) > 1) for i, _, t in docs}
    for i, a in vecs.items():
        for j, b in vecs.items():
            dot = sum(a[w] * b[w] for w in a)
            norm = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
            if dot and round(dot / norm, 6) >= least:
                assert got.pop((i, j)) == pytest.approx(dot / norm, abs=1e-6)
    assert not got


def test_token_top_n_with_a_stopword_table(spark, rows):
    df = spark.createDataFrame([("a", "x yy yy zz"), ("a", "zz zz")], "g string, nouns string")
    stop = spark.createDataFrame([("yy",)], "word string")
    assert rows(terms.token_top_n(df, "nouns", ["g"], stop)) == [("a", "zz", 3, 1)]
    assert rows(terms.token_top_n(df, "nouns", ["g"], ["zz"], n=1)) == [("a", "yy", 2, 1)]


# -- vectors

@pytest.mark.parametrize("block", [10_000, 3])
def test_nearest_vectors_equal_brute_force(spark, monkeypatch, block):
    for name in ("VECTOR_BLOCK", "QUERY_BLOCK", "QUERIES_AT_ONCE"):
        monkeypatch.setattr(vectors, name, block if name != "VECTOR_BLOCK" else block * 5)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(200, 8)).astype("float32")
    base[150:] = base[0]  # a third of the table is one vector
    table = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(base)], "id long, embedding array<float>, brand int")
    wanted = rng.normal(size=(6, 8))
    queries = spark.createDataFrame([(q, v.tolist(), q % 3) for q, v in enumerate(wanted)], "query_id long, query array<double>, brand int")
    unit = base.astype("float64") / np.linalg.norm(base.astype("float64"), axis=1, keepdims=True)
    for same in (None, "brand"):
        got = defaultdict(list)
        for r in vectors.vector_topk(table.repartition(5), queries, 7, "id", same=same).orderBy("query_id", "rank").collect():
            got[r.query_id].append(r.id)
        for q, v in enumerate(wanted):
            sims = np.round(unit @ (v / np.linalg.norm(v)), 6)
            ids = [i for i in range(200) if same is None or i % 3 == q % 3]
            assert got[q] == sorted(ids, key=lambda i: (-sims[i], i))[:7]


def test_cosine_column(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(1 / math.sqrt(2)) and got[1] is None


# -- models

def test_lexicon_class_and_sentiment(spark, rows):
    df = spark.createDataFrame([("aa b",), ("b b a",), ("x",), ("a b",)], "t string")
    label, score = models.lexicon_sentiment(F.col("t"), ["a"], ["b"])
    got = df.select("t", models.lexicon_class(F.col("t"), {"A": ["a"], "B": ["b"]}).alias("c"), label.alias("l"), score.alias("s"))
    assert rows(got) == [("a b", "A", None, 0.0), ("aa b", "A", "1", 0.333333), ("b b a", "B", "0", 0.333333), ("x", "none", None, None)]


def test_a_single_row_is_copied_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(models, "COPY_BLOCK", 7)
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 99)], "label string, row_id long")
    out = models.oversample_classes(df, "label", "row_id").where("label = 'b'").collect()
    assert sorted(r.copy_no for r in out) == list(range(1, 51))


def test_trained_classifier_beats_the_floor(spark):
    rng = random.Random(4)
    words = {"samsung": ["galaxy", "fold", "note"], "apple": ["iphone", "siri", "mac"], "none": ["weather", "lunch", "song"]}
    data = [(i, " ".join(rng.choices(words[c], k=3) + rng.choices(["good", "bad", "the"], k=2)), c)
            for i, c in enumerate(rng.choices(list(words), k=300))]
    df = spark.createDataFrame(data, "id long, t string, y string")
    model = models.train_text_classifier(df, "t", "y", features=256, key="id", most=200)
    loaded = models.load_classifier(models.save_classifier(model, new_path(spark, "model")))
    scored = models.classify_text(df, loaded)
    assert scored.where("y = predicted").count() / 300 > 0.95
    none = spark.createDataFrame([(1, None), (2, "")], "id long, t string")
    assert {r.predicted for r in models.classify_text(none, loaded).collect()} <= set(words)


def test_model_hook_sees_whole_texts_in_batches(spark, rows):
    def load():
        def score(texts):
            assert len(texts) <= 4
            return [(str(len(texts) > 0), float(len(t))) for t in texts]

        return score

    df = spark.createDataFrame([(i, "x" * i) for i in range(10)], "i int, t string")
    assert rows(models.scored_by_model(df, "t", load, batch=4), "i", "score") == [(i, float(i)) for i in range(10)]
    assert rows(df.limit(3).select(models.mapped_text(F.col("t"), str.upper).alias("u"))) == [("",), ("X",), ("XX",)]


def test_sample_is_stable(spark, rows):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert rows(models.sample_rows(df, "k", 10)) == rows(models.sample_rows(df.repartition(7), "k", 10))


def test_rows_with_one_key_or_none_are_spread(spark):
    keys = [None] * 400 + ["same"] * 400 + [f"k{i}" for i in range(200)]
    df = spark.createDataFrame([(k, i % 7) for i, k in enumerate(keys)], "k string, _row int").repartition(3)
    out = numbering.number_rows(df, "k", name="no", rows_per_range=100).orderBy("no").collect()
    assert [r.no for r in out] == list(range(1, 1001))
    assert [r.k for r in out] == [None] * 400 + sorted(keys[400:])
    ordered = df.select(F.struct("k", "_row").alias("r"))
    sizes = Counter(r.p for r in ordered.repartitionByRange(
        10, F.col("r.k"), F.xxhash64("r"), F.rand(42)).select(F.spark_partition_id().alias("p")).collect())
    assert max(sizes.values()) < 300


def test_equal_rows_are_numbered_once_each(spark, rows):
    df = spark.createDataFrame([("a", 1)] * 50 + [("b", 1)] * 30 + [(None, None)] * 20, "g string, k int")
    out = rows(numbering.number_rows(df, "k", groups=["g"], rows_per_range=7), "g", "row_no")
    assert out == sorted([("a", i) for i in range(1, 51)] + [("b", i) for i in range(1, 31)] + [(None, i) for i in range(1, 21)], key=repr)


def test_numbers_keep_rows_without_a_key(spark, rows):
    df = spark.createDataFrame([(None, "n"), (3, "c"), (1, "a"), (2, "b")], "k int, v string")
    want = [("a", 2), ("b", 3), ("c", 4), ("n", 1)]
    for per_range in (None, 1):
        assert rows(numbering.number_rows(df, "k", ["v"], name="no", rows_per_range=per_range), "v", "no") == want


def test_run_join_keeps_texts_without_an_id(spark, rows):
    texts = spark.createDataFrame([(None, "red hot"), (None, "cold"), (1, "red")], "id int, t string")
    words = spark.createDataFrame([("red",), ("cold",)], "keyword string")
    assert rows(match.match_keyword_table(texts, words, "t")) == sorted([(None, "red hot", "red"), (None, "cold", "cold"), (1, "red", "red")], key=repr)


def test_left_parts_of_korean_words(spark, rows):
    said = ["갤럭시는 좋다", "갤럭시가 좋다", "갤럭시를 샀다", "갤럭시 화면이 좋다", "화면은 크다", "화면 화면도", "x" * 40, None]
    df = spark.createDataFrame(list(enumerate(said)), "id long, t string")
    stems = {r.token: r.stem for r in terms.token_stems(df, "t").collect()}
    assert {stems[w] for w in ("갤럭시는", "갤럭시가", "갤럭시를", "갤럭시")} == {"갤럭시"}
    assert {stems[w] for w in ("화면이", "화면은", "화면", "화면도")} == {"화면"} and stems["x" * 40] == "x" * 40
    nouns = dict(rows(terms.stemmed_nouns(df, "id", "t", terms.token_stems(df, "t"), ["좋다"])))
    assert nouns[0] == "갤럭시" and nouns[3] == "갤럭시 화면" and nouns[5] == "화면 화면" and nouns[7] == ""


def test_weighted_sentiment_by_hand(spark):
    taught = spark.createDataFrame([("good good fine", 1), ("bad fine", 0), ("bad", 0), ("zz", None)], "t string, y int")
    lexicon = models.learn_lexicon(taught, "t", "y")
    weight = {r.term: r.units for r in lexicon.collect()}
    p, m = Counter("good good fine".split()), Counter("bad fine bad".split())
    for w in ("good", "bad", "fine"):
        assert weight[w] == round(1e6 * (math.log((p[w] + 1) / 6) - math.log((m[w] + 1) / 6)))
    asked = {1: "good", 2: "not good", 3: "not very good", 4: "not so very good", 5: "unknown", 6: None, 7: "good bad bad"}
    got = {r.id: (r.label, r.score) for r in models.weighted_sentiment(
        spark.createDataFrame(list(asked.items()), "id long, t string"), "id", "t", lexicon, ["not"]).collect()}
    total = weight["good"] + 2 * weight["bad"]
    assert got == {1: ("1", 1.0), 2: ("0", 1.0), 3: ("0", 1.0), 4: ("1", 1.0), 5: (None, None), 6: (None, None),
                   7: ("1" if total > 0 else "0", round(abs(total) / (weight["good"] + 2 * abs(weight["bad"])), 6))}


def test_naive_bayes_by_hand(spark, rows):
    docs = [(1, "aa aa bb", "x"), (2, "bb cc", "y"), (3, "cc cc cc", "y"), (4, None, "x"), (5, "aa", None)]
    df = spark.createDataFrame(docs, "id long, t string, y string")
    model = models.bayes_model(df, "id", "t", "y")
    seen = {"x": Counter({"aa": 2, "bb": 1}), "y": Counter({"bb": 1, "cc": 4})}
    asked = [(1, "aa bb"), (2, "cc"), (3, "unknown words"), (4, None), (None, "cc bb"), (6, "bb")]
    got = {r.id: (r.predicted, r.score) for r in models.bayes_classify(spark.createDataFrame(asked, "id long, t string"), "id", "t", *model).collect()}
    for i, t in asked:
        known = [w for w in (t or "").split() if w in ("aa", "bb", "cc")]
        scores = {c: math.log(0.5) + sum(math.log((n[w] + 1) / (sum(n.values()) + 3)) for w in known) for c, n in seen.items()}
        best = min(scores, key=lambda c: (-round(scores[c], 6), c))
        assert got[i] == (best, pytest.approx(scores[best], abs=1e-6))


def test_vector_queries_by_name_and_without_a_vector(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, embedding array<double>")
    asked = spark.createDataFrame([("a", [2.0, 0.0]), ("b", None)], "query_id string, query array<double>")
    assert [tuple(r) for r in vectors.vector_topk(table, asked, 1, "id").collect()] == [("a", 1, 1.0, 1)]
    assert vectors.vector_topk(table, asked.where("query_id = 'b'"), 1, "id").collect() == []


def test_long_rows_make_more_ranges(spark, rows, monkeypatch):
    """Ranges went by rows alone, so a task read any number of bytes."""
    df = spark.range(400).selectExpr("id AS k", "repeat('x', 1000) AS t", "array(1.0D, 2.0D) AS v", "named_struct('a', 1) AS m", "CAST(NULL AS string) AS none")
    monkeypatch.setattr(numbering, "BYTES_PER_RANGE", 50_000)
    stored = []
    real = numbering.written
    monkeypatch.setattr(numbering, "written", lambda d, name: stored.append(d.rdd.getNumPartitions()) or real(d, name))
    assert rows(numbering.number_rows(df, "k", name="no"), "k", "no") == sorted(((i, i + 1) for i in range(400)), key=repr)
    assert stored[0] >= 8


def test_small_keyword_index_shuffles_no_text(spark, rows, monkeypatch):
    texts = spark.createDataFrame([(i, f"text {i % 7} of {i}") for i in range(60)], "id long, t string")
    words = spark.createDataFrame([("text 3",), ("of 1",), ("5",), ("zz",)], "keyword string")
    found = match.match_keyword_table(texts, words, "t", also="all")
    assert "hashpartitioning(_run" not in found._jdf.queryExecution().executedPlan().toString()
    got = rows(found, "id", "keyword")
    assert got == sorted([(i, k) for i in range(60) for k in ("text 3", "of 1", "5") if k in f"text {i % 7} of {i}"] + [(i, "all") for i in range(60)], key=repr)
    monkeypatch.setattr(match, "BROADCAST_BYTES", 0)
    assert rows(match.match_keyword_table(texts, words, "t", also="all"), "id", "keyword") == got


@pytest.mark.parametrize("limit", [None, 0])
def test_keywords_are_found_without_a_regex_per_character(spark, rows, monkeypatch, limit):
    """Every character of every text was matched by a regex, twice; 6 GB did not end in time."""
    if limit is not None:
        monkeypatch.setattr(match, "BROADCAST_BYTES", limit)
    rng = random.Random(11)
    texts = ["".join(rng.choice("abc é나😀") for _ in range(rng.choice((0, 3, 40, 900)))) for _ in range(80)] + ["abc"] * 9 + [None, "", "é"]
    words = {"".join(rng.choice("abc é나😀") for _ in range(rng.choice((1, 2, 5, 6)))) for _ in range(60)}
    words |= {t[3:30] for t in texts[:40] if t} | {"absent here"}
    df = spark.createDataFrame([(i, t, [i]) for i, t in enumerate(texts)], "id long, t string, more array<long>").repartition(3)
    lexicon = spark.createDataFrame([(w,) for w in [*words, None, "abc"]], "keyword string")
    found = match.match_keyword_table(df, lexicon, "t", also="any text")
    assert "regexp" not in match.keyword_index(df, lexicon, "t")._jdf.queryExecution().toString() + found._jdf.queryExecution().toString()
    brute = [(i, w, [i]) for i, t in enumerate(texts) if t is not None for w in {*words, "abc"} if w and w in t] + [(i, "any text", [i]) for i, t in enumerate(texts) if t is not None]
    assert rows(found, "id", "keyword", "more") == sorted(brute, key=repr)


@pytest.mark.parametrize("poor", [False, True])
def test_run_search_in_small_slices_and_with_equal_hashes(monkeypatch, poor):
    for name, value in (("SLICE_BYTES", 50), ("AT_ONCE", 2), ("OUT_BYTES", 100), ("MOST_BITS", 3)):
        monkeypatch.setattr(runs, name, value)
    if poor:
        monkeypatch.setattr(runs, "_mixed", lambda x: (x % np.uint64(5)) << np.uint64(62) | np.uint64(1))
    rng = random.Random(4)
    texts = ["".join(rng.choice("abé나") for _ in range(rng.randrange(0, 60))) for _ in range(50)] + [None, ""]
    words = sorted({"".join(rng.choice("abé나") for _ in range(rng.randrange(1, 7))) for _ in range(50)})
    found = runs.filed(pa.array(words), pa.array([w[-3:] for w in words]))
    if poor:
        found.hashes[:] = found.hashes[0]
        monkeypatch.setattr(runs.Part, "stretch", lambda self, low, high: np.full(len(low), found.hashes[0]))
    held = SimpleNamespace(value=found)
    batches = [pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["id", "t"]).slice(1)]
    got = [(r["id"], r["keyword"]) for b in runs.matched(held, "t", ["id", "t"], None)(iter(batches)) for r in b.to_pylist()]
    assert sorted(got) == sorted((i, w) for i, t in enumerate(texts) if i for w in words if w in (t or ""))
