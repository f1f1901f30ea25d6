"""Text functions on hand-written rows."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrain import lexicons
from pulsegrain.functions import html, text, values


@pytest.fixture(scope="module")
def apply(spark):
    def run(fn, *inputs):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, t string")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]

    return run


@pytest.mark.parametrize("given_text, cleaned", [
    ("https://a.b/c 좋다", "좋다"),
    ("www.a.com 좋다", "wwwacom 좋다"),
    ("ㅋㅋㅋ 진짜 좋다", "좋다"),
    ("12:30 시작 3:45 끝!", "시작 끝"),
    ("근데  이건\n좋아요", "이건 좋아요"),
    ("", ""),
])
def test_clean_text(apply, given_text, cleaned):
    assert apply(text.clean_text, given_text) == [cleaned]


def test_url_first(apply):
    assert apply(lambda c: text.clean_text(c, url_first=True), "www.a.com 좋다") == ["좋다"]


@pytest.mark.parametrize("given_text, normal", [
    ("S24는", "갤럭시는"), ("s25+ 좋다", "갤럭시 좋다"), ("갤5플립", "갤럭시플립"), ("16promax", "아이폰"),
    ("series", "아이폰ries"), ("갤럭시S24 울트라", "갤럭시 갤럭시"), ("A  B\n", "a b"), ("cafe", "cafe"), ("fe 모델", "갤럭시 모델"),
    ("아이폰16 프로", "아이폰 아이폰"),
])
def test_normalize_entities(apply, given_text, normal):
    assert apply(text.normalize_entities, given_text) == [normal]


def _folded(t):
    t = t.lower()
    for pattern, name in lexicons.ENTITY_RULES:
        t = re.sub(rf"\b{pattern}", name, t)
    t = re.sub(r"\s+", " ", t).strip()
    for old, new in lexicons.NAME_FIXUPS:
        t = t.replace(old, new)
    return t


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="s24갤럭시울트라프로맥스미니pro ma+x폴드플립fe", max_size=20), min_size=20, max_size=20))
def test_normalize_entities_follows_the_rules_in_order(apply, texts):
    assert apply(text.normalize_entities, *texts) == [_folded(t) for t in texts]


@pytest.mark.parametrize("pattern, needed", [
    (r"s\d+\+?", "s"), (r"\d+플러스", "플러스"), (r"pro(max)?", "pro"), (r"a|b", ""), (r"[ab]c", ""), (r"x*yz", "yz"),
    (r"ab{0,1}c", "a"), (r"((a)b)?c", ""), (r"(?!ab)c", ""), (r"(ab){0,2}xy", "xy"),
])
def test_required_text(pattern, needed):
    assert text.required_text(pattern) == needed


def test_jamo(apply):
    assert apply(text.collapse_repeated_jamo, "아ㅋㅋㅋ", "ㅋ", "ㅠㅠ아ㅜ") == ["아", "ㅋ", "아ㅜ"]


def test_clock_times(apply):
    assert apply(text.strip_clock_times, "3:45 보면 12:30", "112:30") == [" 보면 ", "112:30"]


def test_latin_only_and_blank(apply):
    assert apply(text.is_latin_only, "nice phone\n", "nice phone!", "좋다 good") == [True, False, False]
    assert apply(text.is_blank, "　 \n", "", " a") == [True, True, False]


def test_sentences_and_lines(apply):
    assert apply(text.sentences_of, "하나. 둘!? 셋…\n넷") == [["하나.", "둘!?", "셋…", "넷"]]
    assert apply(text.lines_of, " a \n\n　\nb") == [["a", "b"]]


def test_contains_any_with_a_long_list(apply):
    terms = [f"[{i}]" for i in range(40)]
    assert apply(lambda c: values.contains_any(c, terms), "x[39]y", "39", "[40") == [True, False, False]


def test_occurrences_do_not_overlap(apply):
    assert apply(lambda c: values.occurrence_count(c, "aa"), "aaaaa", "baab", "") == [2, 1, 0]


def test_first_match_takes_list_order(apply):
    words = ["배터리", "사이즈", "화질", "용량", "초점"]
    assert apply(lambda c: values.first_match(c, words), "용량과 배터리", "없음") == ["배터리", None]


def test_integers(apply):
    assert apply(values.first_integer, "3위", "위", "a12b3") == [3, None, 12]


def test_dates(apply):
    assert [str(v) for v in apply(values.parse_any_date, "2024-05-01", "2024.05.01", "24.05.01", "soon", "2024-13-01")] == [
        "2024-05-01 00:00:00", "2024-05-01 00:00:00", "2024-05-01 00:00:00", "None", "None"]
    assert [str(v) for v in apply(values.parse_iso_timestamp, "2024-05-01T03:04:05Z", "x")] == ["2024-05-01 03:04:05", "None"]


def test_keyword_hash(spark):
    df = spark.createDataFrame([(["b", "a"],), (["a", "b"],)], "k array<string>")
    hashes = [r[0] for r in df.select(values.keywords_hash(F.col("k"))).collect()]
    assert hashes[0] == hashes[1] == __import__("hashlib").sha256(b"a|b").hexdigest()


def test_lists_and_json(apply):
    assert apply(values.csv_list, " a, ,b,", "") == [["a", "b"], []]
    assert apply(lambda c: values.csv_list(c, "'"), "'카메라', '화질'") == [["카메라", "화질"]]
    assert apply(values.unfenced, '```json\n{"a":1}\n```', '{"a":1}') == ['{"a":1}', '{"a":1}']
    assert apply(lambda c: values.json_get(c, "$.a.b", "no"), '{"a":{"b":"x"}}', '{"a":', "{}", None) == ["x", "no", "no", "no"]
    assert apply(values.json_map, '{"a":"1"}', "{bad", None) == [{"a": "1"}, {}, {}]


def test_url_parameters(apply):
    def brand(c):
        return values.url_param(c, "brand", "samsung")

    assert apply(brand, "http://h/p?brand=apple&x=1", "http://h/p", "http://h/p?brand=", "not a url %%", "http://h/?brand=a%20b") == [
        "apple", "samsung", "samsung", "samsung", "a b"]


def test_links(apply):
    page = '<a href="#">1</a><a href="">2</a><a class="k" href="x?companyReviewYN=Y">3</a><a href="y">4</a>'
    assert apply(lambda c: html.links(c, "companyReviewYN=Y"), page) == [["x?companyReviewYN=Y"]]


def test_ratio_without_whole(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a int, b int")
    assert [r[0] for r in df.select(values.safe_ratio(F.col("a"), F.col("b"), 2, 100)).collect()] == [0.0, 33.33]


def test_cleaning_skips_regexes_that_cannot_match(spark):
    said = ["plain words", "at 3:45 or 12:30", "see HTTP://a.b now", "WWW.a.com", "갤럭시s24 프로맥스 se", "ratio 1:2", "", None]
    df = spark.createDataFrame(list(enumerate(said)), "id int, t string")
    clock, urls = F.regexp_replace("t", r"(?U)\b\d{1,2}:\d{2}\b", ""), F.regexp_replace("t", r"(?iU)(https?://|www\.)\S+|https\S+|http\S+", "")
    found = df.select(text.strip_clock_times(F.col("t")).alias("clock"), text.strip_urls(F.col("t")).alias("urls"))
    assert found.collect() == df.select(clock.alias("clock"), urls.alias("urls")).collect()
    each = F.lower("t")
    for pattern, name in lexicons.ENTITY_RULES:
        each = F.regexp_replace(each, rf"(?U)\b{pattern}", name)
    rules = text._all_replaced(F.lower("t"), lexicons.ENTITY_RULES)
    assert df.select(rules).collect() == df.select(each).collect()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("contains(") >= 3
