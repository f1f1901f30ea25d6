"""Tokens meet tables of terms once per chunk: same results with small chunks and repeated ids, and no row per token in the plan."""

import math
import random
from collections import Counter

import pytest

from pulsegrain.operators import chunks, models, terms


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _small_chunks(monkeypatch):
    monkeypatch.setattr(chunks.in_chunks_by_id, "__defaults__", ((), 16))


def _texts(n=40):
    rng = random.Random(7)
    return [(i % 30, " ".join(rng.choices(["aa", "bb", "cc", "dd", "ee", "ff"], weights=[9, 4, 2, 1, 1, 1], k=rng.randint(0, 9)))) for i in range(n)]


def _merged(rows):
    found = {}
    for i, t in rows:
        found.setdefault(i, Counter()).update(t.split())
    return found


def test_cosine_by_blocks_keeps_no_pair_table(spark, monkeypatch):
    _small_chunks(monkeypatch)
    monkeypatch.setattr(terms, "MATRIX_ENTRIES", 8)
    monkeypatch.setattr(terms, "QUESTION_ENTRIES", 7)
    left, right = _texts(), [(100 + i, t) for i, t in _texts(25)]
    found = terms.count_vector_cosine(spark.createDataFrame(left, "a long, t string"), spark.createDataFrame(right, "b long, t string"), "a", "b", "t", 0.7)
    got = {(r.a, r.b): r.cosine for r in found.collect()}
    expected = {}
    for i, a in _merged(left).items():
        for j, b in _merged(right).items():
            ab = sum(a[w] * b[w] for w in a)
            if ab and round(c := ab / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values())), 6) >= 0.7:
                expected[i, j] = c
    assert got == pytest.approx(expected, abs=1e-6)
    assert "Aggregate(keys=[a#" not in _plan(found)


def test_tfidf_sorts_no_occurrences(spark, monkeypatch):
    _small_chunks(monkeypatch)
    docs = [(i, "g" if i % 3 else None if i % 2 else "h", t) for i, (_, t) in enumerate(_texts())]
    found = terms.tfidf_top_n(spark.createDataFrame(docs, "id long, grp string, t string"), "id", "t", "grp")
    expected = Counter()
    for grp in "gh":
        mine = [Counter(t.split()) for _, g, t in docs if g == grp]
        df = Counter(w for d in mine for w in d)
        for d in mine:
            weight = {w: c * (math.log((1 + len(mine)) / (1 + df[w])) + 1) for w, c in d.items()}
            for w, v in weight.items():
                expected[grp, w] += v / math.sqrt(sum(x * x for x in weight.values()))
    assert {(r.grp, r.term): r.score for r in found.collect()} == pytest.approx(dict(expected), abs=1e-6)
    assert "windowspecdefinition(id#" not in _plan(found)


def test_classes_without_a_row_per_token(spark, monkeypatch):
    _small_chunks(monkeypatch)
    taught = spark.createDataFrame([(1, "aa aa bb", "x"), (2, "bb cc", "y"), (3, "cc cc dd", "z")], "id long, t string, y string")
    model = models.bayes_model(taught, "id", "t", "y")
    asked = _texts() + [(90, "unknown"), (91, None), (None, "cc cc")]
    found = models.bayes_classify(spark.createDataFrame(asked, "id long, t string"), "id", "t", *model)
    seen = {"x": Counter(aa=2, bb=1), "y": Counter(bb=1, cc=1), "z": Counter(cc=2, dd=1)}
    expected = {}
    for i, words in _merged([(i, t or "") for i, t in asked]).items():
        known = [w for w in words.elements() if w in ("aa", "bb", "cc", "dd")]
        scores = {c: math.log(1 / 3) + sum(math.log((n[w] + 1) / (sum(n.values()) + 4)) for w in known) for c, n in seen.items()}
        expected[i] = min(scores, key=lambda c: (-round(scores[c], 6), c))
    assert {r.id: r.predicted for r in found.collect()} == expected
    assert "explode(regexp_extract_all" not in _plan(found)


def test_sentiment_without_a_row_per_token(spark, monkeypatch):
    _small_chunks(monkeypatch)
    lexicon = spark.createDataFrame([("aa", 5, 1), ("bb", -3, 1), ("cc", 2, 1)], "term string, units long, n long")
    asked = [(i, t) for i, (_, t) in enumerate(_texts())] + [(90, "dd"), (91, None)]
    found = models.weighted_sentiment(spark.createDataFrame(asked, "id long, t string"), "id", "t", lexicon, ["ee", "ff"])
    units = {"aa": 5, "bb": -3, "cc": 2}
    expected = {}
    for i, t in asked:
        words = (t or "").split()
        sums = [units.get(w, 0) * (-1 if {"ee", "ff"} & set(words[max(p - 2, 0):p]) else 1) for p, w in enumerate(words)]
        s, w = sum(sums), sum(map(abs, sums))
        expected[i] = ("1" if s > 0 else "0" if s < 0 else None, round(abs(s) / w, 6) if w else None)
    assert {r.id: (r.label, r.score) for r in found.collect()} == expected
    assert "posexplode(" not in _plan(found)


def test_nouns_without_a_row_per_token(spark, monkeypatch):
    _small_chunks(monkeypatch)
    stems = spark.createDataFrame([("aa", "a", 1), ("bb", "bb", 1), ("cc", "c", 1), ("dd", "dd", 1), ("ee", "ee", 1), ("ff", "bb", 1)], "token string, stem string, n long")
    asked = [(i, t) for i, (_, t) in enumerate(_texts())] + [(91, None)]
    found = terms.stemmed_nouns(spark.createDataFrame(asked, "id long, t string"), "id", "t", stems, ["bb"])
    stem = {"aa": "a", "cc": "c", "dd": "dd", "ee": "ee"}
    assert {r.id: r.nouns for r in found.collect()} == {i: " ".join(stem[w] for w in (t or "").split() if w in stem) for i, t in asked}
    assert "posexplode" not in _plan(found)
