"""Collocations against a plain count of all phrases, and against SQL."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from compare import database, differences
from pulsegrain.llm import collocations as co


def brute(docs, most=5, least=100, top=2000):
    n, f = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, most + 1):
                    if i + k <= len(words):
                        f[lang, tuple(words[i:i + k])] += 1
    kept = {p: c for p, c in f.items() if c >= least}
    found = []
    for (lang, words), a in kept.items():
        if len(words) < 2:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        inside = any(
            longer[0] == lang and len(longer[1]) > len(words) and c >= a
            and any(longer[1][s:s + len(words)] == words for s in range(len(longer[1]) - len(words) + 1))
            for longer, c in kept.items() if c == a)
        if not inside:
            found.append((lang, -score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    ranks, out = Counter(), []
    for lang, score, a, phrase, left, right in sorted(found):
        ranks[lang] += 1
        if ranks[lang] <= top:
            out.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=repr)


def invented(seed, rows=60):
    draw = random.Random(seed)
    vocabulary = ["The", "of", "a", "Ünder", "x", "data", "new", "york", "日本", "(odd)", "\x0bv", "t\tab"]
    line = "same old line that comes again"
    out = []
    for _ in range(rows):
        parts = []
        for _ in range(draw.randint(0, 30)):
            kind = draw.random()
            parts.append(line if kind < 0.1 else "new york city" if kind < 0.3 else " ".join(draw.choices(vocabulary, k=draw.randint(1, 5))))
            parts.append(draw.choice([" ", ", ", ".", "\n", " ", "  ", ": "]))
        out.append((draw.choice(["en", "fr", None]), "".join(parts)))
    return out + [("en", None), ("en", ""), (None, " .,;"), ("fr", "new york")] * 2


@pytest.mark.parametrize("seed,least,top,hot,bucket", [(0, 5, 2000, 0.25, 500_000), (1, 3, 7, 0.001, 40), (2, 2, 2000, 50.0, 3)])
def test_equals_plain_count(spark, rows, monkeypatch, seed, least, top, hot, bucket):
    monkeypatch.setattr(co, "HOT_SHARE", hot)
    monkeypatch.setattr(co, "BUCKET_PLACES", bucket)
    monkeypatch.setattr(co, "HELD_KEYS", 50 if seed else 150_000)
    docs = invented(seed)
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    assert rows(co.collocations(frame, least=least, top=top)) == brute(docs, least=least, top=top)


def test_equals_sql(spark, sf_dir):
    got = co.op13_collocations(spark, sf_dir).toArrow()
    assert differences(got, database(sf_dir).sql(co.OP13_SQL).to_arrow_table()) is None
    assert got.num_rows > 20


def test_quicksort_counts():
    draw = random.Random(5)
    suffixes = [[draw.randint(0, 4) for _ in range(draw.randint(2, 5))] for _ in range(3_000)]
    words = np.array([s + [-1] * (5 - len(s)) for s in suffixes], np.int32)
    places = np.array([draw.randint(1, 3) for _ in suffixes])
    plain = Counter()
    for s, c in zip(suffixes, places.tolist()):
        for k in range(2, len(s) + 1):
            plain[tuple(s[:k])] += c
    got = {tuple(words[p, :d].tolist()): c for p, d, c in co.quicksort_counts(words, places, np.zeros(len(words), bool), 40)}
    assert got == {p: c for p, c in plain.items() if c >= 40}


def test_scores_beyond_64_bits(spark, rows):
    counts = spark.createDataFrame(
        [("en", "p q", 3 * 10**9), ("en", "p", 5 * 10**9), ("en", "q", 7 * 10**9)], "lang string, phrase string, places long")
    n = spark.createDataFrame([("en", 9 * 10**10)], "lang string, n long")
    assert rows(co.scored(counts, n)) == [("en", "p q", 3 * 10**9, 5 * 10**9, 7 * 10**9, 9 * 10**10, 1000 * 3 * 10**9 * 9 * 10**10 // (35 * 10**18))]


def test_odd_rows(odd, nothing, rows):
    docs = [tuple(r) for r in odd.select("lang", "text").collect()]
    assert rows(co.collocations(odd)) == brute(docs)
    assert co.collocations(nothing).count() == 0
