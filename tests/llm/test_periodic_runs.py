"""Periodic runs against brute force over all starts and periods."""

import hashlib
import random
import re
import time
import zlib

import pytest

from pulsegrain.llm import periodic_runs as pr


def brute(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            piece = words[s:s + length]
            smallest = next(d for d in range(1, q + 1) if all(piece[k] == piece[k + d] for k in range(length - d)))
            if smallest == q and length >= max(6, 4 * q):
                found.append((s, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    for _ in range(40):
        words = []
        while len(words) < draw.randint(1, 160):
            kind = draw.random()
            if kind < 0.5:
                block = [draw.choice([b"a", b"b", b"c", b"dd"][:draw.randint(1, 4)]) for _ in range(draw.randint(1, 9))]
                words += block * draw.randint(1, 9) + block[:draw.randint(0, len(block))]
            elif kind < 0.7 and words:
                start = draw.randrange(len(words))
                words += words[start:start + draw.randint(1, 30)] * draw.randint(1, 6)
            else:
                words += [str(draw.randint(0, 30)).encode() for _ in range(draw.randint(1, 8))]
        assert pr.runs_of(words) == brute(words)
        assert pr.collapsed(words, brute(words)) == brute_collapsed(words, brute(words))


@pytest.mark.parametrize("words", [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 3, [b"a", b"b"] * 4, [b"a", b"b"] * 4 + [b"a"]])
def test_lengths_at_the_limit(words):
    assert pr.runs_of(words) == brute(words)


def test_long_repetitive_texts_stay_cheap():
    line = [b"w%d" % i for i in range(10)]
    texts = [[b"a"] * 200_000, [b"a", b"b"] * 100_000, line * 20_000, (line * 50 + [b"x"]) * 100]
    began = time.perf_counter()
    assert pr.runs_of(texts[0]) == [(0, 200_000, 1)]
    assert pr.runs_of(texts[1]) == [(0, 200_000, 2)]
    assert pr.runs_of(texts[2]) == [(0, 200_000, 10)]
    assert (0, 50_100, 501) in pr.runs_of(texts[3])
    assert time.perf_counter() - began < 60


def planted(id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    h = None if id is None else zlib.crc32(str(id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return [w.encode() for w in words]


def expected(id, text):
    words = planted(id, text)
    runs = brute(words) if len(words) < 3_000 else pr.runs_of(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    head = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (id, len(runs), *head, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(brute_collapsed(words, runs) if len(words) < 3_000 else pr.collapsed(words, runs))).hexdigest())


def test_query_equals_brute_force(spark, sf_dir, rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = rows(pr.op11_periodic_runs(spark, sf_dir))
    assert got == sorted((expected(*r) for r in docs), key=repr)
    assert sum(r[1] > 0 for r in got) > 5


def test_odd_rows(odd, nothing, rows):
    source = odd.select("doc_id", "text").collect()
    got = rows(pr.find_runs(pr.with_planted_period(odd)).drop("runs"))
    assert got == sorted((expected(*r) for r in source), key=repr)
    assert pr.find_runs(nothing).count() == 0


def test_runs_are_listed(spark):
    row = pr.find_runs(spark.createDataFrame([(1, "x " + "a b " * 5 + "y")], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(1, 10, 2)]
