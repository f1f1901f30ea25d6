"""Terms that meet their numbers by chunk, and pairs counted in chunks and buckets."""

import random
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from pulsegrain.operators import chunks, pairs, terms


@pytest.fixture(scope="module")
def texts(spark):
    draw = random.Random(5)
    names = [f"w{i}" for i in range(60)] + ["éa", "zß", "日本"]
    rows = [(i, " ".join(draw.choice(names[: draw.choice((5, 30, 63))]) for _ in range(draw.randrange(0, 14)))) for i in range(400)]
    return spark.createDataFrame([*rows, (900, None), (901, "")], "id long, t string").repartition(3)


def wanted(texts, n):
    both = Counter()
    for row in texts.collect():
        words = {w for w in (row.t or "").split()}
        both.update((a, b) for x, y in combinations(words, 2) for a, b in ((x, y), (y, x)))
    out = set()
    for a in {a for a, _ in both}:
        ranked = sorted(((-c, y.encode()) for (x, y), c in both.items() if x == a))[:n]
        out |= {(a, y.decode(), -c, i) for i, (c, y) in enumerate(ranked, 1)}
    return {(a, b, c, i) for a, b, c, i in out}


def words_only(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("chunk, bucket, at_once, held", [(8 << 20, 1 << 22, 1 << 21, 1 << 22), (2000, 500, 1, 1)])
def test_pairs_in_many_chunks_and_buckets(spark, texts, monkeypatch, chunk, bucket, at_once, held):
    monkeypatch.setattr(chunks.in_chunks, "__defaults__", (chunk,))
    monkeypatch.setattr(pairs, "PAIRS_IN_BUCKET", max(bucket, 100))
    real = texts.where("t is not null")
    for n, head in ((3, 4), (50, 0)):
        found = terms.cooccurrence_pairs(texts, "t", n, head)
        assert words_only(found) == {r for r in wanted(real, n) if len(r[0]) > 1 and len(r[1]) > 1}
    monkeypatch.setattr(pairs, "PAIRS_AT_ONCE", at_once)
    monkeypatch.setattr(pairs, "PAIRS_HELD", held)
    numbers, bounds = np.array([7, 1, 9, 4, 4_000_000_000, 2, 9], np.uint64), np.array([0, 3, 3, 5, 7])
    got = Counter()
    for keys, counts in pairs.counted(numbers, bounds):
        for k, c in zip(keys.tolist(), counts.tolist()):
            got[k >> 32, k & 0xFFFFFFFF] += c
    assert got == {(1, 7): 1, (7, 9): 1, (1, 9): 1, (4, 4_000_000_000): 1, (2, 9): 1}


def test_no_row_for_a_pair(spark, texts):
    """Spark never sees a pair of a text as a row; it did, and 1 GB did not end in time."""
    plan = terms.cooccurrence_pairs(texts, "t", 3, 4)._jdf.queryExecution().toString()
    assert "Generate" not in plan


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize("n, head, rows", [(3, 1, 3), (50, 3, 5), (4, 0, 64)])
def test_pairs_in_rounds_leave_no_shuffle_and_no_text(spark, texts, monkeypatch, n, head, rows):
    """All counted pairs lay on disk at once, both ways, beside the texts they came from: 6 GB filled it."""
    for name, value in (("PAIRS_IN_BUCKET", 100), ("PAIRS_A_ROUND", 1), ("MATRIX_ROWS", rows), ("SPLITS_A_TASK", 1)):
        monkeypatch.setattr(pairs, name, value)
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 700)
    real, before, rounds, stored = texts.where("t is not null"), shuffle_files(spark), [], []
    monkeypatch.setattr(pairs, "sent", lambda *a, f=pairs.sent: rounds.append(a[:3]) or f(*a))
    monkeypatch.setattr(terms, "written", lambda df, name, f=terms.written: stored.append(f(df, name)) or stored[-1])
    found = terms.cooccurrence_pairs(texts, "t", n, head)
    assert not shuffle_files(spark) - before
    assert words_only(found) == {r for r in wanted(real, n) if len(r[0]) > 1 and len(r[1]) > 1}
    assert len(rounds) > 1 and [low for _, low, _ in rounds[1:]] == [high for _, _, high in rounds[:-1]]
    left = [d for d in stored if Path(d.inputFiles()[0].removeprefix("file:")).exists()]
    assert not [d.columns for d in left if "codes" in d.columns or "numbers" in d.columns]


def test_pairs_of_two_heads_are_not_sent():
    heads = np.array([2, 7], np.uint64)
    sets = pa.record_batch([pa.array([5]), pa.array([2]), pa.array([pairs._packed(np.array([2, 7, 9, 2, 7]))]), pa.array([pairs._packed(np.array([3, 2]))])], names=["tokens", "sets", "numbers", "sizes"])
    sent = [b for b in pairs.sent(1, 0, 1, heads)(iter([sets]))]
    assert sum(b.column("entries")[0].as_py() for b in sent) == 2
    among = [b.to_pylist()[0] for b in pairs.head_counts(heads)(iter([sets]))]
    assert pairs._unpacked(among[0]["counts"], 4).tolist() == [0, 2, 2, 0]


def test_no_texts(spark, texts):
    assert terms.cooccurrence_pairs(texts.where("id < 0"), "t").collect() == []
    assert terms.cooccurrence_pairs(texts.where("t is null"), "t").collect() == []


def test_chunks_hold_every_row_and_stay_bounded(spark, texts):
    listed = texts.selectExpr("id", "split(t, ' ') AS l")
    stored = chunks.in_chunks(listed, "l", 100)
    assert sorted(r.id for r in stored.collect()) == sorted(r.id for r in texts.collect())
    sizes = stored.selectExpr("_chunk", "coalesce(aggregate(l, 0, (s, x) -> s + octet_length(x)), 0) AS n").groupBy("_chunk").sum("n").collect()
    assert max(r[1] for r in sizes) < 100 + 14 * 6
    want = Counter((t) for r in texts.collect() for t in (r.t.split(" ") if r.t is not None else []))
    assert {r.term: r.n for r in chunks.chunk_terms(stored, "l").groupBy("term").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()} == want
