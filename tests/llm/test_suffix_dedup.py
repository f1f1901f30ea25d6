"""Removed bytes against a set of all strings of smaller ids, and against SQL."""

import hashlib
import random

import numpy as np
import pytest

from compare import database, differences
from pulsegrain.llm import suffix_dedup as sd


def brute(docs, length=50):
    """doc_id, n_bytes, spans and kept bytes by definition."""
    data = [(i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, b in data:
        key = float("-inf") if i is None else i
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            first[s] = min(first.get(s, key), key)
    out = []
    for i, b in data:
        key = float("-inf") if i is None else i
        gone = np.zeros(len(b) + 2, bool)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < key:
                gone[p + 1:p + length + 1] = True
        step = np.diff(gone.astype(int))
        spans = list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()))
        out.append((i, len(b), spans, bytes(c for c, g in zip(b, gone[1:]) if not g)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=repr)


def invented(seed, rows=40):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdeéß日", k=draw.randint(1, 7)))
    shared = [" ".join(word() for _ in range(draw.randint(8, 60))) for _ in range(4)]
    out = []
    for i in range(rows):
        parts = []
        for _ in range(draw.randint(0, 5)):
            passage = draw.choice(shared)
            cut = draw.randrange(len(passage))
            parts.append(draw.choice([passage, passage[cut:], passage[:cut], word() + " " + word(), "ab" * draw.randint(1, 60)]))
        out.append((draw.choice([i, i, i, draw.randrange(rows), None]), "".join(parts)))
    return out + [out[3], out[5], (rows, out[2][1]), (rows + 1, out[2][1]), (rows + 2, None), (rows + 3, "")]


@pytest.mark.parametrize("seed,chunk_bytes,length", [(0, 1 << 20, 50), (1, 300, 50), (2, 1, 50), (3, 700, 42), (4, 2_000, 73)])
def test_equals_definition(spark, seed, chunk_bytes, length):
    docs = invented(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert found(sd.find_repeats(frame, length=length, chunk_bytes=chunk_bytes)) == brute(docs, length)


def test_more_buckets_change_nothing(spark, monkeypatch):
    docs = invented(9)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(sd, "BUCKET_BYTES", 10)
    assert found(sd.find_repeats(frame, chunk_bytes=400)) == brute(docs)


def test_equals_sql(spark, sf_dir):
    got = sd.op12_suffix_dedup(spark, sf_dir).toArrow()
    assert differences(got, database(sf_dir).sql(sd.OP12_SQL).to_arrow_table()) is None
    assert sum(got.column("n_removed").to_pylist()) > 1_000


def test_odd_rows(odd, nothing):
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert found(sd.find_repeats(odd)) == brute(docs)
    assert sd.find_repeats(nothing).count() == 0


def test_cover_takes_every_pair_of_places():
    for difference in range(sd.PERIOD):
        assert any((a + difference) % sd.PERIOD in sd.COVER for a in sd.COVER)
    members = set(sd.COVER)
    for i in range(sd.PERIOD):
        for j in range(sd.PERIOD):
            assert any((i + s) % sd.PERIOD in members and (j + s) % sd.PERIOD in members for s in range(sd.PERIOD))


def test_short_lengths_are_refused(spark):
    with pytest.raises(ValueError):
        sd.find_repeats(spark.createDataFrame([], "doc_id long, text string"), length=30)


def test_digest_is_of_the_kept_bytes(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {i: hashlib.sha256(kept).hexdigest() for i, _, _, kept in brute(docs)}
    got = {r.doc_id: r.kept_sha256 for r in sd.op12_suffix_dedup(spark, sf_dir).collect()}
    assert got == want
