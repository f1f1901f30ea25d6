import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pulsegrain.llm import ngram_join, words


def grams(text, size=5):
    low = "".join(c.lower() if c.isascii() else c for c in (text or ""))
    found = re.findall(r"[0-9a-z\x80-\U0010ffff]+", low)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i:i + size]) for i in range(max(1, len(found) - size + 1)))


def by_hand(rows, threshold=0.8):
    """Class and links of each row by comparing all pairs of distinct texts that share an n-gram."""
    sets = [grams(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in holders[g]:
                common[j] += 1
        for j, n in common.items():
            if j != i and n >= threshold * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                parent[root(j)] = root(i)
    first = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        first[root(i)].append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        named = [d for d in first[root(i)] if d is not None]
        out.append((doc, min(named, default=None), links[i]))
    return sorted(out, key=repr)


def test_words_match_a_pattern():
    texts = ["The cat's hat", None, "", "É été 12a", "x", " a  b ", "end", "日本 語", "a" * 50, "-", "b"]
    got = [w for part in words.batch_words(pa.array(texts)) for w in np.split(part.hashes, part.bounds[1:-1])]
    seen = {}
    for text, hashes in zip(texts, got):
        low = "".join(c.lower() if c.isascii() else c for c in (text or ""))
        found = re.findall(r"[0-9a-z\x80-\U0010ffff]+", low)
        assert len(found) == len(hashes)
        for w, h in zip(found, hashes.tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_slices_do_not_change_words(monkeypatch):
    texts = pa.array([f"some words {i} of text {i % 7}" for i in range(200)])
    whole = np.concatenate([p.hashes for p in words.batch_words(texts)])
    monkeypatch.setattr(words, "slices", lambda offsets, most=100: iter([(i, min(i + 3, len(offsets) - 1)) for i in range(0, len(offsets) - 1, 3)]))
    assert (np.concatenate([p.hashes for p in words.batch_words(texts)]) == whole).all()


def test_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands()
    assert bands * rows <= ngram_join.HASHES and 1 - (1 - 0.8 ** rows) ** bands >= ngram_join.RECALL


def test_odd_rows_match_by_hand(odd, rows):
    data = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows(ngram_join.near_duplicates(odd)) == by_hand(data)


def test_documents_match_by_hand(spark, rows):
    data = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert rows(ngram_join.op3_ngram_join(spark, "/root/testdata/sf0.01")) == by_hand(data)


@pytest.mark.parametrize("block_rows", [512, 16])
def test_a_large_group_of_near_copies(spark, rows, block_rows):
    rng = np.random.default_rng(3)
    base = [f"w{n}" for n in rng.integers(0, 10**6, 120)]
    data = []
    for i in range(150):
        own = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            own[at] = f"e{i}x{at}"
        data += [(2 * i, " ".join(own)), (2 * i + 1, f"other words {i} " + " ".join(f"v{i}y{n}" for n in range(30)))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(ngram_join.near_duplicates(docs, block_rows=block_rows)) == by_hand(data)


def test_one_of_each_group_stays(odd):
    left = ngram_join.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    wanted = {d for d, c, _ in by_hand([(r.doc_id, r.text) for r in odd.collect()]) if d == c}
    assert {r.doc_id for r in left.collect()} == wanted


def test_empty_table(nothing):
    assert ngram_join.near_duplicates(nothing).count() == 0
    assert ngram_join.drop_near_duplicates(nothing).count() == 0
