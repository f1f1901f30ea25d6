import re

import numpy as np
import pyarrow as pa
import pytest

from pulsegrain.llm import decontamination as d
from pulsegrain.llm.words import batch_words

FOLDER = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in (text or "")))


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[j], last[j + 1]))
    return row[-1]


def test_subsequence_matches_by_hand():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (rng.integers(0, 6, rng.integers(0, 25)).tolist() for _ in range(2))
        assert d.common_subsequence(a, b) == subsequence(a, b)


def test_windows_cover_every_word():
    texts = pa.array([" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 15, 16, 17, 32, 33, 47, 48, 49, 100)])
    for part in batch_words(texts):
        starts, found = d.passages(part)
        for text in range(len(part.bounds) - 1):
            n = part.bounds[text + 1] - part.bounds[text]
            begun = found.start[found.text == text]
            covered = {w for b in begun for w in range(b, min(b + d.WINDOW, n))}
            assert covered == set(range(n))


def test_vectors_are_sums_over_windows():
    rng = np.random.default_rng(2)
    table = np.vstack([rng.standard_normal((d.DIMS, 3)), np.zeros((1, 3))])
    texts = pa.array([" ".join(f"w{rng.integers(0, 50)}" for _ in range(n)) for n in (3, 0, 40, 16, 90, 1)])
    for part in batch_words(texts):
        vectors, found = d._window_vectors(part, table, d.STRIDE)
        dims = d._dims(part.hashes)
        for vector, text, start in zip(vectors, found.text, found.start):
            low = part.bounds[text] + start
            assert np.allclose(vector, table[dims[low:min(low + d.WINDOW, part.bounds[text + 1])]].sum(axis=0))


def test_frequencies_match_by_hand(odd):
    texts = pa.array([r.text for r in odd.collect()], pa.string())
    seen, docs = np.zeros(d.DIMS), 0
    for part in batch_words(texts):
        for i in range(len(part.bounds) - 1):
            own = part.hashes[part.bounds[i]:part.bounds[i + 1]]
            docs += bool(len(own))
            seen[np.unique(d._dims(own))] += 1
    assert np.allclose(d.inverse_frequencies(odd), np.log((docs + 1) / (seen + 1)) + 1e-3)


def test_latent_space_matches_a_dense_svd(spark):
    rng = np.random.default_rng(4)
    topics = [[f"t{k}w{i}" for i in range(12)] for k in range(4)]
    texts = [" ".join(rng.choice(topics[i % 4], 16)) for i in range(80)]
    idf = np.ones(d.DIMS)
    fold = d.latent_space(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), idf, rank=4)
    rows = np.zeros((80, d.DIMS))
    for part in batch_words(pa.array(texts)):
        for i in range(len(part.bounds) - 1):
            np.add.at(rows[part.first + i], d._dims(part.hashes[part.bounds[i]:part.bounds[i + 1]]), 1)
    rows = d._unit(rows)
    left, values, right = np.linalg.svd(rows, full_matrices=False)
    exact = right[:4].T / values[:4]
    overlap = np.linalg.svd(np.linalg.qr(exact)[0].T @ np.linalg.qr(fold[:-1].astype(float))[0])[1]
    assert overlap.min() > 0.99


@pytest.fixture(scope="module")
def truth(spark):
    """Documents that hold all words of an item in a row."""
    docs = [(r.doc_id, f" {' '.join(words(r.text))} ") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r.item_id, f" {' '.join(words(r.text))} ") for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    return {(i, j) for i, t in docs for j, b in items if b in t}


def test_planted_passages_are_found_and_clean_documents_left(spark, truth):
    got = d.op8_decontamination(spark, FOLDER).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert len(pairs) == len(got)
    assert len(pairs & truth) >= 0.95 * len(truth) and len(pairs - truth) <= 0.02 * len(truth) + 1


def test_blocks_do_not_change_the_result(spark, truth):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where(f"doc_id in ({','.join(str(i) for i, _ in list(truth)[:15])}, 0, 1, 2, 3)")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    whole, cut = ({(r.doc_id, r.item_id) for r in d.find_contamination(docs, items, block=b).collect()} for b in (1000, 7))
    assert whole == cut and whole


def test_a_paraphrase_is_found(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    item = max((r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()), key=len)
    changed = [w if i % 6 else "otherword" for i, w in enumerate(item.split())]
    extra = spark.createDataFrame([(10_000_001, " ".join(changed))], "doc_id long, text string")
    got = d.find_contamination(docs.select("doc_id", "text").unionByName(extra), spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()
    assert [r for r in got if r.doc_id == 10_000_001 and 0.7 <= r.lcs_share < 1]


def test_short_changed_items_within_documents_are_found(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    around = [r.text.split() for r in docs.orderBy("doc_id").collect() if r.text and len(r.text.split()) > 200]
    planted = {}
    for r in items.collect():
        item, answer = words(r.text), words(d.answer_of(r.text))
        kept = set(range(len(item) - len(answer), len(item)))
        left = iter(k for k in range(len(item)) if k not in kept)
        while len(kept) < 0.58 * len(item):
            kept.add(next(left))
        changed = [w if k in kept else "otherword" for k, w in enumerate(item)]
        if len(item) < 24:
            for at in range(5):
                own = around[(5 * r.item_id + at) % len(around)]
                planted[20_000_000 + 5 * r.item_id + at] = r.item_id, " ".join([*own[:60 + 3 * at], *changed, *own[100:160]])
    extra = spark.createDataFrame([(k, t) for k, (_, t) in planted.items()], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.find_contamination(docs.unionByName(extra), items).collect()}
    lost = [k for k, (i, _) in planted.items() if (k, i) not in got]
    assert len(planted) > 100 and not lost, f"{len(lost)} of {len(planted)} lost"


def test_candidates_by_words_miss_no_pair():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 60, n)) for n in (0, 1, 15, 40, 90, 200, 300)]
    items = d.prepare_items(list(range(40)), [" ".join(f"w{x}" for x in rng.integers(0, 70, n)) for n in rng.integers(1, 14, 40)], np.zeros((d.DIMS + 1, 2), np.float32))
    for part in batch_words(pa.array(texts)):
        windows = d.passages(part)[1]
        got = {(t, i): d._settle(part.hashes[part.bounds[t]:part.bounds[t + 1]], items.words[i], items.answers[i], s) for t, i, s in d.held_words(part, windows, items)}
        for t in range(len(texts)):
            own = part.hashes[part.bounds[t]:part.bounds[t + 1]]
            for i in range(40):
                whole = d._settle(own, items.words[i], items.answers[i], windows.start[windows.text == t].tolist())
                assert got.get((t, i), (0.0, 0.0, False)) == whole if whole[0] >= d.ANSWERED_SHARE else True


def test_the_answer_counts_where_the_share_is_not_the_best():
    item, answer = list(range(20)), [18, 19]
    own = np.array([*range(13), *[99] * 150, *range(7), 99, 99, 15, 16, 17, 18, 19], np.uint64)
    starts = list(range(0, len(own), d.STRIDE))
    assert d._settle(own, item, answer, starts) == (0.65, 1.0, True)


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog near the river bank today.", "x"), (2, None, "x"), (3, "", "x"), (None, "...", "x")],
                                  "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in d.find_contamination(odd, items).collect()}
    assert got == {(1, 1), (2, 1)}
    left = d.drop_contaminated(odd, items)
    assert left.columns == odd.columns and left.count() == odd.count() - 2
    assert d.find_contamination(nothing, items).count() == 0
    assert d.find_contamination(odd, items.where("item_id > 9")).count() == 0


def test_the_space_is_made_from_every_document(spark, monkeypatch):
    """It came from a sample of 4,000 documents."""
    seen = []
    monkeypatch.setattr(d, "latent_space", lambda texts, idf, rank: seen.append(texts.count()) or np.zeros((d.DIMS + 1, 2), np.float32))
    docs = spark.range(6_000).selectExpr("id AS doc_id", "concat('some words of document ', id) AS text")
    items = spark.createDataFrame([(1, "an item of the benchmark")], "item_id long, text string")
    assert d.find_contamination(docs, items).count() == 0
    assert seen == [6_001]


def test_the_product_matches_a_dense_one():
    class Held:
        def __init__(self, value):
            self.value = value

    rng = np.random.default_rng(6)
    texts = pa.array([None, "", *[" ".join(f"w{int(x)}" for x in rng.zipf(1.4, n) % 90) for n in (1, 31, 32, 33, 700, 2000)]], pa.string())
    idf, q = rng.random(d.DIMS) + 0.1, rng.standard_normal((d.DIMS, 3))
    rows = []
    for part in batch_words(texts):
        for t in range(len(part.bounds) - 1):
            own = d._dims(part.hashes[part.bounds[t]:part.bounds[t + 1]])
            rows += [np.bincount(own[at:at + d.WINDOW], minlength=d.DIMS) * idf for at in range(0, len(own), d.WINDOW)]
    dense = d._unit(np.array(rows))
    out, = d._product(Held(idf), Held(q))(iter([pa.record_batch([texts], names=["text"])]))
    got = np.zeros(q.shape)
    got[out.column(0).to_numpy()] = np.stack([c.to_numpy() for c in out.columns[1:]], axis=1)
    assert np.allclose(got, dense.T @ (dense @ q))


def test_common_words_match_by_hand():
    rng = np.random.default_rng(8)
    for _ in range(60):
        item = rng.integers(0, 9, rng.integers(1, 12))
        own = rng.integers(0, 40, rng.integers(1, 200))
        names, often = np.unique(item, return_counts=True)
        at = np.flatnonzero(np.isin(own, names))
        starts = np.arange(0, len(own), d.STRIDE)
        got = d.common_words(at, np.searchsorted(names, own[at]), often, starts, len(item))
        want = [sum(w in set(own[max(0, s - len(item)):s + d.WINDOW + len(item)].tolist()) for w in item.tolist()) for s in starts.tolist()]
        assert got.tolist() == want


def test_a_long_text_settles_few_passages(monkeypatch):
    """Every passage of a text that has enough of an item's words somewhere was settled one by one."""
    item = [f"i{k}" for k in range(30)]
    own = [w for k in range(30) for w in (*["the"] * 200, item[k])]
    items = d.prepare_items([1], [" ".join(["the", *item])], np.zeros((d.DIMS + 1, 2), np.float32))
    for part in batch_words(pa.array([" ".join([*own, *item, *own])])):
        found = list(d.held_words(part, d.passages(part)[1], items))
        assert len(found) == 1 and 0 < len(found[0][2]) < 12


def test_stored_passages_give_the_product_of_the_texts():
    """Each product read and hashed the texts again."""
    class Held:
        def __init__(self, value):
            self.value = value

    rng = np.random.default_rng(9)
    texts = pa.array([None, "", "...", *[" ".join(f"w{int(x)}" for x in rng.zipf(1.3, n) % 900) for n in (1, 33, 700, 5000)]], pa.string())
    idf, q = rng.random(d.DIMS) + 0.1, rng.standard_normal((d.DIMS, 3))
    stored = list(d._store_passages(iter([pa.record_batch([texts], names=["text"])])))
    whole, = d._product(Held(idf), Held(q))(iter([pa.record_batch([texts], names=["text"])]))
    again, = d._product(Held(idf), Held(q))(iter([b.slice(i, 1) for b in stored for i in range(b.num_rows)]))
    assert sum(b.num_rows for b in stored) > 2 and whole.num_rows > 100
    assert all(np.allclose(a.to_numpy(), b.to_numpy()) for a, b in zip(whole.columns, again.columns))


def test_pairs_of_a_slice_are_counted_together(monkeypatch):
    """Every pair of a text and an item with enough common words was counted by itself."""
    rng = np.random.default_rng(10)
    texts = pa.array([" ".join(f"w{x}" for x in rng.integers(0, 60, n)) for n in rng.integers(0, 300, 40)])
    items = d.prepare_items(list(range(30)), [" ".join(f"w{x}" for x in rng.integers(0, 62, n)) for n in rng.integers(1, 14, 30)], np.zeros((d.DIMS + 1, 2), np.float32))
    part, = batch_words(texts)
    windows = d.passages(part)[1]
    calls, count = [], d.words_around
    monkeypatch.setattr(d, "words_around", lambda *a: calls.append(1) or count(*a))
    got = list(d.held_words(part, windows, items))
    assert len(calls) < 5 and len(got) > 200 and len({(t, i) for t, i, _ in got}) == len(got)
    for t, i, starts in got:
        own, item = part.hashes[part.bounds[t]:part.bounds[t + 1]].tolist(), items.words[i]
        want = [s for s in windows.start[windows.text == t].tolist()
                if sum(w in own[max(0, s - len(item)):s + d.WINDOW + len(item)] for w in item) >= items.need[i]]
        assert starts == want
    monkeypatch.setattr(d, "COUNTS", 7)
    assert list(d.held_words(part, windows, items)) == got


def test_nearest_cosines_match_by_hand():
    rng = np.random.default_rng(11)
    items = d.Items(*[None] * 13)
    items.ids, items.owner = list(range(4)), np.repeat(np.arange(4), [2, 1, 5, 3])
    items.vectors = d._unit(rng.standard_normal((11, 6)).astype(np.float32))
    vectors, text = d._unit(rng.standard_normal((9, 6)).astype(np.float32)), np.repeat([0, 2, 3], [4, 1, 4])
    got = d.nearest_cosines(vectors, d.Passages(text, None, None), items, 5)
    for t in range(5):
        for i in range(4):
            own = vectors[text == t] @ items.vectors[items.owner == i].T
            assert np.isclose(got[t, i], own.max() if own.size else -1)


def test_the_basis_is_made_in_place():
    """A factorisation beside the table took four more tables of the driver's memory."""
    rng = np.random.default_rng(12)
    table = rng.standard_normal((5000, 20)) @ rng.standard_normal((20, 20))
    plain = np.linalg.qr(table)[0]
    got = d._orthonormal(table)
    assert got is table and np.allclose(got.T @ got, np.eye(20)) and np.allclose(got @ (got.T @ plain), plain)
    one = np.zeros((3000, 4))
    one[5] = 1
    assert np.allclose(np.abs(d._orthonormal(one)).max(axis=0)[0], 1)


def test_the_sums_of_a_product_are_added_in_parts(spark):
    """Every number of a row was a column of an aggregation of its own, which the driver planned and compiled."""
    rng = np.random.default_rng(13)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, 300) % 700) for _ in range(24)]
    idf, q = rng.random(d.DIMS) + 0.1, rng.standard_normal((d.DIMS, 5))
    docs = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string").repartition(4)
    weights = spark.sparkContext.broadcast(idf)
    whole, = d._product(weights, spark.sparkContext.broadcast(q.astype(np.float32)))(iter([pa.record_batch([pa.array(texts)], names=["text"])]))
    want = np.zeros(q.shape)
    want[whole.column(0).to_numpy()] = np.stack([c.to_numpy() for c in whole.columns[1:]], axis=1)
    packed, = d._in_parts(lambda batches: iter([whole]))(iter([]))
    dims = [np.frombuffer(x.as_buffer(), np.int64) for x in packed.column("dims")]
    assert np.array_equal(np.concatenate(dims), whole.column(0).to_numpy()) and all(len(set(x // d.PART)) == 1 for x in dims)
    got = d._times(docs, weights, q, np.empty_like(q))
    assert np.allclose(got, want, atol=1e-4) and np.count_nonzero(got.any(axis=1)) == whole.num_rows
    assert not d._times(docs.where("text = ''"), weights, q, q).any()


def test_the_last_product_goes_one_way():
    """Q'(A'(A Q)) took the way back to the dimensions, and a table of DIMS rows from each task."""
    class Held:
        def __init__(self, value):
            self.value = value

    rng = np.random.default_rng(14)
    texts = pa.array([None, "", *[" ".join(f"w{int(x)}" for x in rng.zipf(1.3, n) % 900) for n in (1, 33, 700, 5000)]], pa.string())
    idf, q = rng.random(d.DIMS) + 0.1, rng.standard_normal((d.DIMS, 6))
    batch = pa.record_batch([texts], names=["text"])
    whole, = d._product(Held(idf), Held(q))(iter([batch]))
    gram, = d._gram(Held(idf), Held(q))(iter([batch]))
    table = lambda b: np.stack([c.to_numpy() for c in b.columns[1:]], axis=1)
    assert gram.num_rows == 6 and np.allclose(table(gram), q[whole.column(0).to_numpy()].T @ table(whole))


def test_neighbours_are_settled_together(monkeypatch):
    """Every passage with enough words, in whatever order, had a common subsequence of its own."""
    rng = np.random.default_rng(15)
    item = list(range(30))
    own = np.concatenate([rng.permutation(30) for _ in range(12)]).astype(np.uint64)
    starts = list(range(0, len(own), d.STRIDE))
    calls, longest = [], d.common_subsequence
    monkeypatch.setattr(d, "common_subsequence", lambda *a: calls.append(1) or longest(*a))
    monkeypatch.setattr(d, "TOGETHER", 3)
    for k in range(60):
        noisy = own.copy()
        if k:
            at = int(rng.integers(0, len(own) - 30))
            noisy[at:at + 30] = np.where(rng.random(30) < 0.35, 99, np.arange(30))
        regions = [noisy[max(0, s - 30):s + d.WINDOW + 30].tolist() for s in starts]
        shares = [longest(item, r) / 30 for r in regions]
        got = d._settle(noisy, item, [28, 29], starts)
        assert got[0] == max(shares) if max(shares) >= d.ANSWERED_SHARE else got[0] < d.ANSWERED_SHARE
        answered = [longest([28, 29], r) / 2 for r, share in zip(regions, shares) if share >= d.ANSWERED_SHARE]
        assert got[1] == max(answered, default=0.0)
    calls.clear()
    descending = np.tile(np.arange(30)[::-1], 12).astype(np.uint64)
    assert d._settle(descending, item, [28, 29], starts) == (0.0, 0.0, False) and 0 < len(calls) < len(starts)


def test_places_of_frequent_words_are_looked_at_last(monkeypatch):
    """Every place of a frequent word was looked at for each item that has it."""
    texts = pa.array([" ".join(["the of and"] * 300 + [f"w{k}" for k in range(7)] + ["the of and"] * 300 + [f"w{k}" for k in range(7, 12)])])
    items = d.prepare_items([1], [" ".join(["the of and", *[f"w{k}" for k in range(12)]])], np.zeros((d.DIMS + 1, 2), np.float32))
    part, = batch_words(texts)
    seen, count = [], d.words_around
    monkeypatch.setattr(d, "words_around", lambda places, *a: seen.append(len(places)) or count(places, *a))
    monkeypatch.setattr(d, "ANSWERED_SHARE", 0.8)
    items.need[:] = 12
    assert list(d.held_words(part, d.passages(part)[1], items)) == [] and sum(seen) == 12
