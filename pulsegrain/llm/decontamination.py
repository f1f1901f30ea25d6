"""Benchmark decontamination by latent semantic retrieval.

Passages are TF-IDF vectors over DIMS hashed words. Document frequencies come
from all documents. A randomised SVD, done as distributed matrix products over
the passages of all documents and benchmark items, gives the latent space; the
driver only sees tables of DIMS x RANK numbers, and a task sends one such table
for up to SPLITS_A_TASK splits, cut into parts of PART dimensions that tasks
add up. Every passage of every document is folded in
and compared with the benchmark items by cosine; the items stand in blocks, so
one task holds BLOCK items at most. A short or much changed item fills little
of a passage and may have any cosine, so the cosine is given with a pair and
does not rule it out: a pair is settled at each passage that has as many of the
item's words around it as the lowest share takes. That count bounds the
subsequence from above, so no pair that meets the rules is lost. Pairs are
settled on words: the longest common subsequence of the item with the words
around the passage, as a share of the item, and whether the item's answer, its
last sentence, stands there too.

A document is contaminated by an item where that share reaches SHARE, or reaches
ANSWERED_SHARE with the answer. Passages are WINDOW words long, one beginning
every STRIDE words, to the end of the text.

Defined cases: null text counts as empty; texts and items without a word match
nothing; an empty benchmark or an empty table gives an empty result; repeated
rows are compared each, and equal rows of the result are given once. Other
columns are never looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.llm.batches import bound_batches
from pulsegrain.llm.bitmaps import row_key, without_rows
from pulsegrain.llm.words import Words, batch_words, text_bytes
from pulsegrain.session import written

BITS = 14
DIMS = 1 << BITS
RANK = 128
EXTRA = 8
POWER_STEPS = 2
PART = 256  # dimensions whose sums are one row of a task's table
SPLITS_A_TASK = 16  # splits whose passages one task multiplies, as its table of results is as large for one split
WINDOW, STRIDE = 32, 16
PHASE = 8  # an item's windows begin every PHASE words, since a document's may begin anywhere in it
SHARE = 0.7
ANSWERED_SHARE = 0.55
ANSWER_FOUND = 0.8
BLOCK = 10_000
MARKED = 64  # texts whose words are marked at once, 255 at most
STORED = 64  # passages of a stored row
GATHER = 256  # half windows whose words' vectors are held at once
ADDED = 1024  # sums of rows held at once
PASSAGES = 16384  # passages that are multiplied at once
DENSE = 1024  # of them, those in one matrix product
OFTEN = 32  # passages for each word that a dimension has among them, up to which a matrix product adds its words up
COSINES = 1 << 21  # cosines held at once
TOGETHER = 6  # neighbouring passages that are settled together first
RARE = 8  # places in a text up to which a word's own are looked at first
COUNTS = 1 << 18  # counts of common words held at once
SCHEMA = "doc_id long, item_id long, cosine double, lcs_share double, answer_share double, answer_found boolean"


def _dims(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold a word of each dimension, summed over the task."""
    total, docs = np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for part in batch_words(batch.column(0)):
            n = np.diff(part.bounds)
            docs += int(np.count_nonzero(n))
            dims = _dims(part.hashes)
            some = np.flatnonzero(n)
            for first in range(0, len(some), MARKED):
                own = some[first:first + MARKED]
                held = np.zeros((len(own), DIMS), np.uint8)
                low, high = part.bounds[own[0]], part.bounds[own[-1] + 1]
                held.ravel()[np.repeat(np.arange(len(own)) << BITS, n[own]) + dims[low:high]] = 1
                total += held.sum(axis=0, dtype=np.uint8)
    some = np.flatnonzero(total)
    yield pa.record_batch([pa.array(np.append(some, -1)), pa.array(np.append(total[some], docs))], names=["dim", "n"])


def inverse_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The weight of each dimension, from all documents. The driver receives DIMS numbers."""
    counts = docs.select(F.col(text).alias("text")).mapInArrow(_count_words, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    dims, n = found.column("dim").to_numpy(), found.column("n").to_numpy()
    total = int(n[dims < 0].sum())
    seen = np.zeros(DIMS)
    seen[dims[dims >= 0]] = n[dims >= 0]
    return np.log((total + 1) / (seen + 1)) + 1e-3


@dataclass
class Passages:
    """Windows of the texts of a batch: the text and first word of each, and halves as vectors to add."""

    text: np.ndarray
    start: np.ndarray
    first_half: np.ndarray


def passages(words: Words, stride: int = STRIDE) -> tuple[np.ndarray, Passages]:
    """Where each half window starts among the words, and the windows of two halves.

    The last half of a text may be short; a text of one half is one window.
    """
    n = np.diff(words.bounds)
    halves = -(-n // stride)
    first = np.cumsum(halves) - halves
    owner = np.repeat(np.arange(len(n)), halves)
    step = np.arange(len(owner)) - first[owner]
    starts = words.bounds[owner] + step * stride
    window = (step == 0) | (step < halves[owner] - 1)
    return starts, Passages(owner[window], (step * stride)[window], np.flatnonzero(window))


def _window_vectors(words: Words, table: np.ndarray, stride: int) -> tuple[np.ndarray, Passages]:
    """The sum of the table's rows over each window's words. The table's last row is zero."""
    starts, found = passages(words, stride)
    if not len(starts):
        return np.empty((0, table.shape[1]), table.dtype), found
    # Every half has its words in a row of ``stride`` places; places beyond its end hold the added zero row.
    dims = np.append(_dims(words.hashes), len(table) - 1)
    places = starts[:, None] + np.arange(stride)
    ends = np.append(starts[1:], len(dims) - 1)
    index = dims[np.where(places < ends[:, None], places, len(dims) - 1)]
    sums = np.empty((len(starts), table.shape[1]), table.dtype)
    for at in range(0, len(starts), GATHER):
        part = index[at:at + GATHER]
        held = table[part[:, 0]]
        for step in range(1, stride):
            held += table[part[:, step]]
        sums[at:at + GATHER] = held
    vectors = sums[found.first_half]
    following = found.first_half + 1
    second = following < len(starts)
    text_of_half = np.searchsorted(words.bounds, starts, "right") - 1
    second[second] = text_of_half[following[second]] == found.text[second]
    vectors[second] += sums[following[second]]
    return vectors, found


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def _passage_dims(words: Words) -> np.ndarray:
    """The dimensions of the words of each passage in order, a row for each; places beyond its end hold DIMS."""
    starts = passages(words, WINDOW)[0]
    dims = np.append(_dims(words.hashes), DIMS).astype(np.uint16)
    places = starts[:, None] + np.arange(WINDOW)
    ends = np.append(starts[1:], len(dims) - 1)
    return np.sort(dims[np.where(places < ends[:, None], places, len(dims) - 1)], axis=1)


def _store_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``_passage_dims`` as bytes, STORED of them in a row."""
    for batch in batches:
        for words in batch_words(batch.column(0)):
            if len(words.hashes):
                rows = _passage_dims(words)
                offsets = np.append(np.arange(0, len(rows), STORED), len(rows)).astype(np.int32) * rows[0].nbytes
                yield pa.record_batch([pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(rows)])],
                                      names=["passages"])


def _passage_rows(column: pa.Array) -> Iterator[np.ndarray]:
    """The rows of ``_passage_dims`` for texts, or as ``_store_passages`` stored them."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        data, offsets = text_bytes(column)
        yield data[offsets[0]:offsets[-1]].view(np.uint16).reshape(-1, WINDOW)
    else:
        yield from (_passage_dims(words) for words in batch_words(column) if len(words.hashes))


def _lengths(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The length of each passage's TF-IDF vector."""
    new = np.ones(rows.shape, bool)
    new[:, 1:] = rows[:, 1:] != rows[:, :-1]
    heads = np.flatnonzero(new)
    value = np.diff(np.append(heads, rows.size)) * idf[rows.ravel()[heads]]
    return np.sqrt(np.bincount(heads // WINDOW, value ** 2))


def _add_rows(out: np.ndarray, into: np.ndarray, counts: np.ndarray, table: np.ndarray, at: np.ndarray) -> None:
    """Adds to row ``into[i]`` of ``out`` the next ``counts[i]`` rows of the table that ``at`` names.

    The first of every run are added at once, then the second, and so on, so a
    row for each run is all that is held.
    """
    heads = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    heads, falling, into = heads[order], -counts[order], into[order]
    held = np.empty((min(len(order), ADDED), table.shape[1]), table.dtype)
    for low in range(0, len(order), ADDED):
        here = slice(low, low + ADDED)
        sums = table[at[heads[here]]]
        for place in range(1, -int(falling[low])):
            some = int(np.searchsorted(falling[here], -place, "left"))
            np.take(table, at[heads[low:low + some] + place], axis=0, out=held[:some], mode="clip")
            sums[:some] += held[:some]
        out[into[here]] += sums


def _multiplied(rows: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """C T, C being the word counts of the passages; the dimensions with many words among them, their counts, and which words these are.

    Dimensions with many words meet the passages in a matrix product, the words
    of the others are added one by one.
    """
    n = len(rows)
    flat = rows.ravel()
    many = np.flatnonzero(np.bincount(flat, minlength=DIMS + 1)[:DIMS] * OFTEN > n)
    column = np.full(DIMS + 1, -1, np.int32)
    column[many] = np.arange(len(many))
    column[DIMS] = len(many)
    where = column[rows]
    often = where >= 0
    dense = np.empty((n, len(many)), np.uint8)
    held = np.empty((n, table.shape[1]), table.dtype)
    for low in range(0, n, DENSE):
        some = often[low:low + DENSE]
        cells = (np.arange(len(some))[:, None] * (len(many) + 1) + where[low:low + DENSE])[some]
        dense[low:low + DENSE] = np.bincount(cells, minlength=len(some) * (len(many) + 1)).reshape(len(some), -1)[:, :-1]
        held[low:low + DENSE] = dense[low:low + DENSE].astype(table.dtype) @ table[many]
    alone = rows.shape[1] - np.count_nonzero(often, axis=1)
    some = np.flatnonzero(alone)
    _add_rows(held, some, alone[some], table, flat[~often.ravel()])
    return held, many, dense, often.ravel()


def _add_product(rows: np.ndarray, scale: np.ndarray, table: np.ndarray, total: np.ndarray) -> None:
    """Adds C'(S^2 (C T)) to ``total``, S being the scale of the passages."""
    held, many, dense, often = _multiplied(rows, table)
    held *= scale[:, None] ** 2
    for low in range(0, len(rows), DENSE):
        total[many] += dense[low:low + DENSE].T.astype(table.dtype) @ held[low:low + DENSE]
    flat = rows.ravel()
    order = np.argsort(flat, kind="stable")
    counts = np.bincount(flat[~often], minlength=DIMS)
    few = np.flatnonzero(counts)
    _add_rows(total, few, counts[few], held, (order // rows.shape[1])[~often[order]])


def _add_gram(rows: np.ndarray, scale: np.ndarray, table: np.ndarray, total: np.ndarray) -> None:
    """Adds (S C T)'(S C T) to ``total``, which takes the way to the passages only."""
    held = _multiplied(rows, table)[0]
    held *= scale[:, None]
    for low in range(0, len(rows), DENSE):
        total += held[low:low + DENSE].T @ held[low:low + DENSE]


def _added(weights: Broadcast, basis: Broadcast, add, dims: int | None):
    """What ``add`` sums up over the passages of a task; a row for each of ``dims``, or of the basis's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, q = np.append(weights.value, 0.0), basis.value
        table = np.vstack([q * idf[:-1, None].astype(q.dtype), np.zeros((1, q.shape[1]), q.dtype)])
        total = np.zeros((dims or q.shape[1], q.shape[1]))
        waiting: list[np.ndarray] = []

        def multiply(least: int) -> None:
            while sum(map(len, waiting)) >= least:
                rows = np.concatenate(waiting)
                add(rows[:PASSAGES], (1 / _lengths(rows[:PASSAGES], idf)).astype(q.dtype), table, total)
                waiting[:] = [rows[PASSAGES:]]

        for batch in batches:
            for rows in _passage_rows(batch.column(0)):
                waiting.append(rows)
                multiply(PASSAGES)
        multiply(1)
        if dims:
            total *= idf[:-1, None]
        some = np.flatnonzero(total.any(axis=1))
        yield pa.record_batch([pa.array(some), *[pa.array(total[some, i]) for i in range(q.shape[1])]],
                              names=["dim", *[f"y{i}" for i in range(q.shape[1])]])

    return run


def _product(weights: Broadcast, basis: Broadcast):
    """A'(A Q) for the passages of a task: the rows of A are unit TF-IDF vectors, Q is DIMS x l."""
    return _added(weights, basis, _add_product, DIMS)


def _gram(weights: Broadcast, basis: Broadcast):
    """(A Q)'(A Q) for the passages of a task, l x l."""
    return _added(weights, basis, _add_gram, None)


def _orthonormal(table: np.ndarray, rows: int = 1024) -> np.ndarray:
    """An orthonormal basis of the table's columns, in the table's place: blocks of rows first, then what is left of them."""
    blocks = [slice(at, at + rows) for at in range(0, len(table), rows)]
    rest = []
    for block in blocks:
        table[block], r = np.linalg.qr(table[block])
        rest.append(r)
    turns = np.linalg.qr(np.concatenate(rest))[0]
    for block, turn in zip(blocks, np.split(turns, len(blocks))):
        table[block] = table[block] @ turn
    return table


def _in_parts(run):
    """The tables of ``run``, a column for the dimension and one for each number, as rows of PART dimensions in bytes."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            dims = batch.column(0).to_numpy()
            sums = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1)
            parts, first = np.unique(dims // PART, return_index=True)
            rows = list(zip(np.split(dims, first[1:]), np.split(sums, first[1:]))) if len(dims) else []
            yield pa.record_batch([pa.array(parts, pa.int64()), pa.array([d.tobytes() for d, _ in rows], pa.binary()), pa.array([t.tobytes() for _, t in rows], pa.binary())],
                                  names=["part", "dims", "sums"])

    return packed


def _unpacked(dims: pa.BinaryScalar, sums: pa.BinaryScalar) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(dims.as_buffer(), np.int64)
    return at, np.frombuffer(sums.as_buffer(), np.float64).reshape(len(at), -1)


def _add_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of all rows of each part; a part's rows are in one task."""
    totals: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for part, *row in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            dims, sums = _unpacked(*row)
            if part not in totals:
                totals[part] = np.zeros((PART, sums.shape[1])), np.zeros(PART, bool)
            total, seen = totals[part]
            total[dims - part * PART] += sums
            seen[dims - part * PART] = True
    for part, (total, seen) in totals.items():
        some = np.flatnonzero(seen)
        yield pa.record_batch([pa.array([(some + part * PART).tobytes()], pa.binary()), pa.array([total[some].tobytes()], pa.binary())], names=["dims", "sums"])


def _times(passages: DataFrame, weights: Broadcast, q: np.ndarray, out: np.ndarray, product=_product) -> np.ndarray:
    """A'A Q, or another product, by one Spark job into ``out``, which may be Q; its result has DIMS x l numbers at most."""
    basis = passages.sparkSession.sparkContext.broadcast(q.astype(np.float32))
    parts = passages.mapInArrow(_in_parts(product(weights, basis)), "part long, dims binary, sums binary").repartition("part")
    found = parts.mapInArrow(_add_parts, "dims binary, sums binary").toArrow()
    out[:] = 0
    for row in zip(found.column("dims"), found.column("sums")):
        dims, sums = _unpacked(*row)
        out[dims] = sums
    basis.destroy()
    return out


def latent_space(texts: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """The table that folds a passage's word counts into the latent space: a row for each dimension, and a zero row.

    Randomised subspace iteration on A'A. The columns are right singular
    vectors over their singular values, times the words' weights. The texts are
    read once, and their passages stored.
    """
    spark = texts.sparkSession
    splits = texts.rdd.getNumPartitions()
    held = written(texts.mapInArrow(_store_passages, "passages binary"), "passages")
    held = held.coalesce(min(splits, max(spark.sparkContext.defaultParallelism, -(-splits // SPLITS_A_TASK))))
    weights = spark.sparkContext.broadcast(idf)
    q = _orthonormal(np.random.default_rng(seed).standard_normal((DIMS, rank + EXTRA)))
    for _ in range(POWER_STEPS):
        q = _orthonormal(_times(held, weights, q, q))
    values, turn = np.linalg.eigh(_times(held, weights, q, np.empty((q.shape[1], q.shape[1])), _gram))
    weights.destroy()
    values, turn = values[::-1][:rank], turn[:, ::-1][:, :rank]
    keep = values > 1e-6 * max(values[0], 1e-12)
    table = ((q @ turn[:, keep]) / np.sqrt(values[keep]) * idf[:, None]).astype(np.float32)
    return np.vstack([table, np.zeros((1, table.shape[1]), np.float32)])


def common_subsequence(item: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, a bit of an integer for each word of the item."""
    places: dict[int, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in text:
        hit = row & places.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


@dataclass
class Items:
    """A block of benchmark items: their words, answers and window vectors."""

    ids: list[int]
    words: list[list[int]]
    answers: list[list[int]]
    vectors: np.ndarray
    owner: np.ndarray
    vocabulary: np.ndarray  # the distinct words of all items, sorted
    begun: np.ndarray  # item i has the distinct words places[begun[i]:begun[i + 1]] of the vocabulary, as often as often tells
    places: np.ndarray
    often: np.ndarray
    first: np.ndarray  # word i stands in holders[first[i]:first[i + 1]], as often as times tells
    holders: np.ndarray
    times: np.ndarray
    need: np.ndarray  # words of each item that the lowest share takes


def answer_of(text: str) -> str:
    """The last sentence."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if re.search(r"\w", p)]
    return parts[-1] if parts else ""


def prepare_items(ids: list, texts: list[str | None], fold: np.ndarray) -> Items:
    none = np.empty(0, np.int64)
    items = Items([], [], [], np.empty((0, fold.shape[1]), np.float32), none, np.empty(0, np.uint64), np.zeros(1, np.int64), none, none, np.zeros(1, np.int64), none, none, none)
    vectors, owner = [], []
    answers = [a for part in batch_words(pa.array([answer_of(t or "") for t in texts], pa.string()))
               for a in np.split(part.hashes, part.bounds[1:-1])]
    for part in batch_words(pa.array(texts, pa.string())):
        for i in range(len(part.bounds) - 1):
            own = part.hashes[part.bounds[i]:part.bounds[i + 1]]
            if len(own):
                rows = fold[_dims(own)]
                begins = range(0, max(len(own) - WINDOW, 0) + PHASE, PHASE)
                vectors.append(np.stack([rows[b:b + WINDOW].sum(axis=0) for b in begins]))
                owner.append(np.full(len(begins), len(items.ids)))
                items.ids.append(ids[part.first + i])
                items.words.append(own.tolist())
                items.answers.append(answers[part.first + i].tolist())
    if vectors:
        items.vectors, items.owner = _unit(np.concatenate(vectors)), np.concatenate(owner)
        sizes = np.array([len(w) for w in items.words])
        items.need = np.maximum(1, np.ceil(ANSWERED_SHARE * sizes - 1e-9)).astype(np.int64)
        items.vocabulary, word = np.unique(np.concatenate([np.array(w, np.uint64) for w in items.words]), return_inverse=True)
        pair, items.times = np.unique(word * len(sizes) + np.repeat(np.arange(len(sizes)), sizes), return_counts=True)
        items.holders = pair % len(sizes)
        items.first = np.searchsorted(pair // len(sizes), np.arange(len(items.vocabulary) + 1))
        by_item = np.lexsort((pair // len(sizes), items.holders))
        items.places, items.often = (pair // len(sizes))[by_item], items.times[by_item]
        items.begun = np.searchsorted(items.holders[by_item], np.arange(len(sizes) + 1))
    return items


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each first one on, as many as its size tells."""
    ends = np.cumsum(sizes)
    return np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _split(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of neighbours whose sizes add up to ``most`` at most, one at least."""
    ends, low = np.cumsum(sizes), 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + most, "right")))
        yield slice(low, high)
        low = high


def held_words(words: Words, windows: Passages, items: Items) -> Iterator[tuple[int, int, list[int]]]:
    """Text, item and passage starts wherever the words around hold enough of the item's words for the lowest share."""
    if not len(items.vocabulary) or not len(words.hashes):
        return
    known = np.zeros(DIMS, bool)
    known[_dims(items.vocabulary)] = True
    at = np.flatnonzero(known[_dims(words.hashes)])
    word = np.searchsorted(items.vocabulary, words.hashes[at])
    word[word == len(items.vocabulary)] = 0
    same = items.vocabulary[word] == words.hashes[at]
    at, word = at[same], word[same]
    text = np.searchsorted(words.bounds, at, "right") - 1
    # The places of each word of each text, one after the other.
    key = text * len(items.vocabulary) + word
    order = np.argsort(key, kind="stable")
    key, places = key[order], (at - words.bounds[text])[order]
    begun = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    pair, ends = key[begun], np.append(begun[1:], len(key))
    pair_text, pair_word = pair // len(items.vocabulary), pair % len(items.vocabulary)
    n, texts = len(items.ids), len(words.bounds) - 1
    n_windows = np.bincount(windows.text, minlength=texts)
    length = np.array([len(w) for w in items.words])
    holders = items.first[pair_word + 1] - items.first[pair_word]
    def around(of_text: np.ndarray, of_item: np.ndarray, owner: np.ndarray, found: np.ndarray, often: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Runs of the pairs, where each one's numbers begin, and the numbers of ``words_around``."""
        size = ends[found] - begun[found]
        of_pair = np.searchsorted(owner, np.arange(len(of_text) + 1))
        whole = np.concatenate([[0], np.cumsum(size)])[of_pair]
        count = n_windows[of_text]
        for run in _split(np.diff(whole) + count, COUNTS):
            here = slice(of_pair[run.start], of_pair[run.stop])
            yield run, np.cumsum(count[run] + 1) - count[run] - 1, words_around(
                places[_ranges(begun[found[here]], size[here])], size[here], owner[here] - run.start, often[here], count[run], length[of_item[run]])

    step = max(1, COUNTS // n)
    for low in range(0, texts, step):
        high = min(texts, low + step)
        begin, end = np.searchsorted(pair_text, (low, high))
        counts = np.zeros((high - low) * n, np.int64)
        for part in _split(holders[begin:end], COUNTS):
            some = np.arange(begin + part.start, begin + part.stop)
            place = _ranges(items.first[pair_word[some]], holders[some])
            here = np.repeat((pair_text[some] - low) * n, holders[some]) + items.holders[place]
            counts += np.bincount(here, items.times[place], len(counts)).astype(np.int64)
        of_text, of_item = np.nonzero(counts.reshape(-1, n) >= items.need)
        of_text += low
        # Every distinct word of the item that the text has.
        sizes = items.begun[of_item + 1] - items.begun[of_item]
        for part in _split(sizes, COUNTS):
            wanted = _ranges(items.begun[of_item[part]], sizes[part])
            owner = np.repeat(np.arange(part.stop - part.start), sizes[part])
            asked = of_text[part][owner] * len(items.vocabulary) + items.places[wanted]
            found = np.searchsorted(pair, asked)
            found[found == len(pair)] = 0
            has = pair[found] == asked
            found, owner, often = found[has], owner[has], items.often[wanted[has]]
            # First a word with many places counts as near to every passage: few pairs are left whose places are all looked at.
            rare = ends[found] - begun[found] <= RARE
            most = np.bincount(owner[~rare], often[~rare], part.stop - part.start).astype(float)
            for run, window, counts in around(of_text[part], of_item[part], owner[rare], found[rare], often[rare]):
                most[run] += np.maximum.reduceat(counts, window)
            hopeful = most >= items.need[of_item[part]]
            left = hopeful[owner]
            text_left, item_left = of_text[part][hopeful], of_item[part][hopeful]
            for run, window, counts in around(text_left, item_left, (np.cumsum(hopeful) - 1)[owner[left]], found[left], often[left]):
                least = np.repeat(items.need[item_left[run]], np.diff(np.append(window, len(counts))))
                enough = np.flatnonzero(counts >= least)
                whose = np.searchsorted(window, enough, "right") - 1
                cuts = np.flatnonzero(whose[1:] != whose[:-1]) + 1
                for starts, one in zip(np.split((enough - window[whose]) * STRIDE, cuts), whose[np.append(0, cuts)] if len(whose) else ()):
                    yield int(text_left[run][one]), int(item_left[run][one]), starts.tolist()


def words_around(places: np.ndarray, sizes: np.ndarray, owner: np.ndarray, often: np.ndarray, windows: np.ndarray, length: np.ndarray) -> np.ndarray:
    """How many of an item's words stand in the region of each passage, which reaches ``length`` words beyond it, for pairs of a text and an item.

    Pair i has ``windows[i]`` passages and gets one number more, which is 0. A
    word of pair ``owner[j]`` has the next ``sizes[j]`` of ``places`` in the
    text, in order; it counts as ``often[j]`` wherever the region has it at all.
    """
    pair = np.repeat(owner, sizes)
    first = np.clip((places - WINDOW - length[pair]) // STRIDE + 1, 0, windows[pair])
    last = np.clip((places + length[pair]) // STRIDE + 1, 0, windows[pair])
    # The regions that a word's place before has reached already do not count it again.
    same = np.ones(len(places), bool)
    same[np.cumsum(sizes) - sizes] = False
    same = np.flatnonzero(same)
    first[same] = np.maximum(first[same], last[same - 1])
    weight = np.where(last > first, np.repeat(often, sizes), 0)
    begun = np.cumsum(windows + 1) - windows - 1
    n = int(np.sum(windows + 1))
    return np.cumsum(np.bincount(begun[pair] + first, weight, n) - np.bincount(begun[pair] + last, weight, n))


def common_words(places: np.ndarray, word: np.ndarray, often: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """``words_around`` for one pair: ``places`` are where the text has words of the item, in order, and ``word`` which ones."""
    order = np.argsort(word, kind="stable")
    distinct, sizes = np.unique(word, return_counts=True)
    return words_around(places[order], sizes, np.zeros(len(distinct), np.int64), often[distinct], np.array([len(starts)]), np.array([length]))[:-1]


def nearest_cosines(vectors: np.ndarray, windows: Passages, items: Items, texts: int) -> np.ndarray:
    """The highest cosine of each text's passages with each item's windows; -1 for a text without passages."""
    best = np.full((texts, len(items.ids)), -1, np.float32)
    if not len(items.vectors):
        return best
    # The items' first windows, then the second ones of those that have two, and so on; the items with the most come first.
    counts = np.bincount(items.owner, minlength=len(items.ids))
    order = np.argsort(-counts, kind="stable")
    heads = np.cumsum(counts) - counts
    rounds = [heads[order[counts[order] > k]] + k for k in range(int(counts.max()))]
    columns = items.vectors[np.concatenate(rounds)].T
    place = np.argsort(order)
    step = max(1, COSINES // len(items.vectors))
    for at in range(0, len(vectors), step):
        cosines = vectors[at:at + step] @ columns
        near, first = cosines[:, :len(order)], len(order)
        for more in rounds[1:]:
            np.maximum(near[:, :len(more)], cosines[:, first:first + len(more)], out=near[:, :len(more)])
            first += len(more)
        text = windows.text[at:at + step]
        begun = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        best[text[begun]] = np.maximum(best[text[begun]], np.maximum.reduceat(near, begun, axis=0)[:, place])
    return best


def _search(space: Broadcast, block: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, items = space.value, block.value
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for words in batch_words(batch.column(1)):
                vectors, windows = _window_vectors(words, fold, STRIDE)
                nearest = nearest_cosines(_unit(vectors), windows, items, len(words.bounds) - 1)
                for text, item, begun in held_words(words, windows, items):
                    own = words.hashes[words.bounds[text]:words.bounds[text + 1]]
                    shares = _settle(own, items.words[item], items.answers[item], begun)
                    if shares[0] >= ANSWERED_SHARE:
                        out.append((ids[words.first + text], items.ids[item], float(nearest[text, item]), *shares))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.record_batch([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    return run


def _hopeful(own: np.ndarray, item: list[int], starts: list[int]) -> Iterator[int]:
    """The passages but for runs of TOGETHER neighbours whose words together hold less than ANSWERED_SHARE of the item in its order, as then each does."""
    words, first = set(item), 0
    while first < len(starts):
        run = [s for s in starts[first:first + TOGETHER] if s <= starts[first] + TOGETHER * STRIDE]
        first += len(run)
        if len(run) > 1:
            region = [w for w in own[max(0, run[0] - len(item)):run[-1] + WINDOW + len(item)].tolist() if w in words]
            if common_subsequence(item, region) / len(item) < ANSWERED_SHARE:
                continue
        yield from run


def _settle(own: np.ndarray, item: list[int], answer: list[int], starts: list[int]) -> tuple[float, float, bool]:
    """The best share of the item in the words around the candidate passages, and the best share of its answer where the item's reaches ANSWERED_SHARE.

    A region reaches an item's length beyond the passage on both sides. Shares
    below ANSWERED_SHARE decide nothing and may be given as 0.
    """
    share = answered = 0.0
    last = len(own)
    # Other words are in no common subsequence.
    words = set(item) | set(answer)
    for start in _hopeful(own, item, sorted(set(starts))):
        region = [w for w in own[max(0, start - len(item)):min(last, start + WINDOW + len(item))].tolist() if w in words]
        known = set(region)
        most = sum(w in known for w in item) / len(item)
        if most < ANSWERED_SHARE or (most <= share and (answered >= 1 or not answer)):
            continue  # no common subsequence can be longer than the common words
        here = common_subsequence(item, region) / len(item)
        share = max(share, here)
        if here >= ANSWERED_SHARE and answer:
            answered = max(answered, common_subsequence(answer, region) / len(answer))
    return share, answered, answered >= ANSWER_FOUND


def find_contamination(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", rank: int = RANK, block: int = BLOCK) -> DataFrame:
    """One row for every document and item that contaminates it."""
    spark = docs.sparkSession
    bound_batches(spark)
    source = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    items = written(benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")), "items")
    blocks = max(1, -(-items.count() // block))
    fold = latent_space(source.select("text").unionByName(items.select("text")), inverse_frequencies(source), rank)
    space = spark.sparkContext.broadcast(fold)
    found = None
    for number in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).orderBy("item_id", "text").collect() if blocks > 1 else items.orderBy("item_id", "text").collect()
        held = spark.sparkContext.broadcast(prepare_items([r["item_id"] for r in part], [r["text"] for r in part], fold))
        hits = source.mapInArrow(_search(space, held), SCHEMA)
        found = hits if found is None else found.unionByName(hits)
    sure = (F.col("lcs_share") >= SHARE) | ((F.col("lcs_share") >= ANSWERED_SHARE) & F.col("answer_found"))
    return found.where(sure).distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, with all their columns.

    A row goes by its own text, whatever other rows have its id or have none.
    """
    key = row_key(F.col(id), F.col(text))
    found = find_contamination(docs.select(key.alias("key"), F.col(text).alias("text")), benchmark, "key", "text")
    return without_rows(docs, key, found.select("doc_id"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
