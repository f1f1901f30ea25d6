"""Runs of characters of many texts at once, as hashes in numpy.

A run is a number of characters one after the other. Texts are worked on as
one array of UTF-8 bytes, in slices of bounded size, so no object is made for a
run. Sums over the bytes give the hash of any stretch by two look-ups. Hashes
only tell where to look: what is found is compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast

SLICE_BYTES = 1 << 18
# Candidates that are compared at once, and bytes of text in a batch of results, one row at least.
AT_ONCE = 1 << 20
OUT_BYTES = 4 << 20
# Places of a table of known runs: 2^SPARE for each run, 2^MOST_BITS at most.
SPARE, MOST_BITS = 4, 22

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}

Batches = Iterator[pa.RecordBatch]


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("base", ())) < n:
        for name, base in (("base", _BASE), ("inverse", _INVERSE)):
            steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["base"], _powers["inverse"]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit; odd, so 0 is no run's."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x |= np.uint64(1)
    return x


@dataclass
class Part:
    """Texts ``first`` to ``first + len(borders) - 2`` of a batch: their bytes, and the sums that give hashes."""

    first: int
    data: np.ndarray
    borders: np.ndarray
    sums: np.ndarray
    inverse: np.ndarray

    def stretch(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The hash of the bytes from each low to each high place."""
        return (self.sums[high] - self.sums[low]) * self.inverse[low]


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the border of each text; null has none."""
    values = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(values):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    data = values.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), offsets


def parts_of(texts: pa.Array) -> Iterator[Part]:
    """The texts in slices of SLICE_BYTES, one text at least."""
    data, offsets = _bytes(texts)
    first = 0
    while first < len(offsets) - 1:
        last = max(int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1, first + 1)
        own = data[offsets[first]:offsets[last]]
        base, inverse = _up_to(len(own) + 1)
        sums = np.zeros(len(own) + 1, np.uint64)
        np.cumsum((own.astype(np.uint64) + np.uint64(1)) * base[:len(own)], out=sums[1:])
        yield Part(first, own, offsets[first:last + 1] - offsets[first], sums, inverse)
        first = last


def hash_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each whole text as a run, and as a stretch."""
    plain = np.concatenate([np.empty(0, np.uint64), *(p.stretch(p.borders[:-1], p.borders[1:]) for p in parts_of(texts))])
    return _mixed(plain), plain


def hashed(column: str, names: list[str]) -> Callable[[Batches], Batches]:
    """The batches with the hash of a column's runs as ``_run``."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield batch.select(names).append_column("_run", pa.array(hash_of(batch.column(column))[0].view(np.int64)))

    return run


def runs_of(gram: int) -> Callable[[Batches], Batches]:
    """Each keyword with each of its runs of ``gram`` characters once, as text, length and hash; a shorter one is its own run."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            own = [sorted({k[i:i + gram] for i in range(max(1, len(k) - gram + 1))}) for k in batch.column(0).to_pylist()]
            whose = np.repeat(np.arange(len(own)), [len(r) for r in own])
            made = pa.array([r for rs in own for r in rs], pa.string())
            for rows in _rows(batch, whose, made, np.diff(_bytes(batch.column(0))[1]), ["keyword", "run"]):
                part = rows.column(1)
                sizes = pa.array([len(r) for r in part.to_pylist()], pa.int32())
                yield rows.append_column("size", sizes).append_column("_run", pa.array(hash_of(part)[0].view(np.int64)))

    return run


@dataclass
class Known:
    """The runs that are looked for, by hash: a table of their first bits, and the hashes in order or only the table."""

    sizes: list[int]
    full: np.ndarray
    hashes: np.ndarray | None = None
    first: np.ndarray | None = None

    def where(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes may be known, and the number of each among the known ones; without these the hash itself."""
        shift = np.uint64(64 - (len(self.full).bit_length() - 1))
        slot = (hashes >> shift).view(np.int64)
        at = np.flatnonzero(np.take(self.full, slot))
        own = hashes[at]
        if self.hashes is None:
            return at, own
        place, end = self.first[slot[at]], self.first[slot[at] + 1]
        open_ = np.flatnonzero(self.hashes[place] != own)
        while len(open_):
            place[open_] += 1
            open_ = open_[place[open_] < end[open_]]
            open_ = open_[self.hashes[place[open_]] != own[open_]]
        found = place < end
        return at[found], place[found]

    def runs_in(self, part: Part) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Text, first byte and number of the known runs in the part's texts, those of one size at a time."""
        begins = np.flatnonzero((part.data & 0xC0) != 0x80)
        begins = np.append(begins, len(part.data))
        sums, inverse = (part.sums, part.inverse) if len(begins) > len(part.data) else (part.sums[begins], part.inverse[begins])
        for size in self.sizes:
            if len(begins) <= size:
                continue
            hashes = (sums[size:] - sums[:-size]) * inverse[:len(begins) - size]
            at, what = self.where(_mixed(hashes))
            low, high = begins[at], begins[at + size]
            text = np.searchsorted(part.borders, low, "right") - 1
            inside = high <= part.borders[text + 1]
            yield text[inside], low[inside], what[inside]


def known(sizes: list[int], hashes: np.ndarray) -> Known:
    """All runs, ``hashes`` being theirs, in order and each once."""
    bits = min(MOST_BITS, max(1, len(hashes).bit_length() + SPARE))
    first = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int64)
    first = np.append(first, len(hashes))
    return Known(sizes, first[1:] > first[:-1], hashes, first)


def counted(runs: Broadcast) -> Callable[[Batches], Batches]:
    """How many texts of a task hold each known run: its hash and the number; several numbers for a run of those not held."""

    def run(batches: Batches) -> Batches:
        what = runs.value
        total = None if what.hashes is None else np.zeros(len(what.hashes), np.int64)
        for batch in batches:
            for part in parts_of(batch.column(0)):
                for text, _, number in what.runs_in(part):
                    if total is not None:
                        np.add.at(total, _pairs(text, number, len(total))[1], 1)
                        continue
                    order = np.lexsort((text, number))
                    text, number = text[order], number[order]
                    hashes, n = np.unique(number[np.append(True, (text[1:] != text[:-1]) | (number[1:] != number[:-1]))[:len(text)]], return_counts=True)
                    yield pa.record_batch([pa.array(hashes.view(np.int64)), pa.array(n)], names=["_run", "n"])
        if total is not None:
            some = np.flatnonzero(total)
            yield pa.record_batch([pa.array(what.hashes[some].view(np.int64)), pa.array(total[some])], names=["_run", "n"])

    return run


def _pairs(text: np.ndarray, number: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text with each of its numbers below ``size`` once."""
    key = text * size + number
    if len(key) and key.max() < 1 << 32:
        key = key.astype(np.uint32)
    key.sort()
    key = key[np.append(True, key[1:] != key[:-1])[:len(key)]].astype(np.int64)
    return key // max(1, size), key % max(1, size)


def _rows(batch: pa.RecordBatch, rows: np.ndarray, more: pa.Array, sizes: np.ndarray, schema: pa.Schema) -> Batches:
    """The rows of a batch with one column more, in batches of bounded size."""
    ends, low = np.cumsum(sizes[rows] + 64), 0
    while low < len(rows):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + OUT_BYTES, "right")))
        yield pa.record_batch([*batch.take(pa.array(rows[low:high])).columns, more.slice(low, high - low)], names=schema)
        low = high


def offered(runs: Broadcast, column: str, names: list[str], every: bool) -> Callable[[Batches], Batches]:
    """Each row with each known run its text may hold, as ``_run``; with ``every``, 0 is one of a text's runs."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            batch = batch.select(names)
            texts = batch.column(column)
            sizes = np.diff(_bytes(texts)[1])
            there = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
            if every:
                yield from _rows(batch, there, pa.array(np.zeros(len(there), np.int64)), sizes, [*names, "_run"])
            for part in parts_of(texts):
                for text, _, number in runs.value.runs_in(part):
                    order = np.lexsort((number, text))
                    text, number = text[order], number[order]
                    new = np.append(True, (text[1:] != text[:-1]) | (number[1:] != number[:-1]))[:len(text)]
                    yield from _rows(batch, part.first + text[new], pa.array(number[new].view(np.int64)), sizes, [*names, "_run"])

    return run


@dataclass
class Filed:
    """Keywords by their runs: run i of ``runs`` has the keywords first[i] to first[i + 1], each with the place of the run in it."""

    runs: Known
    keywords: pa.Array
    first: np.ndarray
    place: np.ndarray
    length: np.ndarray
    hashes: np.ndarray


def filed(keywords: pa.Array, runs: pa.Array) -> Filed:
    """The keywords, each under its run."""
    hashes = hash_of(runs)[0]
    order = np.argsort(hashes, kind="stable")
    keywords, runs, hashes = keywords.take(pa.array(order)), runs.take(pa.array(order)), hashes[order]
    unique, first = np.unique(hashes, return_index=True)
    place = np.array([k.as_py().encode().find(r.as_py().encode()) for k, r in zip(keywords, runs)], np.int64)
    sizes = sorted({len(r) for r in runs.to_pylist()})
    return Filed(known(sizes, unique), keywords, np.append(first, len(hashes)), place, np.diff(_bytes(keywords)[1]), hash_of(keywords)[1])


def keywords_in(part: Part, words: Filed) -> tuple[np.ndarray, np.ndarray]:
    """Each text of a part with the number of each keyword it contains, once."""
    none = np.empty(0, np.int64)
    found = [(none, none, none)]
    for text, low, number in words.runs.runs_in(part):
        count = words.first[number + 1] - words.first[number]
        ends, begin = np.cumsum(count), 0
        while begin < len(count):
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + AT_ONCE, "right")))
            who = np.repeat(np.arange(begin, end), count[begin:end])
            word = words.first[number[who]] + np.arange(len(who)) - np.repeat(ends[begin:end] - count[begin:end] - (ends[begin - 1] if begin else 0), count[begin:end])
            start, own = low[who] - words.place[word], text[who]
            stop = start + words.length[word]
            fits = (start >= part.borders[own]) & (stop <= part.borders[own + 1])
            own, word, start, stop = own[fits], word[fits], start[fits], stop[fits]
            same = part.stretch(start, stop) == words.hashes[word]
            own, word, start = own[same], word[same], start[same]
            _, once = np.unique(own * len(words.length) + word, return_index=True)
            found.append((own[once], word[once], start[once]))
            begin = end
    text, word, start = (np.concatenate(c) for c in zip(*found))
    _, once = np.unique(text * len(words.length) + word, return_index=True)
    text, word, start = text[once], word[once], start[once]
    whole = part.data.tobytes()
    sure = np.empty(len(text), bool)
    for i, (t, w, s) in enumerate(zip(text.tolist(), word.tolist(), start.tolist())):
        keyword = words.keywords[w].as_py().encode()
        sure[i] = whole.startswith(keyword, s) or whole.find(keyword, part.borders[t], part.borders[t + 1]) >= 0
    return text[sure], word[sure]


def matched(index: Broadcast, column: str, names: list[str], also: str | None) -> Callable[[Batches], Batches]:
    """Each row with each keyword its text contains, and with ``also`` where it has a text."""

    def run(batches: Batches) -> Batches:
        words = index.value
        for batch in batches:
            batch = batch.select(names)
            texts = batch.column(column)
            sizes = np.diff(_bytes(texts)[1])
            if also is not None:
                there = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
                yield from _rows(batch, there, pa.array([also] * len(there), pa.string()), sizes, [*names, "keyword"])
            for part in parts_of(texts):
                text, word = keywords_in(part, words)
                yield from _rows(batch, part.first + text, words.keywords.take(pa.array(word)), sizes, [*names, "keyword"])

    return run
