"""Words of many texts at once, as hashes in numpy.

A word is a run of ASCII letters and digits and of all characters beyond ASCII,
after lower-casing A-Z. A batch of texts is worked on as one array of bytes, in
slices of bounded size, so no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SHINGLE = np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.array([i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 0 for i in range(256)], np.uint8)
_powers: dict[str, np.ndarray] = {}


@dataclass
class Words:
    """Texts ``first`` to ``first + len(bounds) - 2`` of a batch; text i has hashes[bounds[i]:bounds[i + 1]]."""

    first: int
    hashes: np.ndarray
    bounds: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("base", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("base", _BASE), ("inverse", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["base"], _powers["inverse"]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the border of each text; null has none."""
    values = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(values):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset: values.offset + len(values) + 1]
    data = values.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), offsets


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes, one text at least."""
    first = 0
    while first < len(offsets) - 1:
        last = max(int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1, first + 1)
        yield first, last
        first = last


def run_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each word, in parts of at most SLICE_BYTES cut between words, one word at least."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(int(np.searchsorted(ends, starts[first] + SLICE_BYTES, "right")), first + 1)
        begin = starts[first]
        part = low[begin:ends[last - 1]].astype(np.uint64) + np.uint64(1)
        base, inverse = _up_to(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * base[:len(part)], out=sums[1:])
        out[first:last] = (sums[ends[first:last] - begin] - sums[starts[first:last] - begin]) * inverse[starts[first:last] - begin]
        first = last
    return mix(out)


def batch_words(texts: pa.Array) -> Iterator[Words]:
    data, offsets = text_bytes(texts)
    for first, last in slices(offsets):
        low = _LOWER[data[offsets[first]:offsets[last]]]
        borders = offsets[first:last + 1] - offsets[first]
        inside = low != 0
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        inner = borders[1:-1]
        at = inner[inner < len(low)]
        opens[at] = inside[at]
        before = inner[inner > 0] - 1
        closes[before] = inside[before]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        yield Words(first, run_hashes(low, starts, ends), np.searchsorted(starts, borders))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words and the border of each text's runs.

    A text of fewer words, but one at least, is one shorter run.
    """
    n = np.diff(words.bounds)
    runs = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(runs)])
    padded = np.concatenate([words.hashes, np.zeros(size, np.uint64)])
    first = np.repeat(words.bounds[:-1] - bounds[:-1], runs) + np.arange(bounds[-1])
    last = np.repeat(words.bounds[1:], runs)
    value = np.zeros(len(first), np.uint64)
    for step in range(size):
        word = padded[first + step]
        if step:
            word = np.where(first + step < last, word, np.uint64(step))
        value = (value + word) * _SHINGLE
    return mix(value), bounds
