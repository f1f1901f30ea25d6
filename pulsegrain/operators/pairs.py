"""Counts of pairs of terms that stand in one set, as whole numbers in numpy.

Spark cuts the sets into chunks and deals the counted pairs into buckets. The
most frequent terms, the heads, stand in a matrix: a task adds up their pairs
with each other in it. All other terms send each of their partners to their
bucket, which adds up what all tasks sent and keeps the best. A head needs no
more than those of its partners that are not heads which reach what its last
partner in the matrix has; their buckets know the counts, so they go one way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

from pulsegrain.operators import chunks

# Pairs that are made at once, different pairs that a task holds before it sends them, and pairs that may come to a bucket.
PAIRS_AT_ONCE = 1 << 21
PAIRS_HELD = 1 << 22
PAIRS_IN_BUCKET = 1 << 22
# Terms in the matrix for each one of ``head``, rows of it that are one part, and splits that one task adds up in one matrix.
MATRIX_A_HEAD = 8
MATRIX_ROWS = 64
SPLITS_A_TASK = 16
# Pairs for each term of a set that are sent at once; what is on disk at a time is bounded so.
PAIRS_A_ROUND = 2

# Terms have numbers below 2^32. Multiplied by this odd number they spread over all of them, and its inverse leads back.
_SPREAD = 0x9E3779B1
_BACK = np.uint64(pow(_SPREAD, -1, 1 << 32))
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)

CODED_DDL = "_chunk long, tokens long, sets long, codes binary, sizes binary, terms array<string>, counts array<long>"
NUMBERED = pa.schema([("tokens", pa.int64()), ("sets", pa.int64()), ("pairs", pa.int64()), ("numbers", pa.binary()), ("sizes", pa.binary())])
NUMBERED_DDL = "tokens long, sets long, pairs long, numbers binary, sizes binary"
PART = pa.schema([("part", pa.int64()), ("counts", pa.binary())])
PART_DDL = "part long, counts binary"
HEADS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("rank", pa.int32())])
HEADS_DDL = "a long, b long, n long, rank int"
SENT = pa.schema([("bucket", pa.int64()), ("entries", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
SENT_DDL = "bucket long, entries long, keys binary, counts binary"
BEST = pa.schema([("bucket", pa.int64()), ("terms", pa.int64()), ("entries", pa.int64()), ("a", pa.binary()), ("sizes", pa.binary()), ("b", pa.binary()),
                  ("n", pa.binary()), ("head", pa.list_(pa.int64())), ("partner", pa.list_(pa.int64())), ("common", pa.list_(pa.int64()))])
BEST_DDL = "bucket long, terms long, entries long, a binary, sizes binary, b binary, n binary, head array<long>, partner array<long>, common array<long>"
NAMED = pa.schema([("term_a", pa.string()), ("term_b", pa.string()), ("n", pa.int64()), ("rank", pa.int32())])
NAMED_DDL = "term_a string, term_b string, n long, rank int"


def _spread(numbers: np.ndarray) -> np.ndarray:
    return numbers * np.uint64(_SPREAD) & _LOW


def _packed(values: np.ndarray) -> bytes:
    """Sorted or small numbers as compressed bytes, the first bytes of all, then the second ones."""
    return pa.compress(np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, entries: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, decompressed_size=entries * 8, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, entries).T).view(np.uint64).ravel()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, each with its counts added up."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(counts, starts)


def _blocks(numbers: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """All pairs of a set's numbers, the smaller one in the upper half, in blocks of bounded size."""
    last = np.repeat(bounds[1:], np.diff(bounds))
    after = last - np.arange(len(numbers)) - 1
    ends = np.cumsum(after)
    first = 0
    while first < len(numbers):
        done = ends[first - 1] if first else 0
        end = max(int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")), first + 1)
        own = np.repeat(np.arange(first, end), after[first:end])
        step = np.arange(len(own)) - np.repeat(ends[first:end] - after[first:end] - done, after[first:end])
        a, b = numbers[own], numbers[own + 1 + step]
        yield np.minimum(a, b) << _HALF | np.maximum(a, b)
        first = end


def _partners(numbers: np.ndarray, bounds: np.ndarray, own: np.ndarray) -> Iterator[np.ndarray]:
    """The numbers at the places ``own``, spread, each with every other number of its set in the lower half, in blocks of bounded size."""
    sets = np.searchsorted(bounds, own, "right") - 1
    others = bounds[sets + 1] - bounds[sets] - 1
    ends = np.cumsum(others)
    left = _spread(numbers[own]) << _HALF
    first = 0
    while first < len(own):
        done = ends[first - 1] if first else 0
        end = max(int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")), first + 1)
        who = np.repeat(np.arange(first, end), others[first:end])
        place = bounds[sets[who]] + np.arange(len(who)) - np.repeat(ends[first:end] - others[first:end] - done, others[first:end])
        place += place >= own[who]
        yield left[who] | numbers[place]
        first = end


def counted(numbers: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counted pairs of the sets; a pair comes more than once where there are very many."""
    yield from added_up(_blocks(numbers, bounds))


def added_up(blocks: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counted keys of the blocks, in order; a key comes more than once where there are very many."""
    keys, counts, held = [], [], 0
    for block in blocks:
        block.sort()
        starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.empty(0, np.int64)
        keys.append(block[starts])
        counts.append(np.diff(np.append(starts, len(block))))
        held += len(starts)
        if held > PAIRS_HELD:
            merged = summed(np.concatenate(keys), np.concatenate(counts))
            keys, counts, held = [merged[0]], [merged[1]], len(merged[0])
            if held > PAIRS_HELD // 2:
                yield merged
                keys, counts, held = [], [], 0
    if held:
        yield summed(np.concatenate(keys), np.concatenate(counts))


def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The term lists in chunks of CHUNK_BYTES: a chunk's terms once, and its lists as their places among them."""
    number, before, waiting = TaskContext.get().partitionId() << 32, 0, []

    def packed() -> pa.RecordBatch:
        codes, bounds, terms = chunks.coded(pa.concat_arrays(waiting))
        row = [number, len(codes), len(bounds) - 1, _packed(codes), _packed(np.diff(bounds)), terms, np.bincount(codes, minlength=len(terms))]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), pa.array(v)) for v in row[5:]]
        return pa.record_batch([*(pa.array([v], k) for v, k in zip(row, kinds)), *lists], names=["_chunk", "tokens", "sets", "codes", "sizes", "terms", "counts"])

    for batch in batches:
        lists = batch.column(0)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        sizes = np.concatenate([[0], np.cumsum(pc.binary_length(lists.flatten()).to_numpy(zero_copy_only=False).astype(np.int64))])[ends]
        first = 0
        while first < len(lists):
            last = max(int(np.searchsorted(sizes, sizes[first] + chunks.CHUNK_BYTES - before, "right")) - 1, first + 1)
            waiting.append(lists.slice(first, last - first))
            before += int(sizes[last] - sizes[first])
            first = last
            if before >= chunks.CHUNK_BYTES or first < len(lists):
                yield packed()
                number, before, waiting[:] = number + 1, 0, []
    if waiting:
        yield packed()


def _is_head(numbers: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which numbers are heads, and the place of each of them among the heads."""
    if not len(heads):
        return np.zeros(len(numbers), bool), np.zeros(len(numbers), np.int64)
    place = np.minimum(np.searchsorted(heads, numbers), len(heads) - 1)
    return heads[place] == numbers, place


def numbered(heads: np.ndarray) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A chunk of lists with the numbers of its terms in place of their places, and how many pairs its terms that are no heads have."""

    def number(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return NUMBERED.empty_table()
        tokens, sets, codes, sizes = (left.column(c)[0].as_py() for c in ("tokens", "sets", "codes", "sizes"))
        of_code = np.zeros(right.num_rows, np.uint64)
        of_code[right.column("code").to_numpy()] = right.column("no").to_numpy().astype(np.uint64)
        numbers = of_code[_unpacked(codes, tokens).astype(np.int64)]
        others = np.repeat(_unpacked(sizes, sets).astype(np.int64), _unpacked(sizes, sets).astype(np.int64)) - 1
        pairs = int(others[~_is_head(numbers, heads)[0]].sum())
        return pa.table([pa.array([v], f.type) for v, f in zip((tokens, sets, pairs, _packed(numbers), sizes), NUMBERED)], schema=NUMBERED)

    return number


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The numbers of each chunk and the borders of its sets."""
    for batch in batches:
        for i in range(batch.num_rows):
            tokens, sets, numbers, sizes = (batch.column(c)[i].as_py() for c in ("tokens", "sets", "numbers", "sizes"))
            yield _unpacked(numbers, tokens), np.concatenate([[0], np.cumsum(_unpacked(sizes, sets).astype(np.int64))])


def head_counts(heads: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """How many sets of a task every two heads share: a matrix in parts of MATRIX_ROWS rows."""
    size = len(heads)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), np.uint32)
        for numbers, bounds in _sets(batches):
            some, place = _is_head(numbers, heads)
            inner = np.concatenate([[0], np.cumsum(some)])[bounds]
            for block in _blocks(place[some].astype(np.uint64), inner):
                np.add.at(total.reshape(-1), ((block >> _HALF) * np.uint64(size) + (block & _LOW)).astype(np.int64), 1)
        for low in range(0, size, MATRIX_ROWS):
            rows = total[low:low + MATRIX_ROWS] + total[:, low:low + MATRIX_ROWS].T
            if rows.any():
                yield pa.record_batch([pa.array([low // MATRIX_ROWS], pa.int64()), pa.array([_packed(rows.ravel())], pa.binary())], schema=PART)

    return add


def best_of_heads(n: int, heads: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    """The ``n`` heads that share most sets with each head of a part, ties by number."""

    def best(table: pa.Table) -> pa.Table:
        low = table.column("part")[0].as_py() * MATRIX_ROWS
        rows = min(MATRIX_ROWS, len(heads) - low)
        total = np.zeros(rows * len(heads), np.uint64)
        for counts in table.column("counts"):
            total += _unpacked(counts.as_py(), len(total))
        total = total.reshape(rows, -1).astype(np.int64)
        order = np.argsort(-total, axis=1, kind="stable")[:, :n]
        found = np.take_along_axis(total, order, axis=1)
        at, rank = np.nonzero(found)
        return pa.table([heads[low + at].astype(np.int64), heads[order[at, rank]].astype(np.int64), found[at, rank], (rank + 1).astype(np.int32)], schema=HEADS)

    return best


def sent(buckets: int, low: int, high: int, heads: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The counted partners of the terms that are no heads and whose bucket is ``low`` or more and below ``high``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for numbers, bounds in _sets(batches):
            bucket = _spread(numbers) * np.uint64(buckets) >> _HALF
            yield from _partners(numbers, bounds, np.flatnonzero((bucket >= low) & (bucket < high) & ~_is_head(numbers, heads)[0]))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in added_up(blocks(batches)):
            bucket = (keys >> _HALF) * np.uint64(buckets) >> _HALF
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist()
            rows = [(int(bucket[s]), e - s, _packed(np.diff(keys[s:e], prepend=keys[:1] * 0)), _packed(counts[s:e])) for s, e in zip(starts, [*starts[1:], len(keys)])]
            yield pa.record_batch([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SENT)], schema=SENT)

    return send


def best_of_bucket(n: int, heads: np.ndarray, least: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    """The ``n`` partners of each term of a bucket with the highest counts, ties by number, and where a head's count with one of the terms is its ``least`` or more."""

    def best(table: pa.Table) -> pa.Table:
        entries = table.column("entries").to_pylist()
        keys = np.concatenate([np.cumsum(_unpacked(k.as_py(), e)) for k, e in zip(table.column("keys"), entries)])
        counts = np.concatenate([_unpacked(c.as_py(), e) for c, e in zip(table.column("counts"), entries)]).astype(np.int64)
        keys, counts = summed(keys, counts)
        some, place = _is_head(keys & _LOW, heads)
        some = np.flatnonzero(some)
        some = some[counts[some] >= least[place[some]]]
        spread = keys >> _HALF
        # Keys are in order, so ties keep the order of the second number.
        order = np.lexsort((-counts, spread))
        starts = np.flatnonzero(np.append(True, spread[1:] != spread[:-1]))
        sizes = np.diff(np.append(starts, len(keys)))
        keep = order[np.arange(len(keys)) - np.repeat(starts, sizes) < n]
        row = [table.column("bucket")[0].as_py(), len(starts), len(keep), _packed(np.diff(spread[starts], prepend=spread[:1] * 0)), _packed(np.minimum(sizes, n)),
               _packed(keys[keep] & _LOW), _packed(counts[keep]), (keys[some] & _LOW).tolist(), (spread[some] * _BACK & _LOW).tolist(), counts[some].tolist()]
        return pa.table([pa.array([v], f.type) for v, f in zip(row, BEST)], schema=BEST)

    return best


def _partners_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms of a bucket, how many partners each has, and these."""
    return np.cumsum(_unpacked(row["a"], row["terms"])) * _BACK & _LOW, _unpacked(row["sizes"], row["terms"]).astype(np.int64), _unpacked(row["b"], row["entries"])


def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each number of each bucket once."""
    for batch in batches:
        for row in batch.to_pylist():
            a, _, b = _partners_of(row)
            numbers = np.unique(np.concatenate([a, b])).astype(np.int64)
            yield pa.record_batch([pa.array(np.full(len(numbers), row["bucket"])), pa.array(numbers)], names=["bucket", "no"])


def named(left: pa.Table, right: pa.Table) -> pa.Table:
    """The partners of a bucket's terms, with names for numbers."""
    if not left.num_rows or not right.num_rows:
        return NAMED.empty_table()
    row = left.to_pylist()[0]
    a, sizes, b = _partners_of(row)
    numbers = right.column("no").to_numpy().astype(np.uint64)
    order = np.argsort(numbers)
    place = [pa.array(order[np.searchsorted(numbers[order], of)]) for of in (np.repeat(a, sizes), b)]
    names = chunks.whole(right.column("term"))
    rank = np.arange(len(b)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
    return pa.table([*(names.take(p) for p in place), _unpacked(row["n"], row["entries"]).astype(np.int64), rank.astype(np.int32)], schema=NAMED)
