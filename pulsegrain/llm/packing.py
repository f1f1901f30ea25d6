"""Sum-of-squares online packing of tokenised documents.

A document's tokens are cut at multiples of the window. Whole windows stand
alone. Each remainder goes, as it comes, to the fill level that makes the sum
of squared counts of partly filled windows smallest; a level array holds the
counts. Every task packs its own split in one pass, with no shuffle. When the
split ends, the windows still open are poured together and cut at the window,
so a task leaves one padded window at most.

Defined cases: null text counts as empty, and an empty text is the end token
alone; equal rows are packed as often as they stand; ids may be null; an empty
table gives no pieces. Sequence ids hold the task's number, so they are unique.
Other columns are never looked at.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.llm.batches import bound_batches

WINDOW = 2048
END_ID = 1
CACHE_WORDS = 250_000  # a task's memory for known words; when full it starts anew
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_TWO_SPACES = re.compile(r"\s\s")
_tokenizers: dict[str, Callable[[str], bytes]] = {}


def token_bytes(path: str) -> Callable[[str], bytes]:
    """Text to its ids as little-endian 32-bit bytes, for a file of byte-pair ranks.

    No byte pair spans the border before a lone space, so the words between
    lone spaces are encoded apart and remembered. Texts with longer runs of
    white space are encoded whole.
    """
    if path not in _tokenizers:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        encoder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        known: dict[str, bytes] = {}

        def encode(text: str) -> bytes:
            if _TWO_SPACES.search(text):
                return np.asarray(encoder.encode_ordinary(text), dtype="<u4").tobytes()
            first, *words = text.split(" ")
            missing = [w for w in set(words) if w not in known]
            if len(known) + len(missing) > CACHE_WORDS:
                known.clear()
                missing = list(set(words))
            for w in missing:
                known[w] = np.array(encoder.encode_ordinary(" " + w), dtype="<u4").tobytes()
            return np.array(encoder.encode_ordinary(first), dtype="<u4").tobytes() + b"".join([known[w] for w in words])

        _tokenizers[path] = encode
    return _tokenizers[path]


class Packer:
    """Places pieces into windows of ``size`` and keeps the windows still open by fill level."""

    def __init__(self, size: int):
        self.size = size
        self.leave = np.full(size + 1, np.iinfo(np.int64).max // 4)  # change when a window leaves its level
        self.leave[0] = 0
        self.enter = np.ones(size + 1, dtype=np.int64)  # change when a window enters a level
        self.enter[size] = 0
        self.open: dict[int, list[list]] = {}

    def _count(self, level: int, change: int) -> None:
        n = (int(self.enter[level]) - 1) // 2 + change
        self.enter[level] = 2 * n + 1
        self.leave[level] = 1 - 2 * n if n else np.iinfo(np.int64).max // 4

    def place(self, length: int, piece: object) -> list | None:
        """Puts a piece shorter than the window; returns the window when it is full. Ties go to the fullest level."""
        cost = self.leave[: self.size - length + 1] + self.enter[length:]
        level = len(cost) - 1 - int(cost[::-1].argmin())
        window = []
        if level:
            window = self.open[level].pop()
            self._count(level, -1)
        window.append(piece)
        if level + length == self.size:
            return window
        self.open.setdefault(level + length, []).append(window)
        self._count(level + length, 1)
        return None

    def rest(self) -> Iterator[object]:
        """The pieces of windows still open, fullest window first."""
        for level in sorted(self.open, reverse=True):
            for window in self.open[level]:
                yield from window


def _pack_split(path: str, size: int, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = token_bytes(path), Packer(size)
        end = np.array([end_id], dtype="<u4").tobytes()
        sequence, out = TaskContext.get().partitionId() << 40, []

        def emit(window: list) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, total in window:
                n = len(ids) // 4
                out.append((doc, start, n, zlib.crc32(ids), total, sequence, offset))
                offset += n
            sequence += 1

        def ready() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * 7
            out.clear()
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in SCHEMA.split(", ")])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, size):
                    part = ids[4 * start: 4 * (start + size)]
                    full = [(doc, start, part, total)] if len(part) == 4 * size else packer.place(len(part) // 4, (doc, start, part, total))
                    if full:
                        emit(full)
            yield ready()
        window, free = [], size
        for doc, start, ids, total in packer.rest():
            while ids:
                part = ids[: 4 * free]
                window.append((doc, start, part, total))
                start, free, ids = start + len(part) // 4, free - len(part) // 4, ids[4 * free:]
                if not free:
                    emit(window)
                    window, free = [], size
        if window:
            emit(window)
        yield ready()

    return pack


def pack(docs: DataFrame, ranks: str, size: int = WINDOW, end_id: int = END_ID, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece. ``ranks`` is the path of a vocabulary file that every executor has."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_pack_split(ranks, size, end_id), SCHEMA)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_ranks())
