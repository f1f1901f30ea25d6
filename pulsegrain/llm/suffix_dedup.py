"""Repeated byte strings, found by sorting suffixes bucket by bucket under a difference cover.

A byte goes when a string of ``length`` bytes that covers it also starts in a
document with a smaller id. That is a question about suffixes that agree in
their first ``length`` bytes, so each suffix has a 64-bit name of those bytes;
the leading bits of the name are its bucket, and a task sorts one bucket at a
time. Most suffixes never get there:

1. Longest ties first: the name of a whole text tells exact copies. A copy of a
   text with a smaller id goes whole and takes no further part, since all of its
   strings also stand in the other text.
2. Cover sample: places of a document whose number modulo PERIOD lies in COVER.
   For any two places some step below PERIOD takes both into the sample, so if
   two suffixes agree in ``length`` bytes, then sample places inside both agree
   in ``length - PERIOD + 1`` bytes. The sample is ranked first, by the same
   bucket sort; only equality of ranks is needed, so names stand for ranks.
3. A suffix is sorted only if a sample place in its reach ties with another
   document. All other suffixes are settled by the ranks and never leave their task.

Texts are cut once into chunks of bounded size, stored in a table bucketed by
chunk, so each step meets its chunk's answers without a shuffle of text. A
chunk sends every name once, with the smallest local id, so copies, hot or not,
cost one entry per chunk; a bucket answers with one bit per entry. Nothing is
paired, collected or broadcast.

Buckets hold hashed names and not leading bytes, so they are of even size
whatever the text. Two different strings share a name with a chance of 2^-64
a pair: below 1 in 1,000 for a corpus of 10^8 sorted suffixes. Memory is some 60
bytes for each byte of a chunk, and a chunk is one document at least, so a very long
text is its task's need. ``bucket_bits`` follows the corpus.

Defined cases: a null text is empty; a null id is smaller than any other; rows
with the same id never remove each other's strings; repeated rows with one id
all stay; an empty table gives an empty result. Other columns are never looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.llm.batches import bound_batches
from pulsegrain.llm.words import mix, text_bytes
from pulsegrain.session import new_path, written

LENGTH = 50
#: A perfect difference set: every difference modulo PERIOD is one of two members.
PERIOD = 21
COVER = (3, 6, 7, 12, 14)
CHUNK_BYTES = 6 << 20
#: Bytes of text whose names one bucket holds, and the least number of bits.
BUCKET_BYTES = 64 << 20
LEAST_BITS = 8
#: Bits of a cover name that are sent beside its bucket; more ties than true ones only mean more suffixes to sort.
COVER_BITS = 32

_NULL_ID = -(1 << 63)
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("base", ())) < n:
        for name, base in (("base", _BASE), ("inverse", _INVERSE)):
            steps = np.full(max(n, CHUNK_BYTES), base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["base"], _powers["inverse"]


class Chunk:
    """The documents of a chunk as one array of bytes."""

    def __init__(self, ids: pa.Array, texts: pa.Array, length: int):
        self.length = length
        data, offsets = text_bytes(texts)
        self.data = data[offsets[0]:offsets[-1]] if len(offsets) > 1 else data[:0]
        self.bounds = offsets - offsets[0]
        self.sizes = np.diff(self.bounds)
        self.ids = ids.cast(pa.int64()).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
        self.order = np.unique(self.ids)
        self.rank = np.searchsorted(self.order, self.ids)
        base, self.inverse = _up_to(len(self.data) + 1)
        self.sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * base[:len(self.data)], out=self.sums[1:])

    def names(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[starts + lengths] - self.sums[starts]) * self.inverse[starts])

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, places, "right") - 1

    def sample(self, open_docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cover places of the open documents that have a whole window after them, and their documents."""
        window = self.length - PERIOD + 1
        counts = np.where(open_docs & (self.sizes >= self.length), np.maximum(self.sizes - window + 1, 0), 0)
        rounds = -(-counts // PERIOD)
        doc = np.repeat(np.arange(len(counts)), rounds)
        turn = np.arange(len(doc)) - np.repeat(np.cumsum(rounds) - rounds, rounds)
        place = (turn[:, None] * PERIOD + np.array(COVER)).ravel()
        doc = np.repeat(doc, len(COVER))
        fits = place < counts[doc]
        return place[fits] + self.bounds[:-1][doc[fits]], doc[fits]


class Keys:
    """Different names in order, each with the smallest rank of an id that has it."""

    def __init__(self, names: np.ndarray, ranks: np.ndarray):
        order = np.argsort(names)
        names = names[order]
        first = np.ones(len(names), bool)
        first[1:] = names[1:] != names[:-1]
        starts = np.flatnonzero(first)
        self.names = names[starts]
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(first) - 1
        least = ranks[order]
        self.least = np.minimum.reduceat(least, starts) if len(starts) else least
        self.most = np.maximum.reduceat(least, starts) if len(starts) else least
        self.ranks = ranks


def _borders(keys: Keys, bits: int) -> np.ndarray:
    """Where each bucket's entries begin; the last border is the number of entries."""
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(keys.names, edges), len(keys.names))


def _planes(values: np.ndarray, most: int) -> bytes:
    """The ``most`` low bytes of every value, byte by byte, compressed."""
    planes = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :most].T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def _unplanes(blob: bytes, count: int, most: int) -> np.ndarray:
    if not count:
        return np.empty(0, np.uint64)
    planes = np.frombuffer(pa.decompress(blob, decompressed_size=count * most, codec="zstd", asbytes=True), np.uint8)
    out = np.zeros((count, 8), np.uint8)
    out[:, :most] = planes.reshape(most, count).T
    return out.view(np.uint64).ravel()


def _deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values[:1] * 0)


_SENT = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("entries", pa.int64()), ("names", pa.binary()),
                   ("ids", pa.binary()), ("per_id", pa.binary()), ("n_ids", pa.int64())])
_ANSWER = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("bits", pa.binary())])
_SENT_DDL = "chunk long, bucket int, entries long, names binary, ids binary, per_id binary, n_ids long"
_ANSWER_DDL = "chunk long, bucket int, bits binary"


def _sent_cover(chunk: int, keys: Keys, bits: int) -> pa.Table:
    """Per bucket the sorted names, COVER_BITS of each, as compressed steps."""
    low = (keys.names >> np.uint64(64 - bits - COVER_BITS)) & np.uint64((1 << COVER_BITS) - 1)
    borders = _borders(keys, bits)
    rows = [(chunk, b, e - s, _planes(_deltas(low[s:e]), COVER_BITS // 8), b"", b"", 0)
            for b, (s, e) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist())) if e > s]
    return _table(rows, _SENT)


def _sent_suffixes(chunk: int, keys: Keys, ids: np.ndarray, bits: int) -> pa.Table:
    """Per bucket the names less their leading byte, which the bucket implies, grouped by the smallest id that has them."""
    rows = []
    borders = _borders(keys, bits)
    for b, (s, e) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist())):
        if e > s:
            order = np.argsort(keys.least[s:e], kind="stable")
            ranks, per_id = np.unique(keys.least[s:e], return_counts=True)
            rows.append((chunk, b, e - s, _planes(keys.names[s:e][order], 7),
                         _planes(_deltas(ids[ranks].view(np.uint64)), 8), _planes(per_id, 4), len(ranks)))
    return _table(rows, _SENT)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _answers(table: pa.Table, parts: list[np.ndarray]) -> pa.Table:
    return pa.table([table.column("chunk"), table.column("bucket"),
                     pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())], schema=_ANSWER)


def _cover_answers(table: pa.Table) -> pa.Table:
    """Per entry of a bucket, whether another chunk has its name too."""
    counts = table.column("entries").to_pylist()
    names = np.concatenate([np.cumsum(_unplanes(b, n, COVER_BITS // 8)) for b, n in zip(table.column("names").to_pylist(), counts)])
    _, entry, chunks = np.unique(names, return_inverse=True, return_counts=True)
    return _answers(table, np.split(chunks[entry] > 1, np.cumsum(counts)[:-1]))


def _suffix_answers(table: pa.Table) -> pa.Table:
    """Per entry of a bucket, whether a smaller id has its name."""
    counts = table.column("entries").to_pylist()
    names = np.concatenate([_unplanes(b, n, 7) for b, n in zip(table.column("names").to_pylist(), counts)])
    ids = np.concatenate([
        np.repeat(np.cumsum(_unplanes(i, n, 8)).view(np.int64), _unplanes(p, n, 4).astype(np.int64))
        for i, p, n in zip(*(table.column(c).to_pylist() for c in ("ids", "per_id", "n_ids")))])
    order = np.argsort(names)
    sorted_names = names[order]
    first = np.ones(len(names), bool)
    first[1:] = sorted_names[1:] != sorted_names[:-1]
    least = np.minimum.reduceat(ids[order], np.flatnonzero(first))
    later = np.empty(len(names), bool)
    later[order] = ids[order] > least[np.cumsum(first) - 1]
    return _answers(table, np.split(later, np.cumsum(counts)[:-1]))


def _read(keys: Keys, answers: dict[int, bytes], bits: int, by_id: bool) -> np.ndarray:
    """The answered bit of every entry, in the order of the names."""
    out = np.zeros(len(keys.names), bool)
    borders = _borders(keys, bits)
    for bucket, packed in answers.items():
        s, e = int(borders[bucket]), int(borders[bucket + 1])
        told = np.unpackbits(np.frombuffer(packed, np.uint8), count=e - s).astype(bool)
        if by_id:
            out[s + np.argsort(keys.least[s:e], kind="stable")] = told
        else:
            out[s:e] = told
    return out


class Steps:
    """What a chunk does at each step, given the answers of the steps before."""

    def __init__(self, length: int, bits: int):
        self.length, self.bits = length, bits

    def whole(self, c: Chunk) -> Keys:
        long = np.flatnonzero(c.sizes >= self.length)
        names = c.names(c.bounds[:-1][long], c.sizes[long]) ^ mix(c.sizes[long].astype(np.uint64))
        return Keys(names, c.rank[long])

    def open(self, c: Chunk, told: dict[int, bytes]) -> np.ndarray:
        """Documents that are no copy of a text with a smaller id."""
        keys = self.whole(c)
        copy = (keys.ranks > keys.least[keys.entry]) | _read(keys, told, self.bits, True)[keys.entry]
        out = np.ones(len(c.sizes), bool)
        out[np.flatnonzero(c.sizes >= self.length)[copy]] = False
        return out

    def cover(self, c: Chunk, open_docs: np.ndarray) -> tuple[Keys, np.ndarray, np.ndarray]:
        places, docs = c.sample(open_docs)
        return Keys(c.names(places, self.length - PERIOD + 1), c.rank[docs]), places, docs

    def tied(self, c: Chunk, open_docs: np.ndarray, told: dict[int, bytes]) -> tuple[Keys, np.ndarray]:
        """The suffixes that have a tied cover place in reach, and where they start."""
        keys, places, docs = self.cover(c, open_docs)
        hit = (_read(keys, told, self.bits, False) | (keys.least != keys.most))[keys.entry]
        steps = np.zeros(len(c.data) + 1, np.int32)
        begin = np.maximum(places[hit] - PERIOD + 1, c.bounds[:-1][docs[hit]])
        end = np.minimum(places[hit], c.bounds[1:][docs[hit]] - self.length)
        some = end >= begin
        np.add.at(steps, begin[some], 1)
        np.add.at(steps, end[some] + 1, -1)
        starts = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
        return Keys(c.names(starts, self.length), c.rank[c.doc_of(starts)]), starts

    def removed(self, c: Chunk, open_docs: np.ndarray, keys: Keys, starts: np.ndarray, told: dict[int, bytes]) -> np.ndarray:
        """Which bytes go."""
        later = (keys.ranks > keys.least[keys.entry]) | _read(keys, told, self.bits, True)[keys.entry]
        steps = np.zeros(len(c.data) + 1, np.int32)
        steps[starts[later]] += 1
        steps[starts[later] + self.length] -= 1
        out = np.cumsum(steps[:-1]) > 0
        for doc in np.flatnonzero(~open_docs).tolist():
            out[c.bounds[doc]:c.bounds[doc + 1]] = True
        return out


def _in_chunks(docs: DataFrame, id: str, text: str, chunk_bytes: int) -> DataFrame:
    """The documents with the number of their chunk, stored and bucketed by it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            chunks = []
            for n in batch.column(2).to_pylist():
                if size and size + n > chunk_bytes:
                    chunk, size = chunk + 1, 0
                size += n
                chunks.append(chunk)
            yield pa.record_batch([pa.array(chunks, pa.int64()), batch.column(0), batch.column(1)], names=["chunk", "id", "text"])

    spark = docs.sparkSession
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).cast("long").alias("id"), value.alias("text"), F.octet_length(value).alias("size"))
    table = f"chunks_{uuid.uuid4().hex}"
    # As many buckets as the scan has splits, so a task's share does not grow with the corpus.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    rows.mapInArrow(cut, "chunk long, id long, text string").write.bucketBy(parts, "chunk").sortBy("chunk").option(
        "path", new_path(spark, "chunks")).option("compression", "zstd").saveAsTable(table)
    return spark.table(table)


def find_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (maximal removed runs, end exclusive) and the kept bytes."""
    if length < 2 * PERIOD:
        raise ValueError(f"length must be {2 * PERIOD} or more")
    bound_batches(docs.sparkSession)
    chunks = _in_chunks(docs, id, text, chunk_bytes)
    total = chunks.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = max(LEAST_BITS, (total // BUCKET_BYTES).bit_length())
    steps = Steps(length, bits)

    def chunk_of(table: pa.Table) -> Chunk:
        table = table.combine_chunks()
        return Chunk(*(pa.concat_arrays(table.column(n).chunks) for n in ("id", "text")), length)

    def told(table: pa.Table, step: int) -> dict[int, bytes]:
        rows = zip(*(table.column(c).to_pylist() for c in ("step", "bucket", "bits")))
        return {bucket: packed for s, bucket, packed in rows if s == step}

    def send_whole(key: tuple, left: pa.Table) -> pa.Table:
        c = chunk_of(left)
        return _sent_suffixes(key[0].as_py(), steps.whole(c), c.order, bits)

    def send_cover(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        c = chunk_of(left)
        return _sent_cover(key[0].as_py(), steps.cover(c, steps.open(c, told(right, 0)))[0], bits)

    def send_suffixes(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        c = chunk_of(left)
        keys, _ = steps.tied(c, steps.open(c, told(right, 0)), told(right, 1))
        return _sent_suffixes(key[0].as_py(), keys, c.order, bits)

    def finish(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        c = chunk_of(left)
        open_docs = steps.open(c, told(right, 0))
        keys, starts = steps.tied(c, open_docs, told(right, 1))
        gone = steps.removed(c, open_docs, keys, starts, told(right, 2))
        return _result(c, gone, pa.concat_arrays(left.combine_chunks().column("id").chunks))

    def answered(sent: DataFrame, answer, step: int) -> DataFrame:
        bits_of = sent.groupBy("bucket").applyInArrow(answer, _ANSWER_DDL)
        return written(bits_of.withColumn("step", F.lit(step)), f"answers-{step}")

    def meeting(answers: DataFrame, run, ddl: str) -> DataFrame:
        return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, ddl)

    answers = answered(chunks.groupBy("chunk").applyInArrow(send_whole, _SENT_DDL), _suffix_answers, 0)
    answers = answers.unionByName(answered(meeting(answers, send_cover, _SENT_DDL), _cover_answers, 1))
    answers = answers.unionByName(answered(meeting(answers, send_suffixes, _SENT_DDL), _suffix_answers, 2))
    return meeting(answers, finish, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def _result(c: Chunk, gone: np.ndarray, ids: pa.Array) -> pa.Table:
    """Spans and kept bytes of every document of a chunk."""
    inner = c.bounds[:-1][c.sizes > 0]
    edge = np.zeros(len(gone) + 1, bool)
    edge[inner] = True
    opens = gone.copy()
    opens[1:] &= ~gone[:-1] | edge[1:-1]
    closes = gone.copy()
    closes[:-1] &= ~gone[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = c.doc_of(starts)
    first = c.bounds[:-1][doc]
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(starts, c.bounds), pa.int32()),
        pa.StructArray.from_arrays([pa.array(starts - first, pa.int64()), pa.array(ends - first, pa.int64())], names=["start", "end"]))
    kept = np.concatenate([[0], np.cumsum(~gone)])[c.bounds]
    data = c.data[~gone]
    kept_bytes = pa.Array.from_buffers(pa.binary(), len(c.sizes), [None, pa.py_buffer(kept.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
    return pa.table([ids, pa.array(c.sizes, pa.int64()), spans, kept_bytes], names=["doc_id", "n_bytes", "spans", "kept"])


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
p AS (SELECT doc_id, unnest(range(1, n - 48)) AS i FROM d),
s AS (SELECT p.doc_id, i, b[i:i + 49] AS s FROM p JOIN d USING (doc_id)),
later AS (SELECT doc_id, i FROM s QUALIFY doc_id > min(doc_id) OVER (PARTITION BY s)),
marked AS (SELECT *, coalesce(i > lag(i) OVER w + 50, true) AS opens FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
span AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS z FROM numbered GROUP BY ALL),
gap AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 1) AS after FROM span),
kept AS (
  SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS after,
         string_agg(hex(b[after:a - 1]), '' ORDER BY a) AS head
  FROM gap JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || hex(b[coalesce(after, 1):]))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""
