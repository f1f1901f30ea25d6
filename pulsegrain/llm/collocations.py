"""Phrase collocations, counted by a multikey quicksort of word-suffix pointers.

A suffix is the up to five words from a place on, to the end of its piece. All
suffixes are routed by their leading words, so one task holds all that begin
alike, and there a three-way quicksort goes down word by word: the part equal
to the pivot at depth d is a phrase of d words and its size is the count. Parts
with less than the least count are abandoned, since nothing below them can
reach it.

Leading words are counted globally before routing, first words, then pairs, and
suffixes end before the first word or pair that is too rare. The counts reach
the scan as bitmaps of fixed size, which may let a rare one through and never
hold a frequent one back, so counts stay exact. Within a slice of texts words are
64-bit hashes of their bytes and language in numpy, and only what is different
becomes a string. Tasks add up equal suffixes before the shuffle. A pair with more than its share of all places is hot: its
suffixes are dealt by the whole suffix instead, nothing below it is abandoned,
and its partial counts are added up afterwards.

Scores are whole-number divisions of decimals of 38 digits, exact for corpora
of up to 10^11 words a language; Spark SQL raises an error beyond that under
its default (ANSI) mode, it never wraps round.

Defined cases: null texts are empty, a null language counts as ``und``, an
empty table gives no rows. Repeated rows count once each. Phrases never cross a
piece border or a row. Other columns are never looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrain.llm.batches import bound_batches
from pulsegrain.llm.words import mix, run_hashes, slices, text_bytes
from pulsegrain.session import written

MOST_WORDS = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"
#: Bits of the two bitmaps, broadcast as 512 KB and 4 MB whatever the corpus.
WORD_BITS = 1 << 22
PAIR_BITS = 1 << 25
#: Bits of a pair's key that are counted, and the ranges of keys that are counted at once.
KEY_BITS = 48
PAIR_BUCKETS = 1024
#: Bytes of text that are worked on at once, one text at least.
SLICE_BYTES = 2 << 20
#: Different keys, and places of pairs, that a task adds up before it passes them on.
HELD_KEYS = 150_000
HELD_PAIRS = 4_000_000
#: Places whose suffixes a bucket holds on average, which are sorted at once.
BUCKET_PLACES = 500_000
#: A pair with more than this share of a partition's fair part of all places is hot.
HOT_SHARE = 0.25

_PIECE, _GAP = 0x0A, 0x20
_TABLE = np.array([
    _PIECE if chr(i) in ".,;:!?" or 0x0A <= i <= 0x0D else _GAP if i in (0x09, 0x20) else i + 32 if 0x41 <= i <= 0x5A else i
    for i in range(256)], np.uint8)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


class Slice:
    """The words of some texts: where each stands, its language's number, and a 64-bit key of language and word.

    ``next`` tells whether the following word stands in the same piece.
    """

    def __init__(self, data: np.ndarray, borders: np.ndarray, langs: np.ndarray, seeds: np.ndarray):
        low = _TABLE[data]
        inside = (low != _PIECE) & (low != _GAP)
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        inner = borders[1:-1]
        at, before = inner[inner < len(low)], inner[inner > 0] - 1
        opens[at] = inside[at]
        closes[before] = inside[before]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        text = np.searchsorted(borders, self.starts, "right") - 1
        piece = np.cumsum(low == _PIECE, dtype=np.int64)[self.starts]
        self.next = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
        self.lang = langs[text]
        self.keys = mix(run_hashes(low, self.starts, self.ends) ^ seeds[self.lang])
        self.bytes = low.tobytes()

    def pairs(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of two words of a piece in a row that are both ``known``, and the key of each pair."""
        at = np.flatnonzero(self.next & known[:-1] & known[1:])
        return at, mix(self.keys[at] * _STEP + self.keys[at + 1])

    def phrase(self, at: int, size: int) -> bytes:
        """The words from ``at`` on, with one space between them."""
        first, last = self.starts[at], self.ends[at + size - 1]
        if last - first == (self.ends[at:at + size] - self.starts[at:at + size]).sum() + size - 1:
            return self.bytes[first:last]
        return b" ".join(self.bytes[s:e] for s, e in zip(self.starts[at:at + size].tolist(), self.ends[at:at + size].tolist()))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Slice, list[str]]]:
    """The words of columns lang and text in slices of bounded size, with the names of the languages."""
    for batch in batches:
        coded = batch.column(0).fill_null(UNKNOWN).dictionary_encode()
        names = coded.dictionary.to_pylist()
        seeds = mix(np.array([zlib.crc32(n.encode("utf-8", "surrogatepass")) for n in names], np.uint64) * _STEP)
        langs = coded.indices.to_numpy()
        data, offsets = text_bytes(batch.column(1))
        for first, last in slices(offsets, SLICE_BYTES):
            if offsets[last] > offsets[first]:
                yield Slice(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], langs[first:last], seeds), names


class _Held:
    """Phrases added up in a task: language and phrase with their places and a key."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str, bytes], list[int]] = {}

    def add(self, name: tuple[str, bytes], places: int, key: int) -> None:
        found = self.counts.get(name)
        if found is None:
            self.counts[name] = [places, key]
        else:
            found[0] += places

    def rows(self) -> Iterator[pa.RecordBatch]:
        names = sorted(self.counts)
        for first in range(0, len(names), 20_000):
            part = names[first:first + 20_000]
            held = [self.counts[n] for n in part]
            yield pa.record_batch([
                pa.array([n[0] for n in part], pa.string()), pa.array([n[1] for n in part], pa.binary()).cast(pa.string()),
                pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64())], names=["lang", "phrase", "places", "key"])
        self.counts.clear()


_PHRASES = "lang string, phrase string, places long, key long"


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All words of the task; ``key`` is the word's."""
    held = _Held()
    for part, names in _sliced(batches):
        keys, first, places = np.unique(part.keys, return_index=True, return_counts=True)
        starts, ends, langs = (a[first].tolist() for a in (part.starts, part.ends, part.lang))
        for key, start, end, lang, n in zip(keys.view(np.int64).tolist(), starts, ends, langs, places.tolist()):
            held.add((names[lang], part.bytes[start:end]), n, key)
        if len(held.counts) > HELD_KEYS:
            yield from held.rows()
    yield from held.rows()


def _count_pairs(word_bits: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All pairs of frequent words of the task as KEY_BITS of their key: a key that two pairs share lets more through, never less.

    Keys are sent in order as steps, byte by byte and compressed, a row for each of PAIR_BUCKETS.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.unpackbits(np.frombuffer(word_bits.value, np.uint8), bitorder="little").view(bool)
        held: list[np.ndarray] = []
        size = 0

        def rows() -> pa.RecordBatch:
            keys, places = np.unique(np.concatenate([np.empty(0, np.uint64), *held]), return_counts=True)
            cuts = np.searchsorted(keys, np.arange(PAIR_BUCKETS + 1).astype(np.uint64) * np.uint64((1 << KEY_BITS) // PAIR_BUCKETS))
            some = [(b, s, e) for b, (s, e) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if e > s]
            return pa.record_batch([
                pa.array([b for b, _, _ in some], pa.int32()), pa.array([e - s for _, s, e in some], pa.int64()),
                pa.array([_packed(np.diff(keys[s:e], prepend=np.uint64(0))) for _, s, e in some], pa.binary()),
                pa.array([_packed(places[s:e].astype(np.uint64)) for _, s, e in some], pa.binary())], names=["bucket", "n", "keys", "places"])

        for part, _names in _sliced(batches):
            held.append(part.pairs(frequent[part.keys & np.uint64(WORD_BITS - 1)])[1] & np.uint64((1 << KEY_BITS) - 1))
            size += len(held[-1])
            if size > HELD_PAIRS:
                yield rows()
                held, size = [], 0
        yield rows()

    return run


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of their bytes."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, decompressed_size=n * 8, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel()


def _frequent_pairs(least: int) -> Callable[[pa.Table], pa.Table]:
    """The keys of a bucket that reach ``least`` places over all tasks."""

    def run(table: pa.Table) -> pa.Table:
        sent = list(zip(*(table.column(c).to_pylist() for c in ("n", "keys", "places"))))
        keys, entry = np.unique(np.concatenate([np.cumsum(_unpacked(k, n)) for n, k, _ in sent]), return_inverse=True)
        places = np.zeros(len(keys), np.uint64)
        np.add.at(places, entry, np.concatenate([_unpacked(p, n) for n, _, p in sent]))
        enough = places >= least
        return pa.table([pa.array(keys[enough].view(np.int64)), pa.array(places[enough].astype(np.int64))], names=["key", "places"])

    return run


def _suffixes(word_bits: Broadcast, pair_bits: Broadcast, hot: np.ndarray, buckets: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The suffixes that begin with a frequent pair, up to the first word or pair that is too rare, packed by bucket.

    A bucket holds whole leading pairs, but for the hot ones, whose suffixes are dealt by the whole suffix and marked ``partial``.
    """

    def packed(held: _Held) -> Iterator[pa.RecordBatch]:
        names = sorted(held.counts, key=lambda n: (abs(held.counts[n][1]), n))
        keys = [held.counts[n] for n in names]
        bucket = np.array([abs(k[1]) - 1 for k in keys], np.int32)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        offsets = pa.array(np.append(first, len(names)), pa.int32())
        columns = [pa.array([n[0] for n in names], pa.string()), pa.array([n[1] for n in names], pa.binary()).cast(pa.string()),
                   pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] < 0 for k in keys], pa.bool_())]
        lists = [pa.ListArray.from_arrays(offsets, c) for c in columns]
        for start in range(0, len(first), 200):
            yield pa.record_batch([pa.array(bucket[first[start:start + 200]]), *[c.slice(start, 200) for c in lists]],
                                  names=["bucket", "langs", "phrases", "places", "partial"])
        held.counts.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, pair = (np.unpackbits(np.frombuffer(b.value, np.uint8), bitorder="little").view(bool) for b in (word_bits, pair_bits))
        held = _Held()
        for part, names in _sliced(batches):
            at, lead = part.pairs(word[part.keys & np.uint64(WORD_BITS - 1)])
            lead = lead & np.uint64((1 << KEY_BITS) - 1)
            keep = pair[lead & np.uint64(PAIR_BITS - 1)]
            at, lead = at[keep], lead[keep]
            good = np.zeros(len(part.keys) + most, bool)
            good[at] = True
            size, on = np.full(len(at), 2), np.ones(len(at), bool)
            name = lead
            for step in range(1, most - 1):
                on = on & good[at + step]
                size += on
                name = np.where(on, mix(name * _STEP + part.keys[np.minimum(at + step + 1, len(part.keys) - 1)]), name)
            _, first, places = np.unique(name, return_index=True, return_counts=True)
            at, lead, size, name = at[first], lead[first], size[first], name[first]
            partial = np.isin(lead, hot)
            bucket = (mix(np.where(partial, name, lead) + _STEP) % np.uint64(buckets)).astype(np.int64) + 1
            # A partial suffix has its bucket below zero.
            bucket = np.where(partial, -bucket, bucket)
            for i, n, words, key, lang in zip(at.tolist(), places.tolist(), size.tolist(), bucket.tolist(), part.lang[at].tolist()):
                held.add((names[lang], part.phrase(i, words)), n, key)
            if len(held.counts) > HELD_KEYS:
                yield from packed(held)
        if held.counts:
            yield from packed(held)

    return run


def _bitmap(keys: DataFrame, size: int) -> Broadcast:
    """The column ``key`` of a table as a broadcast bitmap of ``size`` bits, whatever the number of keys."""
    place = F.col("key").bitwiseAND(F.lit(size - 1)) + 1
    rows = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    whole = bytearray(size // 8)
    for row in rows:
        first = (row.bucket - 1) * 4096
        whole[first:first + 4096] = row.bits[:max(0, len(whole) - first)]
    return keys.sparkSession.sparkContext.broadcast(bytes(whole))


def quicksort_counts(words: np.ndarray, places: np.ndarray, partial: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Phrases of two words or more, as (pointer of one suffix, number of words, count).

    ``words`` has a row of word numbers for each suffix, -1 after its end. Equal
    suffixes may come as several pointers with the places of each. Pointers of
    hot pairs are ``partial``: their phrases are given whatever their count.
    """
    width = words.shape[1]
    waiting = [(np.arange(len(words)), 0)]
    while waiting:
        pointers, depth = waiting.pop()
        if not len(pointers) or places[pointers].sum() < least and not partial[pointers].any():
            continue
        letter = words[pointers, depth]
        pivot = np.sort(letter[::max(1, len(letter) // 101)])
        pivot = pivot[len(pivot) // 2]
        equal = letter == pivot
        for side in (letter < pivot, letter > pivot):
            if side.any():
                waiting.append((pointers[side], depth))
        if pivot < 0:
            continue
        same = pointers[equal]
        count = int(places[same].sum())
        if count < least and not partial[same].any():
            continue
        if depth:
            yield int(same[0]), depth + 1, count
        if depth + 1 < width:
            waiting.append((same, depth + 1))


def _bucket_counts(most: int, least: int) -> Callable[[pa.Table], pa.Table]:
    """The phrases of two words or more of one bucket of suffixes."""

    def run(table: pa.Table) -> pa.Table:
        langs, suffixes, places, partial = (pa.concat_arrays([c.flatten() for c in table.column(n).chunks]) for n in ("langs", "phrases", "places", "partial"))
        langs, suffixes = langs.to_pylist(), suffixes.to_pylist()
        number: dict[tuple[str, str] | str, int] = {}
        words = np.full((len(suffixes), most), -1, np.int32)
        for i, (lang, suffix) in enumerate(zip(langs, suffixes)):
            split = suffix.split(" ")
            split[0] = (lang, split[0])  # the first word tells languages apart
            words[i, :len(split)] = [number.setdefault(w, len(number)) for w in split]
        found = list(quicksort_counts(words, places.to_numpy(), partial.to_numpy(zero_copy_only=False), least))
        return pa.table([
            pa.array([langs[p] for p, _, _ in found], pa.string()),
            pa.array([" ".join(suffixes[p].split(" ")[:d]) for p, d, _ in found], pa.string()),
            pa.array([c for _, _, c in found], pa.int64())], names=["lang", "phrase", "places"])

    return run


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "phrase").agg(F.sum("places").alias("places"))


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text", most: int = MOST_WORDS,
                  least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``most`` words that occur ``least`` times (lang, phrase, places), and the words of each lang (lang, n)."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    words = rows.mapInArrow(_count_words, _PHRASES).groupBy("lang", "phrase", "key").agg(F.sum("places").alias("places"))
    words = written(words, "words")
    frequent = words.where(F.col("places") >= least)
    word_bits = _bitmap(frequent, WORD_BITS)

    sent = rows.mapInArrow(_count_pairs(word_bits), "bucket int, n long, keys binary, places binary")
    pairs = written(sent.groupBy("bucket").applyInArrow(_frequent_pairs(least), "key long, places long"), "pairs")
    pair_bits = _bitmap(pairs, PAIR_BITS)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = pairs.agg(F.sum("places")).first()[0] or 0
    # Fewer than parts / HOT_SHARE pairs can be above this.
    hot = pairs.where(F.col("places") > HOT_SHARE * total / parts).select("key").toArrow().column("key").to_numpy()
    buckets = max(parts, -(-total // BUCKET_PLACES))

    suffixes = rows.mapInArrow(
        _suffixes(word_bits, pair_bits, hot.astype(np.int64).view(np.uint64), buckets, most),
        "bucket int, langs array<string>, phrases array<string>, places array<long>, partial array<boolean>")
    sorted_counts = suffixes.groupBy("bucket").applyInArrow(_bucket_counts(most, least), "lang string, phrase string, places long")
    counted = _summed(sorted_counts).where(F.col("places") >= least)
    n = words.groupBy("lang").agg(F.sum("places").alias("n"))
    return written(frequent.drop("key").unionByName(counted), "phrases"), n


def scored(counts: DataFrame, n: DataFrame) -> DataFrame:
    """Every phrase of two words or more with its lowest-scoring cut: lang, phrase, a, l, r, n, score."""
    size = F.size(F.split("phrase", " "))
    candidates = counts.withColumn("size", size).where("size > 1")
    cuts = candidates.select(
        "lang", "phrase", F.col("places").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "size")
    split = cuts.select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("_left"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("_right"))
    left = counts.select("lang", F.col("phrase").alias("_left"), F.col("places").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("_right"), F.col("places").alias("r"))
    known = split.join(left, ["lang", "_left"]).join(right, ["lang", "_right"]).join(F.broadcast(n), "lang")
    score = F.expr("cast(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)) as decimal(38,0))"
                   " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    lowest = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r"))
    best = known.groupBy("lang", "phrase", "a", "n").agg(lowest.alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def without_parts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows whose words lie in no longer phrase that occurs as often.

    A phrase one word longer is enough to look at: what lies between a phrase
    and a longer one that is as frequent is as frequent too.
    """
    longer = counts.withColumn("size", F.size(F.split("phrase", " "))).where("size > 2")
    inner = longer.select("lang", "places", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))).alias("phrase"))
    held = inner.groupBy("lang", "phrase").agg(F.max("places").alias("_held"))
    return rows.join(held, ["lang", "phrase"], "left").where("_held is null or _held < a").drop("_held")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", most: int = MOST_WORDS,
                 least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    counts, n = phrase_counts(docs, lang, text, most, least)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = without_parts(scored(counts, n), counts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM documents),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece WHERE len(w) > 0),
n AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
f AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS f
  FROM places, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
cut AS (
  SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, n.n, j,
         (1000::HUGEINT * c.f * n.n) // (l.f::HUGEINT * r.f) AS score
  FROM f c JOIN (SELECT unnest(range(1, 5)) AS j) ON j < c.k
  JOIN f l ON l.lang = c.lang AND l.k = j AND l.phrase = array_to_string(string_split(c.phrase, ' ')[:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.k = c.k - j AND r.phrase = array_to_string(string_split(c.phrase, ' ')[j + 1:], ' ')
  JOIN n ON n.lang = c.lang
  WHERE c.k > 1),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
part AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[s:s + m - 1], ' ') AS phrase, max(f) AS f
  FROM f, (SELECT unnest(range(1, 5)) AS s), (SELECT unnest(range(2, 5)) AS m)
  WHERE m < k AND s + m - 1 <= k GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank,
       b.phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM best b LEFT JOIN part p ON p.lang = b.lang AND p.phrase = b.phrase
WHERE p.f IS NULL OR 100 * p.f < 100 * a
QUALIFY rank <= 2000"""
