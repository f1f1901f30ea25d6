"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams of one to three characters of a
language in order of frequency. A document's own list is compared with each
profile by the out-of-place distance: the sum of rank differences, where an
n-gram that the profile lacks counts as the longest distance. The nearest
profile wins, ties go to the first name. Texts are read whole, in pieces.

Defined cases: a text that is null or has no letter gets ``und`` and score 0;
without any profile every text does; null languages teach nothing; repeated
rows count as often as they stand. Other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PROFILE = 300  # n-grams of a profile and of a document
SAMPLE_DOCS = 2_000  # expected number of documents that teach a language
PIECE = 1 << 20
UNKNOWN = "und"
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the lower-cased words as integers, and their counts.

    A word stands between spaces. 21 bits hold a character, lowest first.
    """
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    table, lowered, tail = _letter_table(), (text or "").lower(), np.array([32], np.int64)
    for at in range(0, len(lowered), PIECE):
        codes = np.frombuffer(lowered[at:at + PIECE].encode("utf-32-le", "surrogatepass"), "<u4")
        chars = np.concatenate([tail, np.where(table[codes], codes, 32).astype(np.int64)])
        known = 0 if at == 0 else len(tail)
        if at + PIECE >= len(lowered):
            chars = np.append(chars, 32)
        space = chars == 32
        keep = ~space
        keep[1:] |= ~space[:-1]
        keep[0] = True
        keep[:known] = True
        chars = chars[keep]
        space = chars == 32
        one = chars[known:][~space[known:]]
        first = max(known - 1, 0)
        two = (chars[first:-1] | chars[first + 1:] << 21)[~(space[first:-1] & space[first + 1:])]
        third = max(known - 2, 0)
        three = (chars[third:-2] | chars[third + 1:-1] << 21 | chars[third + 2:] << 42)[~space[third + 1:-1]] if len(chars) > third + 2 else np.empty(0, np.int64)
        new, n = np.unique(np.concatenate([one, two, three]), return_counts=True)
        if len(keys):
            new, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
            n = np.bincount(place, np.concatenate([counts, n])).astype(np.int64)
        keys, counts, tail = new, n, chars[-2:]
    return keys, counts


def ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent keys, ties by key."""
    return keys[np.lexsort((keys, -counts))[:size]]


class Profiles:
    """Ranks of every profiled n-gram in every language."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.languages, self.size = sorted(profiles), size
        self.keys = np.unique(np.array([k for p in profiles.values() for k in p], np.int64))
        self.ranks = np.full((len(self.keys) + 1, len(self.languages)), -1, np.int64)
        for column, name in enumerate(self.languages):
            self.ranks[np.searchsorted(self.keys, np.array(profiles[name], np.int64)), column] = np.arange(len(profiles[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        keys, counts = ngram_counts(text)
        own = ranked(keys, counts, self.size)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        place = np.searchsorted(self.keys, own)
        found = place < len(self.keys)
        found[found] = self.keys[place[found]] == own[found]
        ranks = self.ranks[np.where(found, place, len(self.keys))]
        distance = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(distance.argmin())
        return self.languages[best], float(1 - distance[best] / (self.size * len(own)))


def held_out(id: Column, folds: int = 5, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language, joined over a batch before they leave the task."""
    for batch in batches:
        totals: dict[str, dict[int, int]] = {}
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            mine = totals.setdefault(name, {})
            for key, n in zip(*(a.tolist() for a in ngram_counts(text.as_py()))):
                mine[key] = mine.get(key, 0) + n
        rows = [(name, key, n) for name, mine in totals.items() for key, n in mine.items()]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                               pa.array([r[2] for r in rows], pa.int64())], names=["lang", "gram", "n"])


def learn_profiles(labelled: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", size: int = PROFILE,
                   sample_docs: int = SAMPLE_DOCS) -> Profiles:
    """Profiles from about ``sample_docs`` documents of each language, picked by a hash of the id.

    The driver receives ``size`` n-grams for each language.
    """
    rows = labelled.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    share = rows.groupBy("lang").agg((F.lit(float(sample_docs)) / F.count(F.lit(1))).alias("share")).collect()
    if not share:
        return Profiles({}, size)
    of = F.create_map(*[F.lit(x) for row in share for x in (row["lang"], min(1.0, row["share"]))])
    chance = F.pmod(F.xxhash64(F.lit("profile"), F.col("id")), F.lit(1_000_000)) / 1_000_000
    sample = rows.where(chance < F.element_at(of, F.col("lang"))).select("lang", "text")
    counts = sample.mapInArrow(_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= size).orderBy("lang", "place").collect()
    profiles: dict[str, list[int]] = {}
    for row in top:
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return Profiles(profiles, size)


def identify(docs: DataFrame, profiles: Profiles, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds nothing to the input: returns id, held_out, lang_pred, score."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(t.as_py()) for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                                   pa.array([f[1] for f in found], pa.float64())], names=[id, "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id).alias(id), held_out(F.col(id)).alias("held_out"), F.col(text).alias("text"))
    kind = rows.schema[id].dataType.simpleString()
    return rows.mapInArrow(score, f"`{id}` {kind}, held_out boolean, lang_pred string, score double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, learn_profiles(docs.where(~held_out(F.col("doc_id")))))
