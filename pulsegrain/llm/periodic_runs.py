"""Periodic runs of words, found by an online sparse diagonal table.

A run is a stretch of words with smallest period q, words q apart identical, of
``max(MIN_WORDS, MIN_PERIODS * q)`` words or more, that no neighbour extends.
The scan goes over the words once. A diagonal is a lag whose words have matched
so far. At each word, every active lag whose word matches grows by one and
every other one ends: if its stretch is long enough, its run is emitted there
and then. Earlier occurrences of the word start new diagonals. The table is
sparse in three ways, none of which can lose a run:

* every run has at least five matches in a row on its diagonal, so a diagonal
  starts at its fifth match, found by the last five words, and only where the
  word before them differs (else the lag is active already);
* a lag that no longer fits MIN_PERIODS times into the text never starts;
* a multiple of an active lag whose stretch holds both words never starts,
  since all of its stretch then has the smaller period.

Memory is a text's words and its active lags. Texts whose five-word runs are
all different are passed by at once, in numpy, for a whole slice of a batch.

Defined cases: null and blank texts have no words, no runs and the digest of
nothing. Rows are judged one by one, so repeated rows give repeated rows, ids
may be null or repeated, and other columns are never looked at. Words are runs
of bytes other than ASCII space and control whitespace, compared as bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.llm.batches import bound_batches

MIN_WORDS = 6
MIN_PERIODS = 4
#: Matches that every diagonal of a run has at least: 6 words at lag 1 give 5, 4 * q words at lag q >= 2 give 6 or more.
SEED = 5
_BLANK = r"[\x20\x09-\x0D]+"
SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>")
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_KINDS = [pa.int64()] * 6 + [pa.string()] * 2 + [_RUN]


def _numbered(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    number = seen.setdefault
    return np.array([number(w, len(seen)) for w in words], np.int64)


def _seed_names(word: np.ndarray) -> np.ndarray:
    """A number for the last SEED words at each position from SEED - 1; equal numbers, equal words."""
    name, size, held = word, int(word.max()) + 1, int(word.max()) + 1
    for step in range(1, SEED):
        if held > (1 << 62) // size:
            name = np.unique(name, return_inverse=True)[1]
            held = int(name.max()) + 1
        name = name[:-1] * size + word[step:]
        held *= size
    return name


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    """Start, length and period of every run, by start, then period."""
    n = len(words)
    if n < MIN_WORDS:
        return []
    word = _numbered(words)
    if len(word) < SEED + 1 or int(word.max()) == n - 1:
        return []
    names = _seed_names(word)
    order = np.sort(names)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return []
    repeated = np.isin(names, twice)
    found: list[tuple[int, int, int]] = []
    earlier: dict[int, dict[int, list[int]]] = {}
    active: dict[int, int] = {}  # lag -> first word of its stretch
    at = word.tolist()

    def grow(i: int) -> None:
        """Active lags whose word i does not match end and leave their run, if it is one."""
        now = at[i]
        for lag in [q for q in active if at[i - q] != now]:
            first = active.pop(lag)
            if i - first >= max(MIN_WORDS, MIN_PERIODS * lag):
                found.append((first, i - first, lag))

    places = np.flatnonzero(repeated) + SEED - 1
    last = -1
    for i, name in zip(places.tolist(), names[repeated].tolist()):
        while active and last < i:
            last += 1
            grow(last)
        last = i
        before = at[i - SEED] if i >= SEED else -1
        same = earlier.setdefault(name, {})
        for other, positions in same.items():
            if other == before and before >= 0:
                continue
            for j in reversed(positions):
                lag = i - j
                first = j - SEED + 1
                if first + MIN_PERIODS * lag > n:
                    break
                if not any(lag % q == 0 and s <= first for q, s in active.items()):
                    active[lag] = first
        same.setdefault(before, []).append(i)
    while active and last < n - 1:
        last += 1
        grow(last)
    found += [(first, n - first, lag) for lag, first in active.items() if n - first >= max(MIN_WORDS, MIN_PERIODS * lag)]
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    keep = np.cumsum(dropped[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def _row(id: int | None, text: str | None) -> tuple:
    words = (text or "").encode("utf-8", "surrogatepass").split()
    runs = runs_of(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
    kept = hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()
    head = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (id, len(runs), *head, listed, kept, [{"start": s, "length": length, "period": q} for s, length, q in runs])


def find_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its longest run, digests of all runs and of the collapsed text, and the runs."""
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(d, t.as_py()) for d, t in zip(batch.column(0).to_pylist(), batch.column(1))]
            yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(_KINDS)], names=names)

    bound_batches(docs.sparkSession)
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def with_planted_period(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids and texts, with a periodic tail for ids whose crc32 ends in 0: with h the crc32 of the decimal id and
    g = h div 10, words from a = g mod n repeat the p = 1 + (n - a) div (3 + g mod 8) words that start there.

    Other texts, those without words and those with a null id stay as they are.
    """
    h = F.crc32(F.col(id).cast("string"))
    words = F.when(h % 10 == 0, F.filter(F.split(F.col(text), _BLANK), lambda w: w != ""))
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.floor(h / 10).alias("_g"), words.alias("_words"))
    rows = rows.withColumn("_n", F.size("_words").cast("long")).withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    left = F.col("_n") - F.col("_a")
    rows = rows.withColumn("_p", F.floor(left / (F.col("_g") % 8 + 3)) + 1)
    a, p = F.col("_a").cast("int"), F.col("_p").cast("int")
    copies = F.flatten(F.array_repeat(F.slice("_words", a + 1, p), F.ceil(left / F.col("_p")).cast("int")))
    periodic = F.array_join(F.concat(F.slice("_words", F.lit(1), a), F.slice(copies, F.lit(1), left.cast("int"))), " ")
    return rows.select("doc_id", F.when(F.col("_n") > 0, periodic).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_runs(with_planted_period(spark.read.parquet(f"{sf_dir}/documents.parquet"))).drop("runs")
