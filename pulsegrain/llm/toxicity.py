"""Toxicity by a support vector machine on a subsequence string kernel.

A unit is a white-space separated word without its punctuation, or a run of
single letters joined to one. Two units are compared by their common letter
triples with gaps: a triple that spans s letters weighs DECAY to the power s,
up to SPAN letters, so an inserted or missing letter costs little. The kernel
is that product over the units' lengths in weights, a function of the number
of letters alone, which keeps it a kernel. Landmark units span the Nyström
features on which a squared-hinge support vector machine is trained. Its
decision is linear in the triples, so for scoring it folds into one table of
triple weights, and the kernel with all landmarks costs one look-up a triple.

Training sees labelled sentences through their units. Units are taken that
stand in more toxic documents, and in nearly no clean one, than chance would
give any unit. Documents with the same smallest unit hash count once, so a group
of copies does not speak for its words. Units of clean documents stand against
them, and those the machine finds most toxic are added and it is trained again. A
document's score is a logistic curve, fitted on the same sample, of its worst
unit's decision and of how much its toxic units sum up to.

Whole texts are scored. Units longer than PIECE letters are scored in pieces
that overlap by half. Defined cases: null text counts as empty, and a text
without a unit scores as if its worst unit were clean beyond doubt, 0; without
both labels in the training rows every score is 0; null labels teach nothing;
repeated rows count as often as they stand. Other columns are never looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.llm.batches import bound_batches
from pulsegrain.llm.bitmaps import bitmap, marked
from pulsegrain.llm.words import slices, text_bytes
from pulsegrain.session import written

SYMBOLS = 64
SPAN = 6
DECAY = 0.6
PIECE = 24
SAMPLE_DOCS = 3_000  # expected labelled documents of each label in training
POSITIVES = 1_000  # toxic units
NEGATIVES = 8_000  # units of clean documents
LANDMARKS = 256
ROUNDS = 3
UNITS = 1024  # units that training works on at once
CUT = 0.7
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Letters and digits by themselves, bytes beyond ASCII folded onto the rest, other signs dropped.
_SYMBOL = np.array([i - 96 if 97 <= i <= 122 else i - 64 if 65 <= i <= 90 else i - 21 if 48 <= i <= 57
                    else 37 + i % 27 if i >= 128 else 0 for i in range(256)], np.int32)
_OFFSETS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def length_norm(letters: np.ndarray) -> np.ndarray:
    """The root of the summed squared weights of all triples of a unit of so many letters."""
    total = np.zeros(len(letters))
    for _, b in _OFFSETS:
        total += np.maximum(letters - b, 0) * DECAY ** (2 * (b + 1))
    return np.sqrt(np.maximum(total, 1e-300))


def units_of(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all units in turn, the units' starts among them, each unit's text, and where its bytes start.

    ``borders`` cuts ``data`` into texts.
    """
    symbols = _SYMBOL[data]
    kept = np.flatnonzero(symbols)
    if not len(kept):
        return np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    text = np.searchsorted(borders, kept, "right") - 1
    gaps = np.cumsum(_SPACE[data])[kept]
    new = np.ones(len(kept), bool)
    new[1:] = (gaps[1:] != gaps[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    single = np.diff(np.append(starts, len(kept))) == 1
    joined = np.zeros(len(starts), bool)
    joined[1:] = single[1:] & single[:-1] & (text[starts[1:]] == text[starts[:-1]])
    starts = starts[~joined]
    return symbols[kept], starts, text[starts], kept[starts]


def _pieces(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols and starts with long units cut into overlapping pieces, and the unit of each piece."""
    lengths = np.diff(np.append(starts, len(symbols)))
    owner = np.arange(len(starts))
    if not len(lengths) or lengths.max() <= PIECE:
        return symbols, starts, owner
    half = PIECE // 2
    times = np.where(lengths > PIECE, -(-(lengths - half) // half), 1)
    owner = np.repeat(owner, times)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
    begin = starts[owner] + step * half
    size = np.where(lengths[owner] > PIECE, np.minimum(PIECE, starts[owner] + lengths[owner] - begin), lengths[owner])
    first = np.cumsum(size) - size
    return symbols[np.repeat(begin - first, size) + np.arange(size.sum())], first, owner


def triples(symbols: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pair of gaps: the first letters' places, the triples' codes and their weight."""
    n = len(symbols)
    left = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n))) - np.arange(n)
    for a, b in _OFFSETS:
        at = np.flatnonzero(left > b)
        yield at, (symbols[at] * SYMBOLS + symbols[at + a]) * SYMBOLS + symbols[at + b], DECAY ** (b + 1)


class Machine:
    """Triple weights, a bias, and the curve from a document's units to its score."""

    def __init__(self, weights: np.ndarray, bias: float, slope: tuple[float, float] = (1.0, 0.0), shift: float = 0.0):
        self.weights, self.bias, self.slope, self.shift = weights.astype(np.float32), bias, slope, shift

    def decide(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The decision on each unit."""
        cut, first, owner = _pieces(symbols, starts)
        if not len(first):
            return np.empty(0)
        n = len(cut)
        padded = np.concatenate([cut, np.zeros(SPAN, cut.dtype)])
        left = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n))) - np.arange(n)
        total = np.zeros(n, np.float32)
        high = padded[:n] * (SYMBOLS * SYMBOLS)
        for a, b in _OFFSETS:
            found = self.weights[high + padded[a:n + a] * SYMBOLS + padded[b:n + b]]
            total += np.where(left > b, found, np.float32(0)) * np.float32(DECAY ** (b + 1))
        raw = np.add.reduceat(total.astype(np.float64), first) / length_norm(np.diff(np.append(first, n))) + self.bias
        if len(owner) == len(starts):
            return raw
        return np.maximum.reduceat(raw, np.flatnonzero(np.append(True, owner[1:] != owner[:-1])))

    def score(self, found: np.ndarray) -> np.ndarray:
        """Scores from the two columns of :meth:`worst`; minus infinity stands for a text without units."""
        known = np.isfinite(found[:, 0])
        with np.errstate(over="ignore"):
            return np.where(known, 1 / (1 + np.exp(-(np.where(known[:, None], found, 0.0) @ np.array(self.slope) + self.shift))), 0.0)

    def worst(self, texts: pa.Array) -> tuple[np.ndarray, list[str | None]]:
        """For every text the worst unit's decision and the logarithm of 1 and all toxic decisions, and the worst unit."""
        values, names = np.full((len(texts), 2), (-np.inf, 0.0)), [None] * len(texts)
        data, offsets = text_bytes(texts)
        for first, last in slices(offsets):
            part = data[offsets[first]:offsets[last]]
            symbols, starts, text, at = units_of(part, offsets[first:last + 1] - offsets[first])
            decisions = self.decide(symbols, starts)
            if not len(decisions):
                continue
            heads = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
            values[first + text[heads], 0] = worst = np.maximum.reduceat(decisions, heads)
            values[first + text[heads], 1] = np.log1p(np.add.reduceat(np.maximum(decisions, 0), heads))
            top = np.repeat(worst, np.diff(np.append(heads, len(text)))) == decisions
            for unit in np.flatnonzero(top)[::-1]:
                end = starts[unit + 1] if unit + 1 < len(starts) else len(symbols)
                names[first + int(text[unit])] = _spelled(symbols[starts[unit]:end])
        return values, names


def _spelled(symbols: np.ndarray) -> str:
    """A unit as one character for each symbol, which :func:`_symbols` reads back."""
    return "".join(chr(96 + s) if s <= 26 else chr(21 + s) if s <= 36 else chr(0x100 + s) for s in symbols.tolist())


def _symbols(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    values = [[ord(c) - 96 if "a" <= c <= "z" else ord(c) - 21 if "0" <= c <= "9" else ord(c) - 0x100 for c in u] for u in units]
    lengths = np.array([len(v) for v in values])
    return np.array([s for v in values for s in v], np.int32), np.cumsum(lengths) - lengths


def kernel(left: list[str], right: list[str]) -> np.ndarray:
    """The kernel between all units of two lists."""

    def features(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        symbols, starts = _symbols(units)
        owner = np.repeat(np.arange(len(units)), np.diff(np.append(starts, len(symbols))))
        parts = [(owner[at], code, np.full(len(at), weight)) for at, code, weight in triples(symbols, starts)]
        return tuple(np.concatenate(p) for p in zip(*parts))

    (row_l, code_l, w_l), (row_r, code_r, w_r) = features(left), features(right)
    codes = np.unique(code_r)
    dense = np.zeros((len(codes) + 1, len(right)))
    np.add.at(dense, (np.searchsorted(codes, code_r), row_r), w_r)
    place = np.searchsorted(codes, code_l)
    place[place == len(codes)] = 0
    known = codes[place] == code_l if len(codes) else np.zeros(len(code_l), bool)
    out = np.zeros((len(left), len(right)))
    for at in range(0, len(code_l), 2_000):
        here = slice(at, at + 2_000)
        keep = known[here]
        np.add.at(out, row_l[here][keep], w_l[here][keep, None] * dense[place[here][keep]])
    norm = lambda units: length_norm(np.array([len(u) for u in units]))
    return out / norm(left)[:, None] / norm(right)[None, :]


def with_insertions(units: list[str], sign: str = "x") -> list[str]:
    """The units, then each with one foreign letter at every inner place: what an insult is disguised with."""
    return units + [u[:i] + sign + u[i:] for u in units if len(u) >= 4 for i in range(1, len(u))]


def train_units(positive: list[str], negative: list[str], landmarks: int = LANDMARKS, cost: float = 10.0) -> Machine:
    """The machine that tells the two lists of units apart, on Nyström features."""
    chosen = positive[: landmarks // 2]
    chosen = chosen + negative[:: max(1, len(negative) // (landmarks - len(chosen)))][: landmarks - len(chosen)]
    values, vectors = np.linalg.eigh(kernel(chosen, chosen))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    units = positive + negative
    x = np.ones((len(units), len(chosen) + 1))
    for at in range(0, len(units), UNITS):
        x[at:at + UNITS, :-1] = kernel(units[at:at + UNITS], chosen) @ root
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    weight = np.where(y > 0, len(y) / (2 * len(positive)), len(y) / (2 * len(negative))) * cost / len(y)
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w)) / len(y)
    ridge[-1, -1] = 1e-9
    for _ in range(50):
        active = y * (x @ w) < 1
        h, target = ridge.copy(), np.zeros(len(w))
        active = np.flatnonzero(active)
        for at in range(0, len(active), UNITS):
            some = active[at:at + UNITS]
            own = x[some]
            weighted = (own * weight[some, None]).T
            h += weighted @ own
            target += weighted @ y[some]
        after = np.linalg.solve(h, target)
        if np.allclose(after, w, atol=1e-9):
            break
        w = after
    beta = root @ w[:-1]
    symbols, starts = _symbols(chosen)
    owner = np.repeat(np.arange(len(chosen)), np.diff(np.append(starts, len(symbols))))
    share = beta / length_norm(np.array([len(c) for c in chosen]))
    table = np.zeros(SYMBOLS ** 3)
    for at, code, factor in triples(symbols, starts):
        np.add.at(table, code, share[owner[at]] * factor)
    return Machine(table, float(w[-1]))


def _document_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct units of three letters or more of each document, and the smallest hash among them, which copies share."""
    for batch in batches:
        rows: list[tuple] = []
        toxic = batch.column(0).to_pylist()
        data, offsets = text_bytes(batch.column(1))
        for first, last in slices(offsets):
            symbols, starts, text, _ = units_of(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
            symbols, first_of, owner = _pieces(symbols, starts)
            spelled = _spelled(symbols)
            ends = np.append(first_of[1:], len(symbols))
            units: dict[int, set[str]] = {}
            for t, a, b in zip(text[owner].tolist(), first_of.tolist(), ends.tolist()):
                if b - a >= 3:
                    units.setdefault(t, set()).add(spelled[a:b])
            for t, own in units.items():
                key = min(zlib.crc32(u.encode()) for u in own)
                rows += [(unit, key, toxic[first + t]) for unit in sorted(own)]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                               pa.array([r[2] for r in rows], pa.int32())], names=["unit", "key", "toxic"])


def more_than_chance(toxic: int, clean: int, units: int) -> int:
    """The number of toxic documents, and no clean one, that chance gives less than one of all units."""
    return math.ceil(math.log(max(units, 2)) / -math.log(max(toxic, 1) / max(toxic + clean, 2))) if clean else 1


def fit_curve(found: np.ndarray, toxic: np.ndarray, rate: float) -> tuple[tuple[float, float], float]:
    """Slopes and shift of the logistic curve where ``rate`` of the documents are toxic; a column that would count against is left out."""
    known = np.isfinite(found[:, 0])
    x, y = found[known], toxic[known].astype(float)
    weight = np.where(y > 0, rate / max(y.sum(), 1), (1 - rate) / max((1 - y).sum(), 1))
    # As in Platt's fit, the targets stay off 0 and 1, so the curve keeps a finite slope.
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    used = [0, 1]
    while True:
        z = np.column_stack([x[:, used], np.ones(len(x))])
        w = np.zeros(z.shape[1])
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            gradient = z.T @ (weight * (p - target))
            step = np.linalg.solve((z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + 1e-6 * np.eye(len(w)), gradient)
            w = w - step / max(1.0, np.abs(step).max() / 2)
            if np.abs(step).max() < 1e-8:
                break
        if len(used) == 1 or w[:-1].min() >= 0:
            slopes = dict(zip(used, w))
            return (float(slopes.get(0, 0.0)), float(slopes.get(1, 0.0))), float(w[-1])
        used = [used[1 - int(w[:-1].argmin())]]


def learn(labelled: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", sample_docs: int = SAMPLE_DOCS,
          rate: float | None = None) -> Machine:
    """The machine from about ``sample_docs`` labelled documents of each label, picked by a hash of the id.

    ``rate`` is the share of toxic documents, by default that of ``labelled``.
    The driver receives the bounded candidates and, for each document of the
    sample, its worst unit.
    """
    bound_batches(labelled.sparkSession)
    rows = labelled.select(F.col(id).alias("doc"), F.col(label).cast("int").alias("toxic"), F.col(text).alias("text"))
    rows = rows.where("toxic IN (0, 1) AND text IS NOT NULL")
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    none = Machine(np.zeros(SYMBOLS ** 3), -1.0, (0.0, 0.0), -np.inf)
    if len(counts) < 2:
        return none
    chance = F.pmod(F.xxhash64(F.lit("toxic"), F.col("doc")), F.lit(1_000_000)) / 1_000_000
    share = F.when(F.col("toxic") == 1, sample_docs / counts[1]).otherwise(sample_docs / counts[0])
    sample = written(rows.where(chance < share).select("toxic", "text"), "labelled").repartition(rows.sparkSession.sparkContext.defaultParallelism)
    seen = sample.mapInArrow(_document_units, "unit string, key long, toxic int").distinct()
    units = written(seen.groupBy("unit").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")), "units")
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    sure = more_than_chance(size.get(1, 0), size.get(0, 0), units.count())
    found = units.where((F.col("bad") >= sure) & (F.col("good") * 20 <= F.col("bad")))
    positive = [r["unit"] for r in found.orderBy(F.desc("bad"), "unit").limit(POSITIVES).select("unit").collect()]
    clean = units.where("good > 0 AND good * 20 > bad")
    half = NEGATIVES // 2
    negative = [r["unit"] for r in clean.orderBy(F.desc("good"), "unit").limit(half).unionByName(
        clean.orderBy(F.xxhash64("unit")).limit(half)).select("unit").distinct().orderBy("unit").collect()]
    if not positive or not negative:
        return none
    disguised = with_insertions(positive)
    machine = train_units(disguised, negative)
    for turn in range(ROUNDS + 1):
        worst = _worst_units(sample, machine)
        if turn == ROUNDS:
            break
        hard = sorted({r["unit"] for r in worst if r["toxic"] == 0 and r["worst"] > -1} - set(negative) - set(disguised))
        if not hard:
            break
        negative += hard
        machine = train_units(disguised, negative)
    machine.slope, machine.shift = fit_curve(np.array([(r["worst"], r["total"]) for r in worst]), np.array([r["toxic"] for r in worst]),
                                             counts[1] / (counts[0] + counts[1]) if rate is None else rate)
    return machine


def _worst_units(sample: DataFrame, machine: Machine) -> list:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, names = machine.worst(batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array(values[:, 0], pa.float64()), pa.array(values[:, 1], pa.float64()),
                                   pa.array(names, pa.string())], names=["toxic", "worst", "total", "unit"])

    return sample.select("toxic", "text").mapInArrow(run, "toxic int, worst double, total double, unit string").collect()


def held_out(id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _scores(machine: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = machine.score(machine.worst(batch.column(batch.num_columns - 1))[0])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score, pa.float64())], names=[*batch.schema.names[:-1], "score"])

    return run


def score(docs: DataFrame, machine: Machine, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, score, predicted of every row."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id), held_out(F.col(id)).alias("held_out"), F.col(text).alias("text"))
    kind = rows.schema[id].dataType.simpleString()
    scored = rows.mapInArrow(_scores(machine), f"`{id}` {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def labelled_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and toxic of the rows that may teach. The labels meet the documents by a join, of any size."""
    known = labels.select(F.col("doc_id").alias("_labelled"), "toxic").where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    return docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_labelled")).select("doc_id", "text", "toxic")


def learn_from_tables(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Machine:
    """As :func:`learn`; the ids are sampled before their texts are fetched, so few rows are shuffled."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chance = F.pmod(F.xxhash64(F.lit("label"), F.col("doc_id")), F.lit(1_000_000)) / 1_000_000
    share = F.when(F.col("toxic") == 1, 2 * sample_docs / counts.get(1, 1)).otherwise(2 * sample_docs / counts.get(0, 1))
    some = known.where(chance < share).select("doc_id", "toxic")
    near = marked(docs.select("doc_id", "text"), F.col("doc_id"), bitmap(some, F.col("doc_id"))).where("_hit").drop("_hit")
    return learn(labelled_documents(near, some), sample_docs=sample_docs, rate=counts.get(1, 0) / max(1, sum(counts.values())))


def drop_toxic(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(machine.score(machine.worst(batch.column(place))[0]) < CUT))

    place = docs.columns.index(text)
    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, learn_from_tables(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
