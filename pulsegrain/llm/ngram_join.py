"""Near duplicates: a Jaccard join on word n-grams by MinHash banding.

Texts are compared by their sets of runs of five words. Equal sets are one
class from the start, so copies are never paired. Each class has a MinHash
signature cut into bands, with bands and rows chosen for the target recall.
Classes that share a band's hash are linked to the smallest of them, which
gives one row per member and not per pair. What hangs together is brought into
one place with its full sets, once, and every pair that shares a band is
verified there on the full sets; a large gathering is cut into blocks, and each
pair of blocks is a task of its own. The task returns the number of links of
each class and a spanning forest, never the pairs.

Defined cases: null text counts as empty; a text without words has no n-grams,
links to nothing and is a class of its own; a text of fewer than five words has
one n-gram, all its words; repeated rows count as copies; a class takes the
smallest id of its documents that is not null. A class of sets is known by 64
bits of hash. Other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.llm.batches import bound_batches
from pulsegrain.llm.bitmaps import bitmap, marked, once_each, row_key, without_rows
from pulsegrain.llm.components import components
from pulsegrain.llm.words import batch_words, mix, shingles
from pulsegrain.session import written

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
HASHES = 128
BLOCK_ROWS = 512
BLOCK_NGRAMS = 1 << 20


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most rows, and with them the fewest bands, that find a pair at the threshold often enough."""
    for rows in range(most, 0, -1):
        for bands in range(1, most // rows + 1):
            if 1 - (1 - threshold ** rows) ** bands >= recall:
                return bands, rows
    raise ValueError("no banding within the hashes reaches the recall")


def _families(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64))
    return seeds[::2] | np.uint64(1), seeds[1::2]


def band_hashes(grams: np.ndarray, families: tuple[np.ndarray, np.ndarray], bands: int) -> np.ndarray:
    """The hash of each band of the MinHash signature of a set."""
    multiply, flip = families
    least = np.full(len(multiply), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 2048):
        np.minimum(least, ((grams[None, at:at + 2048] ^ flip[:, None]) * multiply[:, None]).min(axis=1), out=least)
    signature = least.reshape(bands, -1)
    value = np.arange(bands, dtype=np.uint64)
    for column in signature.T:
        value = mix(value + column)
    return value


def _sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The distinct n-grams of each text, sorted."""
    for words in batch_words(texts):
        grams, bounds = shingles(words, size)
        for i in range(len(bounds) - 1):
            yield np.unique(grams[bounds[i]:bounds[i + 1]])


def _node(grams: np.ndarray) -> np.ndarray:
    """The class of a set, from its n-grams in any order."""
    return mix(mix(grams).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(grams))).view(np.int64)[0]


def _sign(size: int, bands: int, rows: int):
    families = _families(bands, rows)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, counts, signed = [], [], []
            for grams in _sets(batch.column(1), size):
                counts.append(len(grams))
                nodes.append(int(_node(grams)) if len(grams) else None)
                signed.append(band_hashes(grams, families, bands).view(np.int64) if len(grams) else None)
            yield pa.record_batch([batch.column(0), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()),
                                   pa.array(signed, pa.list_(pa.int64()))], names=["id", "node", "n", "bands"])

    return sign


def _with_sets(size: int):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [g for g in _sets(batch.column(0), size)]
            whole = [g for g in sets if len(g)]
            yield pa.record_batch([pa.array([int(_node(g)) for g in whole], pa.int64()),
                                   pa.array([g.view(np.int64) for g in whole], pa.list_(pa.int64()))], names=["node", "grams"])

    return expand


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Common n-grams of the pairs of a left and a right set that ``pairs`` marks, 0 elsewhere."""
    common = np.zeros(pairs.shape, np.int64)
    wanted = np.argwhere(pairs)
    if len(wanted) <= 4 * (len(left) + len(right)):
        for i, j in wanted:
            small, large = sorted((left[i], right[j]), key=len)
            place = np.searchsorted(large, small)
            place[place == len(large)] = 0
            common[i, j] = np.count_nonzero(large[place] == small)
        return common
    rows = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    values, column = np.unique(np.concatenate(left + right), return_inverse=True)
    for at in range(0, len(values), 4096):
        here = (column >= at) & (column < at + 4096)
        dense = np.zeros((len(left) + len(right), min(4096, len(values) - at)), np.float32)
        dense[rows[here], column[here] - at] = 1
        common += np.rint(dense[:len(left)] @ dense[len(left):].T).astype(np.int64)
    return np.where(pairs, common, 0)


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def verify_block(nodes: np.ndarray, blocks: np.ndarray, sizes: np.ndarray, bands: np.ndarray, sets: list[np.ndarray],
                 left_block: int, right_block: int, threshold: float) -> tuple[list[int], list[int], list[int]]:
    """Node, the root of its tree and its links (documents) for every class with a verified pair here."""
    left = np.flatnonzero(blocks == left_block)
    right = np.flatnonzero(blocks == right_block)
    pairs = np.zeros((len(left), len(right)), bool)
    for b in range(bands.shape[1]):
        pairs |= bands[left, b][:, None] == bands[right, b][None, :]
    if left_block == right_block:
        pairs &= left[:, None] < right[None, :]
    count = np.array([len(s) for s in sets])
    common = _overlaps([sets[i] for i in left], [sets[j] for j in right], pairs)
    union = count[left][:, None] + count[right][None, :] - common
    linked = np.argwhere(pairs & (common >= threshold * union - 1e-9))
    a, b = left[linked[:, 0]], right[linked[:, 1]]
    links = np.bincount(a, sizes[b], len(nodes)) + np.bincount(b, sizes[a], len(nodes))
    parent = list(range(len(nodes)))
    for i, j in zip(a.tolist(), b.tolist()):
        one, other = _root(parent, i), _root(parent, j)
        if one != other:
            parent[other] = one
    some = np.flatnonzero(links)
    return [int(nodes[i]) for i in some], [int(nodes[_root(parent, int(i))]) for i in some], [int(links[i]) for i in some]


def _verify(threshold: float):
    """Verifies each run of rows with the same gathering and blocks; rows come sorted by them."""

    def finish(parts: list[pa.Table]) -> pa.RecordBatch:
        whole = pa.concat_tables(parts).combine_chunks()
        grams = whole.column("grams").combine_chunks() if whole.num_rows else None
        flat, at = grams.values.to_numpy(zero_copy_only=False).view(np.uint64), grams.offsets.to_numpy()
        sets = [flat[at[i]:at[i + 1]] for i in range(whole.num_rows)]
        bands = whole.column("bands").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(whole.num_rows, -1)
        key = [whole.column(c)[0].as_py() for c in ("left_block", "right_block")]
        found = verify_block(whole.column("node").to_numpy(), whole.column("block").to_numpy(), whole.column("size").to_numpy(),
                             bands, sets, *key, threshold)
        return pa.record_batch([pa.array(c, pa.int64()) for c in found], names=["node", "root", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for start, end in zip(cuts, cuts[1:]):
                key = tuple(keys[start])
                if held and key != last:
                    yield finish(held)
                    held = []
                held.append(table.slice(start, end - start))
                last = key
        if held:
            yield finish(held)

    return run


def _gathered(classes: DataFrame, block_rows: int, block_ngrams: int) -> DataFrame:
    """Classes that share a band with another, with their gathering and the pairs of blocks they take part in."""
    banded = classes.select("node", F.posexplode("bands").alias("band", "hash"))
    buckets = banded.groupBy("band", "hash").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    edges = banded.join(buckets, ["band", "hash"]).where("node <> leader").select(F.col("node").alias("u"), F.col("leader").alias("v"))
    gathering = components(edges)
    members = classes.join(gathering, "node")
    totals = members.groupBy("label").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.ceil(F.sum("n") / block_ngrams)).cast("int").alias("blocks"))
    cut = members.join(totals, "label").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = cut.select("*", other.alias("other"))
    return paired.select(
        "label", F.least("block", "other").alias("left_block"), F.greatest("block", "other").alias("right_block"),
        "node", "block", "size", "bands")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD,
                    recall: float = RECALL, hashes: int = HASHES, block_rows: int = BLOCK_ROWS, block_ngrams: int = BLOCK_NGRAMS) -> DataFrame:
    """One row per document: id, class_id, n_links.

    ``class_id`` is the smallest id of the documents that links connect,
    ``n_links`` the number of other documents at the threshold or above.
    """
    bound_batches(docs.sparkSession)
    bands, rows = choose_bands(threshold, recall, hashes)
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    signed = written(source.mapInArrow(_sign(words, bands, rows), f"id {kind}, node long, n long, bands array<long>"), "signed")
    known = signed.where("node IS NOT NULL")
    classes = written(known.groupBy("node").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("size"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
    tasks = written(_gathered(classes, block_rows, block_ngrams), "tasks")
    wanted = tasks.select("node").distinct()
    ids = classes.join(wanted, "node", "left_semi").select("first_id")
    marks = marked(source, F.col("id"), bitmap(ids, F.col("first_id")))
    sets = marks.where("_hit").select("text").mapInArrow(_with_sets(words), "node long, grams array<long>")
    once = sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("grams").alias("grams"))
    work = tasks.join(once, "node").select("label", "left_block", "right_block", "node", "block", "size", "bands", "grams")
    ordered = work.repartition("label", "left_block", "right_block").sortWithinPartitions("label", "left_block", "right_block")
    found = written(ordered.mapInArrow(_verify(threshold), "node long, root long, links long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    named = classes.select("node", "first_id", "size").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    firsts = named.groupBy("label").agg(F.min("first_id").alias("class_id"))
    per_class = named.join(firsts, "label").join(links, "node", "left").select(
        "node", "class_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return signed.select("id", "node").join(per_class, "node", "left").select(
        F.col("id").alias(id), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, with all its columns: one with the smallest id, then the smallest key of id and text.

    Null ids are the smallest. A row that repeats id and text of the row that stays goes too.
    """
    key = row_key(F.col(id), F.col(text))
    named = docs.select(F.struct(F.col(id).alias("id"), key.alias("key")).alias("id"), F.col(text).alias("text"))
    found = near_duplicates(named, "id", "text")
    left = without_rows(docs, key, found.where(~F.col("id").eqNullSafe(F.col("class_id"))).select("id.key"))
    return once_each(left, row_key(F.col(id), F.col(text)))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
