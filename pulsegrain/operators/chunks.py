"""Token lists in chunks of bounded size that meet their terms' numbers once per chunk, not once per token.

A join of tokens with a table of terms shuffles every token, and its frequent
terms are hot. Rows are therefore stored in chunks; a chunk asks for each of
its terms once, so a term has one row per chunk at most and none is hot, and the
chunk meets its answers by its number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain.session import written

# Bytes of tokens in a chunk; a chunk is one row at least.
CHUNK_BYTES = 8 << 20


def in_chunks(df: DataFrame, tokens: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows of ``df`` stored with the number of their chunk, ``_chunk``. Rows stay where they are, so nothing is shuffled."""
    at = df.columns.index(tokens)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, before = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(at).flatten()), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
            starts = before + np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])]
            before = int(starts[-1])
            yield batch.append_column("_chunk", pa.array(first + starts[:-1] // chunk_bytes, pa.int64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return written(df.mapInArrow(cut, f"{fields}, _chunk long"), "chunks")


def in_chunks_by_id(df: DataFrame, key: str, text: str, tokens: Column, keep: Sequence[str] = (), chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The token lists of the rows, ``_tokens``, stored with key, ``keep`` and their chunk; rows that repeat an id share a chunk.

    There are as many chunks as the texts need; the texts are shuffled once, before they are split.
    """
    size = df.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    chunk = F.pmod(F.xxhash64(key), F.lit(max(1, -(-size // chunk_bytes))))
    spread = df.select(key, *keep, text, chunk.alias("_chunk")).repartition("_chunk")
    return written(spread.select(key, *keep, tokens.alias("_tokens"), "_chunk"), "chunks")


def row_terms(chunks: DataFrame, tokens: str, by: Sequence[str] = ()) -> DataFrame:
    """Each term of each chunk, and of the values of ``by`` in it, with the rows that hold it: _chunk, by, term, n. A row holds the empty term once."""
    marked = F.concat(F.array(F.lit("")), F.coalesce(F.array_distinct(tokens), F.array().cast("array<string>")))
    return chunks.select(F.col("_chunk").alias("_chunk"), *by, F.explode(marked).alias("term")).groupBy("_chunk", *by, "term").agg(F.count(F.lit(1)).alias("n"))


def cells_of(columns: Sequence[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's combination of values, nulls being a value, and the first row of each combination."""
    numbers = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        values = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        _, numbers = np.unique(numbers * (values.max(initial=0) + 1) + values, return_inverse=True)
    _, first = np.unique(numbers, return_index=True)
    return numbers, first


def whole(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """A column of a table as one array."""
    if not isinstance(column, pa.ChunkedArray):
        return column
    values = column.combine_chunks()
    return pa.concat_arrays(values.chunks) if isinstance(values, pa.ChunkedArray) else values


def coded(tokens: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Tokens as numbers, the border of each row's tokens, and the different tokens by number."""
    lists = whole(tokens)
    values = lists.flatten().dictionary_encode()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return values.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), values.dictionary


def chunk_terms(chunks: DataFrame, tokens: str) -> DataFrame:
    """Each term of each chunk with the rows' tokens that are it: _chunk, term, n."""
    return chunks.select(F.col("_chunk").alias("_chunk"), F.explode(tokens).alias("term")).groupBy("_chunk", "term").agg(F.count(F.lit(1)).alias("n"))


def places(tokens: pa.ChunkedArray, terms: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The place of every token in ``terms``, -1 for one that is none of them, and the border of each row's tokens."""
    values = whole(tokens)
    at = pc.fill_null(pc.index_in(values.flatten(), value_set=whole(terms)), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    return at, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each row's values."""
    sums = np.concatenate([values[:1] * 0, np.cumsum(values)]) if len(values) else np.zeros(1, values.dtype)
    return sums[bounds[1:]] - sums[bounds[:-1]]
