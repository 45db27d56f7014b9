"""Shared helpers of the training-data operators: scratch tables, whole rows, words in Arrow."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage

#: Largest table that is broadcast, in rows; beyond it Spark chooses the join.
BROADCAST_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder."""
    return cut_lineage(df, label)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint only for a stored table that has at most `limit` rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def lowest_of(rows: DataFrame, key: str, value: str, name: str, salts: int = 32) -> DataFrame:
    """Adds the smallest `value` of each `key`. Both sides meet by (key, salt of the value), so the
    rows of one key are spread over `salts` groups; a key has a row for each salt it has itself."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(value), F.lit(salts)))
    least = (salted.groupBy(key).agg(F.min(value).alias(name), F.collect_set("salt").alias("own"))
             .select(key, name, F.explode("own").alias("salt")))
    return salted.join(least, [key, "salt"]).drop("salt")


def packed(df: DataFrame, *columns: Column) -> DataFrame:
    """The whole row as one column `row` beside the given ones, so that no extra column of the
    input can clash with a name the operator uses."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *columns)


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else (the built-in `lower` also folds other letters)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def as_text(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array of 64-bit offsets that start at 0 (kernels misread slices), nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    whole = column.take(pa.array(np.arange(len(column)))) if column.offset else column
    return pc.fill_null(whole.cast(pa.large_string()), "")


def by_size(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `most` bytes of text each; one longer text is a run of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(size) // most
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else []
    for a, b in zip(first, [*first[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def words(text: pa.Array, lower: bool = True) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words `[^\\x20\\x09-\\x0D]+` of the texts in order, dictionary-encoded, and the
    positions where each text starts (one more than texts)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    flat, offsets = lists.values, lists.offsets.to_numpy()
    flat, offsets = flat.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # empty at the ends of a text
    before = np.concatenate([[0], np.cumsum(full)])
    return flat.filter(pa.array(full)).dictionary_encode(), before[offsets]


def word_hashes(encoded: pa.DictionaryArray) -> np.ndarray:
    """64-bit hash of each word, equal in every process."""
    if len(encoded) == 0:
        return np.zeros(0, np.uint64)
    own = pd.util.hash_array(encoded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    return own[encoded.indices.to_numpy()]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer: spreads 64-bit values so that each bit depends on all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the k-word shingles of each text, in order, and the starts of the texts
    among them. A text of 1 to k - 1 words has its whole sequence as one shingle; an empty one none."""
    n = len(hashes)
    length = np.diff(starts)
    count = np.where(length >= k, length - k + 1, np.minimum(length, 1))
    out_starts = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(starts[:-1] - out_starts[:-1], count) + np.arange(out_starts[-1])
    size = np.repeat(np.minimum(length, k), count)
    value = np.zeros(len(first), np.uint64)
    for j in range(k):
        at = np.minimum(first + j, max(n - 1, 0))
        word = hashes[at] if n else hashes
        value = np.where(j < size, mixed(value * np.uint64(0x9E3779B97F4A7C15) + word), value)
    return value, out_starts
