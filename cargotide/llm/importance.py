"""Target-distribution importance resampling over hashed n-grams (operator 12).

1. Overlapped scanning: a text becomes bytes with A-Z lower-cased and every separator run one space;
   `finditer(overlapped=True)` with boundary lookarounds then emits the span of every run of n words,
   and each span's bytes are hashed by CRC-32 into a bucket. A document's bucket counts are
   stored, so texts are scanned once.
2. The buckets of all documents and of all target texts are summed (at most `buckets` rows come to the
   driver, whatever the input); a bucket's gain is the log ratio of its smoothed shares, in thousandths.
3. A document's weight is the sum of its gains. Gumbel noise from a hash of its id is added and the
   highest scores are drawn: sampling without replacement by weight, the same in every run. Positions
   come from range partitions and prefix counts, so no task orders all documents.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from ..operators.ranking import with_positions
from .common import as_text, by_size, stored

BUCKETS = 10_000
SEED = 2024
#: Bytes of text that a task turns into counts at a time; a longer text is a run of its own.
RUN_BYTES = 8_000_000

#: A-Z to a-z; ASCII that is neither letter nor digit to a space; every byte of other characters stays.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def collapsed(text: bytes) -> bytes:
    """The words in order, one space between them."""
    return b" ".join(text.translate(_PLAIN).split())


def ngram_pattern(n: int) -> regex.Pattern:
    """Whole runs of n words in a collapsed text: a boundary on both sides, no backtracking."""
    return regex.compile(rb"(?<![^ ])[^ ]++" + rb"(?: [^ ]++)" * (n - 1) + rb"(?![^ ])")


def ngram_spans(text: bytes, pattern: regex.Pattern) -> Iterator[tuple[int, int]]:
    """Byte spans of all runs in a collapsed text, overlapping ones too."""
    for match in pattern.finditer(text, overlapped=True):
        yield match.span()


def bucket_counts(text: bytes, patterns: list[regex.Pattern], buckets: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """(words, features, distinct buckets, their counts) of one text."""
    plain = collapsed(text)
    found = [zlib.crc32(plain[a:b]) for pattern in patterns for a, b in ngram_spans(plain, pattern)]
    slots, counts = np.unique(np.array(found, np.int64) % buckets, return_counts=True)
    return plain.count(b" ") + 1 if plain else 0, len(found), slots.astype(np.int32), counts.astype(np.int32)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *parts])))


def features(docs: DataFrame, id_col: str | None, text_col: str, n: int, buckets: int) -> DataFrame:
    """Per text: doc_id, n_words, n_features, slots and counts. Null texts count as empty."""
    ident = F.lit(None) if id_col is None else F.col(f"`{id_col}`")
    rows = docs.select(ident.cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [ngram_pattern(k) for k in range(1, n + 1)]
        for batch in batches:
            for part in by_size(batch, 1, RUN_BYTES):
                got = [bucket_counts(text.as_buffer().to_pybytes(), patterns, buckets) for text in as_text(part.column(1)).cast(pa.large_binary())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()),
                     _lists([g[2] for g in got]), _lists([g[3] for g in got])], ["doc_id", "n_words", "n_features", "slots", "counts"])

    return rows.mapInArrow(scan, "doc_id long, n_words long, n_features long, slots array<int>, counts array<int>")


def bucket_totals(found: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows; one row a bucket reaches the driver."""
    each = found.select(F.explode(F.arrays_zip("slots", "counts")).alias("e"))
    totals = np.zeros(buckets, np.int64)
    for row in each.groupBy("e.slots").agg(F.sum("e.counts").alias("n")).collect():
        totals[row["slots"]] = row["n"]
    return totals


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of add-one smoothed shares, target over raw, per bucket."""
    size, s_all, t_all = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size))))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, counts = batch.column(3), batch.column(4)
            value = gain[slots.flatten().to_numpy()] * counts.flatten().to_numpy()
            ends = np.concatenate([[0], np.cumsum(slots.value_lengths().to_numpy())])
            upto = np.concatenate([[0], np.cumsum(value)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(upto[ends[1:]] - upto[ends[:-1]], pa.int64())],
                                             ["doc_id", "n_words", "n_features", "weight"])

    columns = found.select("doc_id", "n_words", "n_features", "slots", "counts")
    return columns.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def importance_report(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", *,
                      n: int = 1, buckets: int = BUCKETS, least_words: int = 20, percent: int = 10, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_features, weight, score, rank (of the drawn ones, from 1, else null).

    Of the documents with at least `least_words` words, `percent` in 100 (rounded down) are drawn: the
    highest scores, ties to the smaller id. Null and empty texts have no features and weight 0. A
    null id has the noise of an empty id and loses ties. Rows that repeat an id are documents of their
    own with the same noise; of equal scores among them the one with more features comes first. Without
    documents the result is empty; without target texts all gains follow the smoothing. Only the id
    and the text columns are read, so other columns may have any name.
    """
    found = stored(features(docs, id_col, text_col, n, buckets), "op12-features")
    wanted = features(target, None, target_text, n, buckets)
    gain = gains(bucket_totals(found, buckets), bucket_totals(wanted, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(u)))
    scored = stored(weighted(found, gain).withColumn("score", F.col("weight") + noise), "op12-scores")
    may = F.col("n_words") >= least_words
    most = scored.where(may).count() * percent // 100
    ranked = with_positions(scored.where(may), [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features")], "position")
    rank = F.when(F.col("position") < most, F.col("position") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    return (ranked.select(*columns, rank.cast("long").alias("rank"))
            .unionByName(scored.where(~may).select(*columns, F.lit(None).cast("long").alias("rank"))))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", **options) -> DataFrame:
    """The drawn documents with all their columns; rows that repeat an id are drawn together."""
    report = importance_report(docs, target, id_col, text_col, target_text, **options)
    drawn = report.where("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(drawn, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("_drawn")), "left_semi")
