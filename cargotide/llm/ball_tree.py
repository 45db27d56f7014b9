"""Exact ranked lexical search with sparse ball trees (operator 11).

A document is the sparse vector of its term impacts, an item that of its terms' weights (64-bit integers), so
a score is an inner product.

1. One scan turns every text into its number of terms and its counts of the items' terms (other
   terms add 0 to every score); these vectors are stored.
2. Statistics over all documents: their number, their length, and the document frequency of each item term.
3. Each task reads its vectors in shards of bounded size and builds a ball tree over a shard: a node has an
   integer centroid c and a radius r that is rounded up, so q.x <= q.c + |q| r holds for all x below it;
   q counts with those of its terms only that occur below the node, since x and c are 0 in all others.
   Nodes are taken best-first; once the best open bound is below the k-th score so far the rest of the
   tree is pruned. Leaves are scored exactly in integers. The k-th scores carry over to the task's next shards.
4. A salted and then a plain window keep the k best of each item.

Items come in blocks of bounded text, so what the driver and the tasks hold does not grow with their number.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import as_text, by_size, stored

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LEAF = 16
#: Bounds of a shard that a task holds: documents and entries of their vectors.
SHARD_DOCS, SHARD_ENTRIES = 16_384, 2_000_000
#: Characters of items per block, and of documents that a task takes apart at a time.
BLOCK_CHARS, RUN_BYTES = 4_000_000, 8_000_000
SALTS = 64


def terms(text: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of the texts in order, dictionary-encoded, and the text each one is from."""
    lists = pc.split_pattern_regex(pc.ascii_lower(text), pattern=SEPARATORS)
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    full = pc.not_equal(flat, "")
    return flat.filter(full).dictionary_encode(), owner[full.to_numpy(zero_copy_only=False)]


class Items:
    """A block of items over its own vocabulary: the terms of item i are `terms[starts[i]:starts[i + 1]]`."""

    def __init__(self, texts: list[str | None]):
        encoded, owner = terms(as_text(pa.array(texts, pa.string())))
        self.vocabulary = encoded.dictionary
        size = max(len(self.vocabulary), 1)
        each = np.unique(owner * size + encoded.indices.to_numpy())
        self.terms = (each % size).astype(np.int64)
        self.starts = np.searchsorted(each // size, np.arange(len(texts) + 1))

    def __len__(self) -> int:
        return len(self.starts) - 1

    def vector(self, item: int, weight: np.ndarray) -> np.ndarray:
        dense = np.zeros(len(weight), np.int64)
        mine = self.terms[self.starts[item]:self.starts[item + 1]]
        dense[mine] = weight[mine]
        return dense

    def sums(self, dense: np.ndarray) -> np.ndarray:
        """Inner product of each item with a dense vector."""
        upto = np.concatenate([[0], np.cumsum(dense[self.terms])])
        return upto[self.starts[1:]] - upto[self.starts[:-1]]


def term_counts(docs: DataFrame, id_col: str, text_col: str, vocabulary: pa.Array) -> DataFrame:
    """Per document: doc_id, n (all its terms), and its counts of the vocabulary's terms."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 1, RUN_BYTES):
                encoded, owner = terms(as_text(part.column(1)))
                at = pc.fill_null(pc.index_in(encoded.dictionary, value_set=vocabulary), -1).to_numpy()[encoded.indices.to_numpy()]
                known = at >= 0
                size = max(len(vocabulary), 1)
                cell, tf = np.unique(owner[known] * size + at[known], return_counts=True)
                ends = pa.array(np.searchsorted(cell // size, np.arange(part.num_rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.bincount(owner, minlength=part.num_rows), pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(cell % size, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32()))],
                    ["doc_id", "n", "terms", "tf"])

    return rows.mapInArrow(scan, "doc_id long, n long, terms array<int>, tf array<int>")


def term_weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def length_factor(n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """100 - 50 + (50 n N) div L of each document; Python's integers, since the product may pass 64 bits."""
    distinct, at = np.unique(n, return_inverse=True)
    return np.array([100 - 50 + 50 * int(x) * docs // length for x in distinct], np.int64)[at]


class Vectors:
    """Sparse rows: entries of row i are `at[starts[i]:starts[i + 1]]` with their values."""

    def __init__(self, starts: np.ndarray, at: np.ndarray, value: np.ndarray):
        self.starts, self.at, self.value = starts, at, value

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> Vectors:
        count = self.starts[rows + 1] - self.starts[rows]
        ends = np.concatenate([[0], np.cumsum(count)])
        cells = np.repeat(self.starts[rows] - ends[:-1], count) + np.arange(ends[-1])
        return Vectors(ends, self.at[cells], self.value[cells])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        upto = np.concatenate([np.zeros(1, dense.dtype), np.cumsum(self.value * dense[self.at])])
        return upto[self.starts[1:]] - upto[self.starts[:-1]]

    def row(self, k: int, size: int) -> np.ndarray:
        dense = np.zeros(size)
        dense[self.at[self.starts[k]:self.starts[k + 1]]] = self.value[self.starts[k]:self.starts[k + 1]]
        return dense

    def norm2(self) -> np.ndarray:
        square = self.value.astype(float) ** 2
        owner = np.repeat(np.arange(len(self)), np.diff(self.starts))
        return np.bincount(owner, square, len(self))

    def far2(self, dense: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Squared distances to a dense vector, in doubles; `own` are the rows' squared norms. Sums by
        row, not prefix sums, so a row's error stays relative to the row."""
        owner = np.repeat(np.arange(len(self)), np.diff(self.starts))
        return own + float(dense @ dense) - 2 * np.bincount(owner, self.value * dense[self.at], len(self))


def rounded_up(far2: float, own2: float, centre2: float) -> float:
    """A radius that no rounding of the squared distance makes too small: the error of its terms is
    below 1e-12 of them."""
    return math.sqrt(max(far2, 0.0) + 1e-12 * (own2 + centre2)) * (1 + 1e-12)


class BallTree:
    """Ball tree of one shard, with the bound of every node for every item of the block."""

    def __init__(self, vectors: Vectors, items: Items, weight: np.ndarray):
        size, weight2 = len(weight), weight.astype(float) ** 2
        self.children: list[tuple[int, int] | None] = []
        self.leaves: dict[int, tuple[np.ndarray, Vectors]] = {}
        bounds = []
        todo = [(np.arange(len(vectors)), vectors, -1, 0)]
        while todo:
            rows, here, parent, side = todo.pop()
            node = len(self.children)
            self.children.append(None)
            if parent >= 0:
                pair = list(self.children[parent] or (0, 0))
                pair[side] = node
                self.children[parent] = tuple(pair)
            own = here.norm2()
            centre = np.floor(np.bincount(here.at, here.value, size) / len(here))
            far2 = here.far2(centre, own)
            radius = rounded_up(float(far2.max()), float(own.max()), float(centre @ centre))
            below = np.zeros(size)
            below[here.at] = weight2[here.at]
            reach = np.ceil(np.sqrt(items.sums(below) * (1 + 1e-9)) * radius).astype(np.int64)
            bound = items.sums(centre.astype(np.int64) * weight) + reach
            bounds.append(bound if parent < 0 else np.minimum(bound, bounds[parent]))
            if len(rows) <= LEAF or radius == 0:
                self.leaves[node] = rows, here
                continue
            a = here.far2(here.row(int(far2.argmax()), size), own)
            b = here.far2(here.row(int(a.argmax()), size), own)
            right = a > b
            if min(right.sum(), (~right).sum()) * 16 < len(rows):  # keeps the tree shallow, also among equal vectors
                right = np.zeros(len(rows), bool)
                right[np.argsort(a - b, kind="stable")[len(rows) // 2:]] = True
            for side, part in ((0, ~right), (1, right)):
                kept = np.flatnonzero(part)
                todo.append((rows[kept], here.take(kept), node, side))
        self.bounds = np.array(bounds)

    def search(self, item: int, wanted: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best (scores, ids) of `best` and this tree, and the number of rows scored."""
        scores, who = best
        bound = self.bounds[:, item]
        heap, scored = [(-int(bound[0]), 0)], 0
        while heap:
            top, node = heapq.heappop(heap)
            if top == 0 or (len(scores) == k and -top < scores[-1]):
                break  # a bound equal to the k-th score may still hold a smaller id
            if node in self.leaves:
                rows, vectors = self.leaves[node]
                score = vectors.dot(wanted)
                scored += len(rows)
                good = score > 0 if len(scores) < k else score >= scores[-1]
                if good.any():
                    scores, who = np.concatenate([scores, score[good]]), np.concatenate([who, ids[rows[good]]])
                    order = np.lexsort((who, -scores))[:k]
                    scores, who = scores[order], who[order]
            else:
                for child in self.children[node]:
                    heapq.heappush(heap, (-int(bound[child]), child))
        return scores, who, scored


def _ranked(vectors: DataFrame, items: Items, weight: np.ndarray, docs: int, length: int, k: int) -> DataFrame:
    """(item, doc_id, score): each task's k best per item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(len(items))]
        ids, counts, at, value = [], [], [], []

        def search() -> None:
            if not ids:
                return
            vectors = Vectors(np.concatenate([[0], np.cumsum(np.concatenate(counts))]), np.concatenate(at), np.concatenate(value))
            who = np.concatenate(ids)
            tree = BallTree(vectors, items, weight)
            for i in range(len(items)):
                best[i] = tree.search(i, items.vector(i, weight), k, best[i], who)[:2]
            for kept in (ids, counts, at, value):
                kept.clear()

        for batch in batches:
            n, lists = batch.column(1).to_numpy(), batch.column(2)
            count = lists.value_lengths().to_numpy()
            term, tf = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy().astype(np.int64)
            m = np.repeat(length_factor(n, docs, length), count)
            impact = 1_000_000_000 * tf // (1000 * tf + 20 * m)
            ends = np.concatenate([[0], np.cumsum(count)])
            first = 0
            while first < len(n):
                room_docs = SHARD_DOCS - sum(map(len, ids))
                room = SHARD_ENTRIES - sum(map(len, at))
                last = min(first + room_docs, int(np.searchsorted(ends, ends[first] + room, "right")) - 1)
                if last <= first and ids:
                    search()
                    continue
                last = max(last, first + 1)  # a document above the bound is a shard of its own
                ids.append(batch.column(0).to_numpy()[first:last])
                counts.append(count[first:last])
                at.append(term[ends[first]:ends[last]])
                value.append(impact[ends[first]:ends[last]])
                first = last
        search()
        if not best:
            return
        rows = [np.full(len(s), i) for i, (s, _) in enumerate(best)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows), pa.int32()), pa.array(np.concatenate([w for _, w in best]), pa.int64()),
                                          pa.array(np.concatenate([s for s, _ in best]), pa.int64())], ["item", "doc_id", "score"])

    has_terms = vectors.where("size(terms) > 0 AND doc_id IS NOT NULL").select("doc_id", "n", "terms", "tf")
    return has_terms.mapInArrow(run, "item int, doc_id long, score long")


def _block(docs: DataFrame, rows: list, id_col: str, text_col: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    items = Items([r["text"] for r in rows])
    vectors = stored(term_counts(docs, id_col, text_col, items.vocabulary), "op11-vectors")
    total = vectors.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    weight = np.zeros(len(items.vocabulary), np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        weight[r["t"]] = term_weight(total["docs"], r["df"])
    found = _ranked(vectors, items, weight, total["docs"], total["length"], k)
    order = [F.desc("score"), F.asc("doc_id")]
    salted = Window.partitionBy("item", "salt").orderBy(*order)
    whole = Window.partitionBy("item").orderBy(*order)
    some = (found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).withColumn("rank", F.row_number().over(salted))
            .where(F.col("rank") <= k).select("item", "doc_id", "score"))
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id long")  # one block of items
    return (some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k).join(F.broadcast(names), "item")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", *, k: int = 50, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Each item's k best documents with a score above 0: item_id, rank (from 1), doc_id, score.

    Equal scores go to the smaller doc_id. Null and empty texts have no terms: such documents count in
    no statistic and are never found, such items find nothing. Documents with a null id count in the
    statistics and are not returned. Rows that repeat a doc_id are documents of their own; rows that repeat an
    item_id (or have a null one) are items of their own, each with its list. Without documents or items the result is
    empty. Only ids and texts are read, so other columns may have any name.
    """
    rows = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(chars / block_chars))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    parts = [_block(docs, dealt.where(F.col("block") == b).collect(), id_col, text_col, k) for b in range(blocks)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
