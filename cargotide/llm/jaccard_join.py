"""Exact n-gram Jaccard join in metric space (operator 3).

A document is the set of its distinct 5-word shingles; d = 1 - Jaccard is a metric and two
documents link when d <= 0.2. Between unrelated documents d is 1, where the triangle inequality
says nothing, so cells of sampled pivots would copy nearly every document into nearly every cell.
Pivots are therefore drawn where distances are below 1:

1. Shingles have one global order, shingles that a sample shows often last. Two sets that link share
   one of the first n - ceil(0.8 n) + 1 shingles of each (their boundary shingles), so a document
   is copied to the region of each of these and to no other.
2. The pivot of a shingle's region is its smallest document. Regions with the same pivot are one
   region, so a large group of near copies is a few regions and not one for every shingle.
3. Inside a region the join goes on recursively: distances to the pivot are computed for all
   members, those within 0.2 join its component; then a member of the smallest unfinished component
   becomes the next pivot. A pivot is compared only with members of other components whose sizes and
   whose distances to the earlier pivots allow d <= 0.2 (triangle inequality). The region is done
   when all components but one have been pivots entirely: then no link between components is left.
4. Before the sets travel, a region sees only sketches: how many shingles of a set fall in each
   hash bucket. The sum of the smaller counts is no less than the intersection (the sketches'
   own Jaccard distance is a metric below the sets' distance), so a member without a partner within
   0.2 by sketches has none and leaves the region.
5. Each document is first joined in its home, the region of its smallest pivot. Its copies in other
   regions follow only where they may still link two components that homes have not compared.
6. A region beyond `region_docs` documents is dealt into blocks, and every two blocks meet in a task.

Only spanning links leave a region; equal sets are linked through their set's digest. Components
of all links are found by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_text, by_size, lowest_of, mixed, packed, shingles, small, stored, unpacked, word_hashes, words
from .components import connected_components

K = 5
#: A link needs 100 * intersection >= 80 * union.
PART, WHOLE = 80, 100
#: Shingles that go last in the global order: the most frequent ones of a sample of documents. The
#: order steers only the work; every order gives the same links.
SAMPLE_EVERY, OFTEN, MOST_FREQUENT = 32, 3, 100_000
BATCH_CHARS = 1_000_000
#: Buckets of a sketch, by the size of its set. A sketch with a count of 255 or more is never pruned.
LEAST_BUCKETS, MOST_BUCKETS = 64, 8192


class Order:
    """Places shingle hashes in the global order: 63-bit numbers, frequent shingles above all others."""

    def __init__(self, frequent: np.ndarray):
        """frequent: hashes, the rarest first."""
        self.rank = np.argsort(frequent).astype(np.uint64)
        self.sorted = np.sort(frequent)

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        key = hashes >> np.uint64(2)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
            seen = self.sorted[at] == hashes
            key[seen] = np.uint64(1 << 62) | self.rank[at[seen]]
        return key.astype(np.int64)


def shingle_sets(texts: pa.Array, order: Order, k: int = K) -> Iterator[np.ndarray]:
    """The sorted distinct shingle keys of each text."""
    encoded, starts = words(texts)
    value, begin = shingles(word_hashes(encoded), starts, k)
    key = order.keys(value)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        yield np.unique(key[a:b])


def frequent_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """At most MOST_FREQUENT hashes that occur in OFTEN or more sampled documents, rarest first."""
    def count(batches):
        for whole in batches:
            for batch in by_size(whole, 0, BATCH_CHARS):
                encoded, starts = words(as_text(batch.column(0)))
                value, begin = shingles(word_hashes(encoded), starts, k)
                own = [np.unique(value[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]
                value, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *own]), return_counts=True)
                yield pa.RecordBatch.from_pydict({"h": value.astype(np.int64), "n": n.astype(np.int64)})
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(SAMPLE_EVERY)) == 0).select("text")
    top = (sample.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)
           .orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).collect())
    return np.array([r["h"] for r in reversed(top)], np.int64).astype(np.uint64)


def boundary(keys: np.ndarray) -> np.ndarray:
    """The shingles of which a linked set must share one."""
    n = len(keys)
    return keys[:n + 1 + (-PART * n // WHOLE)]


def buckets_for(n: int) -> int:
    """Two to four shingles in a bucket on average, so that unrelated sets differ clearly."""
    return min(max(LEAST_BUCKETS, 1 << max((n - 1) // 4, 0).bit_length()), MOST_BUCKETS)


def sketch(keys: np.ndarray) -> bytes:
    many = buckets_for(len(keys))
    counts = np.bincount((mixed(keys.astype(np.uint64)) % np.uint64(many)).astype(np.int64), minlength=many)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def sets_table(docs: DataFrame, order, k: int) -> DataFrame:
    """doc_id, n, set_key (128-bit digest of the set), boundary (its keys) and sketch; the last two are
    null for an empty set and for a set that an earlier row of the batch has."""
    import xxhash

    def derive(batches):
        for whole in batches:
            known = set()
            for batch in by_size(whole, 1, BATCH_CHARS):
                n, digest, firsts, sketches = [], [], [], []
                for keys in shingle_sets(as_text(batch.column(1)), order.value, k):
                    key = xxhash.xxh3_128_digest(keys.tobytes())
                    n.append(len(keys))
                    digest.append(key)
                    new = len(keys) and key not in known
                    firsts.append(boundary(keys).tobytes() if new else None)
                    sketches.append(sketch(keys) if new else None)
                    known.add(key)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                                                  pa.array(firsts, pa.binary()), pa.array(sketches, pa.binary())], ["doc_id", "n", "set_key", "boundary", "sketch"])
            pa.default_memory_pool().release_unused()
    return stored(docs.mapInArrow(derive, "doc_id long, n long, set_key binary, boundary binary, sketch binary"), "op3-sets")


def region_pairs(sets: DataFrame) -> DataFrame:
    """(pivot, doc) for all documents that share a boundary shingle, the pivot itself included. Of
    equal sets only the smallest document with a boundary enters regions; a pivot is always one."""
    def explode(batches):
        for batch in batches:
            keys = [np.frombuffer(b, np.int64) for b in batch.column(1).to_pylist()]
            ids = np.repeat(batch.column(0).to_numpy(), [len(x) for x in keys])
            yield pa.RecordBatch.from_pydict({"shingle": np.concatenate(keys) if keys else np.zeros(0, np.int64), "doc": ids.astype(np.int64)})

    def pivots(batches):
        last, pivot = None, None  # a shingle's rows may go on in the next batch
        for batch in batches:
            shingle, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(shingle):
                continue
            first = np.concatenate([[shingle[0] != last], shingle[1:] != shingle[:-1]])
            start = np.maximum.accumulate(np.where(first, np.arange(len(shingle)), -1))
            own = np.where(start >= 0, doc[start], pivot if pivot is not None else 0)
            last, pivot = shingle[-1], own[-1]
            pairs = np.unique(np.stack([own, doc])[:, ~first], axis=1)
            yield pa.RecordBatch.from_pydict({"pivot": pairs[0].astype(np.int64), "doc": pairs[1].astype(np.int64)})

    bounded = sets.where("boundary IS NOT NULL AND doc_id IS NOT NULL")
    rows = bounded.select("doc_id", "boundary").mapInArrow(explode, "shingle long, doc long")
    sorted_rows = rows.repartition("shingle").sortWithinPartitions("shingle", "doc")
    smallest = bounded.groupBy("set_key").agg(F.min("doc_id").alias("doc")).select("doc").distinct()
    found = sorted_rows.mapInArrow(pivots, "pivot long, doc long").distinct()
    pairs = stored(found.join(smallest, "doc", "left_semi").select("pivot", "doc"), "op3-pairs")
    return pairs.unionByName(pairs.select("pivot", F.col("pivot").alias("doc")).distinct()).distinct()


def with_blocks(pairs: DataFrame, region_docs: int) -> DataFrame:
    """(pivot, part, doc): a region of up to `region_docs` documents is part 0; of a larger one each
    two of its blocks are a part."""
    large = stored(pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > region_docs)
                   .select("pivot", F.ceil(2 * F.col("n") / region_docs).cast("int").alias("blocks")), "op3-large")
    rows = pairs.join(small(large), "pivot", "left")
    block = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    own = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.least(block, other) * F.col("blocks") + F.greatest(block, other)))
    return rows.select("pivot", F.explode(own).alias("part"), "doc")


def with_partner(sketches: list[np.ndarray], size: np.ndarray, settled: np.ndarray | None = None) -> np.ndarray:
    """Which members may link to another one by sizes and sketches, and are not settled with it: two
    members that agree in a row of `settled` need no comparison. Sizes that link differ by a quarter
    at most, so numbers of buckets differ by one doubling; the finer sketch is then folded."""
    order = np.argsort(size, kind="stable")
    size, own = size[order], [sketches[k] for k in order]
    width = np.array([len(c) for c in own])
    full, out = np.array([c.max() == 255 for c in own]), np.zeros(len(own), bool)
    settled = settled[:, order] if settled is not None else None
    top = np.searchsorted(WHOLE * size, WHOLE * WHOLE * size // PART, side="right")  # sizes up to size / 0.8
    for w in np.unique(width):
        at = np.flatnonzero((width == w) | (width == 2 * w))
        counts = np.stack([own[k] if width[k] == w else np.minimum(own[k].reshape(2, w).astype(np.int64).sum(0), 255) for k in at]).astype(np.int16)
        for i in np.flatnonzero(width[at] == w):
            last = np.searchsorted(at, top[at[i]])
            if last > i + 1:
                bound = np.minimum(counts[i + 1:last], counts[i]).sum(1, dtype=np.int64)
                rest = at[i + 1:last]
                may = linked(bound, size[rest], int(size[at[i]])) | full[rest] | full[at[i]]
                if settled is not None:
                    may &= (settled[:, rest] != settled[:, at[i]][:, None]).all(0)
                out[rest[may]] = True
                out[at[i]] |= may.any()
    back = np.zeros(len(out), bool)
    back[order] = out
    return back


def pruned(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The members of region parts that may have a partner there. `members` may carry component and
    home: members that agree in either are settled with each other."""
    marks = [c for c in ("component", "home") if c in members.columns]

    def keep(batches):
        region, held = None, []

        def close():
            settled = np.array([h[3:] for h in held]).T if marks else None
            stay = np.flatnonzero(with_partner([np.frombuffer(h[2], np.uint8) for h in held], np.array([h[1] for h in held]), settled))
            return pa.RecordBatch.from_pydict({"pivot": pa.array([region[0]] * len(stay), pa.int64()), "part": pa.array([region[1]] * len(stay), pa.int32()),
                                               "doc": pa.array([held[k][0] for k in stay], pa.int64())})

        for batch in batches:
            for pivot, part, *row in zip(*(column.to_pylist() for column in batch.columns)):
                if (pivot, part) != region:
                    if len(held) > 1:
                        yield close()
                    region, held = (pivot, part), []
                held.append(row)
        if len(held) > 1:
            yield close()

    told = sets.where("sketch IS NOT NULL").select(F.col("doc_id").alias("doc"), "n", "sketch")
    rows = members.join(told.hint("merge"), "doc").select("pivot", "part", "doc", "n", "sketch", *marks)
    dealt = rows.repartition("pivot", "part").sortWithinPartitions("pivot", "part", "doc")
    return stored(dealt.mapInArrow(keep, "pivot long, part int, doc long"), "op3-members")


def linked(inter: np.ndarray, a: np.ndarray, b: int) -> np.ndarray:
    return WHOLE * inter >= PART * (a + b - inter)


def region_links(ids: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning links between the members of one region: connected as by all links among them."""
    m = len(ids)
    size = np.fromiter(map(len, sets), np.int64, m)
    begin = np.concatenate([[0], np.cumsum(size)])
    flat = np.concatenate(sets)
    component = np.arange(m)
    done = np.zeros(m, bool)
    known: list[np.ndarray] = []  # distances of all members to the first pivots (nan: not computed)
    links = []
    while True:
        open_components, n_open = np.unique(component[~done], return_counts=True)
        if len(open_components) < 2 and (len(known) or m < 2):
            return links
        if known:
            q = int(np.flatnonzero(~done & (component == open_components[np.argmin(n_open)]))[0])
        else:
            q = 0
        may = component != component[q]
        may &= (WHOLE * np.minimum(size, size[q]) >= PART * np.maximum(size, size[q]))
        for far in known:
            if not np.isnan(far[q]):
                may &= ~(np.abs(far - far[q]) > (WHOLE - PART) / WHOLE + 1e-9)
        if not known:
            may[:] = True
        done[q] = True
        at = np.flatnonzero(may)
        if not len(at):
            if not known:
                known.append(np.full(m, np.nan))
            continue
        if len(at) == m:
            part, bounds = flat, begin[:-1]
        else:
            part = np.concatenate([flat[begin[k]:begin[k + 1]] for k in at])
            bounds = np.cumsum(size[at]) - size[at]
        own = sets[q]
        hit = own[np.minimum(np.searchsorted(own, part), len(own) - 1)] == part
        inter = np.add.reduceat(hit.astype(np.int64), bounds)
        if len(known) < 4:
            far = np.full(m, np.nan)
            far[at] = 1 - inter / (size[at] + size[q] - inter)
            known.append(far)
        for k in at[linked(inter, size[at], int(size[q]))]:
            if component[k] != component[q]:
                component[component == component[k]] = component[q]
                links.append((int(ids[q]), int(ids[k])))


def links_of_regions(docs: DataFrame, members: DataFrame, order, k: int) -> DataFrame:
    """(a, b): spanning links of every region part. Texts meet their regions by a shuffle join at
    every size, as the members grow with the documents."""
    per_doc = members.groupBy("doc").agg(F.collect_list(F.struct("pivot", "part")).alias("regions"))
    held = docs.join(per_doc.hint("merge"), F.col("doc_id") == F.col("doc")).select("doc", "text", F.col("regions.pivot").alias("pivots"), F.col("regions.part").alias("parts"))

    def derive(batches):
        for whole in batches:
            for batch in by_size(whole, 1, BATCH_CHARS):
                pivots, parts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                for at, keys in enumerate(shingle_sets(as_text(batch.column(1)), order.value, k)):
                    n = len(pivots[at])
                    yield pa.RecordBatch.from_arrays([pa.array(pivots[at], pa.int64()), pa.array(parts[at], pa.int32()),
                                                      pa.array([batch.column(0)[at].as_py()] * n, pa.int64()),
                                                      pa.array([keys.tobytes()] * n, pa.binary())], ["pivot", "part", "doc", "keys"])

    def join(batches):
        region, ids, sets = None, [], []

        def close():
            found = region_links(np.array(ids), sets) if len(ids) > 1 else []
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

        for batch in batches:
            for pivot, part, doc, keys in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if (pivot, part) != region:
                    if len(ids) > 1:
                        yield close()
                    region, ids, sets = (pivot, part), [], []
                if keys:
                    ids.append(doc)
                    sets.append(np.frombuffer(keys, np.int64))
        if len(ids) > 1:
            yield close()

    rows = held.mapInArrow(derive, "pivot long, part int, doc long, keys binary")
    return rows.repartition("pivot", "part").sortWithinPartitions("pivot", "part", "doc").mapInArrow(join, "a long, b long")


def near_duplicate_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = K,
                          region_docs: int = 2048) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Ids are integers. Null, empty and blank texts have no shingles, link with nothing and are their
    own component; so are rows with a null id (their component is null). Rows that repeat an id
    are one node and get a row each.
    """
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    order = docs.sparkSession.sparkContext.broadcast(Order(frequent_shingles(slim, k)))
    sets = sets_table(slim, order, k)
    members = pruned(with_blocks(region_pairs(sets), region_docs), sets)
    members = stored(members.join(members.groupBy("doc").agg(F.min("pivot").alias("home")), "doc"), "op3-homes")
    near = stored(links_of_regions(slim, members.where("pivot = home"), order, k), "op3-links")
    nodes = sets.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "set_key")
    same = lowest_of(nodes, "set_key", "doc_id", "keep").where("keep <> doc_id").select(F.col("doc_id").alias("a"), F.col("keep").alias("b"))
    components = stored(connected_components(near.unionByName(same), "a", "b"), "op3-components")
    found = components.withColumnRenamed("node", "doc")
    rest = members.join(found, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    more = stored(links_of_regions(slim, pruned(rest, sets), order, k), "op3-links")
    known = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
    components = stored(connected_components(known.unionByName(more), "a", "b"), "op3-components")
    out = sets.select("doc_id", "n").join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = K, region_docs: int = 2048) -> DataFrame:
    """The rows of `docs` without near duplicates: of each component the document with the smallest id.
    Rows with a null id stay; of rows that repeat an id in the same component all stay."""
    report = near_duplicate_report(docs, id_col, text_col, k=k, region_docs=region_docs)
    gone = stored(report.where("doc_id <> component_id").select("doc_id").distinct(), "op3-gone")
    whole = packed(docs, F.col(f"`{id_col}`").cast("long").alias("doc_id"))
    return unpacked(whole.join(small(gone), "doc_id", "left_anti"))
