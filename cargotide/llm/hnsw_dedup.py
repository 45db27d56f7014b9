"""Embedding near-duplicates with a hierarchical navigable small-world graph per shard (operator 4).

1. Equal vectors of a label are one class with a count, so copies cost nothing more.
2. Classes of a label are dealt to shards of at most `shard_rows` vectors. Each shard builds its
   graph: geometric levels, beam search for the neighbours of a new node, diverse neighbour lists.
3. Each shard audits itself: for a sample of its nodes the beam's links are compared with brute
   force over the shard, and the beam is doubled until it finds `audit_recall` of them.
4. Every block of vectors queries every shard of its label. A beam that holds nothing but links is
   widened and searched again (up to the whole shard), so large groups are found whole.
5. Each pair found is verified by its cosine in double precision. A task returns a count per vector and
   spanning links only; components are found by Spark.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import lowest_of, small, stored
from .components import connected_components

THRESHOLD = 0.93
M, M0 = 12, 24
EF_BUILD = 48


class Graph:
    """Vectors (unit length, 32 bit for the search) and neighbour lists of each level, -1 as filler."""

    def __init__(self, unit: np.ndarray, levels: list[np.ndarray], top: np.ndarray, ef: int = 32):
        self.unit, self.levels, self.top, self.ef = unit, levels, top, ef

    def beam(self, queries: np.ndarray, start: np.ndarray, level: int, ef: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Best `ef` nodes of each query among the first `limit` nodes: (ids, similarities), -1 as
        filler. All queries advance together, expanding four nodes a step."""
        b, lists = len(queries), self.levels[level]
        rows = np.arange(b)
        seen = np.zeros((b, limit), bool)
        ids = np.full((b, ef), -1, np.int64)
        sims = np.full((b, ef), -2.0, np.float32)
        open_ = np.zeros((b, ef), bool)
        ids[:, 0], open_[:, 0], seen[rows, start] = start, True, True
        sims[:, 0] = np.einsum("bd,bd->b", self.unit[start], queries)
        live = rows
        width = min(4, ef)
        while len(live):
            score = np.where(open_[live], sims[live], -3.0)
            pick = np.argpartition(-score, width - 1, axis=1)[:, :width] if ef > width else np.tile(np.arange(ef), (len(live), 1))
            chosen = np.take_along_axis(score, pick, 1) > -3.0
            node = np.where(chosen, np.take_along_axis(ids[live], pick, 1), -1)
            open_[live[:, None], pick] = False
            near = np.where(node[:, :, None] >= 0, lists[node], -1).reshape(len(live), -1)
            near[near >= limit] = -1
            fresh = (near >= 0) & ~seen[live[:, None], near]
            r, c = np.nonzero(fresh)
            new, owner = near[r, c], live[r]
            key = owner * limit + new  # a node may be a neighbour of several expanded ones
            _, once = np.unique(key, return_index=True)
            new, owner, r = new[once], owner[once], r[once]
            seen[owner, new] = True
            value = np.einsum("nd,nd->n", self.unit[new], queries[owner])
            count = np.bincount(r, minlength=len(live))
            most = int(count.max()) if len(r) else 0
            if most:
                place = np.arange(len(r)) - (np.cumsum(count) - count)[r]
                more_ids = np.full((len(live), most), -1, np.int64)
                more_sims = np.full((len(live), most), -2.0, np.float32)
                more_ids[r, place], more_sims[r, place] = new, value
                all_ids = np.concatenate([ids[live], more_ids], 1)
                all_sims = np.concatenate([sims[live], more_sims], 1)
                all_open = np.concatenate([open_[live], more_ids >= 0], 1)
                best = np.argpartition(-all_sims, ef - 1, axis=1)[:, :ef]
                ids[live] = np.take_along_axis(all_ids, best, 1)
                sims[live] = np.take_along_axis(all_sims, best, 1)
                open_[live] = np.take_along_axis(all_open, best, 1)
            live = live[open_[live].any(1)]
        return ids, sims

    def search(self, queries: np.ndarray, ef: int, limit: int | None = None, down_to: int = 0) -> tuple[np.ndarray, np.ndarray]:
        limit = len(self.unit) if limit is None else limit
        at = np.zeros(len(queries), np.int64)  # node 0 is on every level
        for level in range(len(self.levels) - 1, down_to, -1):
            ids, sims = self.beam(queries, at, level, 1, limit)
            at = ids[:, 0]
        return self.beam(queries, at, down_to, min(ef, limit), limit)


def diverse(unit: np.ndarray, of: int, cands: np.ndarray, most: int) -> np.ndarray:
    """Neighbours kept for a node: nearest first, those nearer to a kept one than to the node left
    out, then filled up with the nearest of the rest."""
    sims = unit[cands] @ unit[of]
    order = np.argsort(-sims, kind="stable")
    cands, sims = cands[order], sims[order]
    if len(cands) <= most:
        return cands
    among = unit[cands] @ unit[cands].T
    worst = np.full(len(cands), -2.0, np.float32)
    kept = []
    for k in range(len(cands)):
        if sims[k] > worst[k]:
            kept.append(k)
            if len(kept) == most:
                break
            np.maximum(worst, among[k], out=worst)
    rest = np.setdiff1d(np.arange(len(cands)), kept)
    return cands[np.concatenate([kept, rest[:most - len(kept)]]).astype(int)]


def build(unit: np.ndarray, seed: int = 4) -> Graph:
    """Inserts the vectors in batches that double: a batch searches the graph of all before it and
    is compared within itself."""
    n = len(unit)
    level = np.minimum((-np.log(np.random.default_rng(seed).random(n)) / np.log(M)).astype(int), 5) if n else np.zeros(0, int)
    if n:
        level[0] = level.max()
    graph = Graph(unit, [np.full((n, 2 * (M0 if k == 0 else M)), -1, np.int32) for k in range(int(level.max(initial=0)) + 1)], level)
    used = [np.zeros(n, np.int32) for _ in graph.levels]

    def connect(k: int, node: int, cands: np.ndarray) -> None:
        most = M0 if k == 0 else M
        lists, count = graph.levels[k], used[k]
        kept = diverse(unit, node, cands, most // 2)
        lists[node, :len(kept)], count[node] = kept, len(kept)
        for other in kept:
            if count[other] == lists.shape[1]:
                short = diverse(unit, other, lists[other, :count[other]], most)
                lists[other] = -1
                lists[other, :len(short)], count[other] = short, len(short)
            lists[other, count[other]] = node
            count[other] += 1

    done = 0
    while done < n:
        size = min(n - done, 64 if not done else min(done, 512))
        batch = np.arange(done, done + size)
        inside = unit[batch] @ unit[batch].T
        for k in range(len(graph.levels)):
            own = np.flatnonzero(level[batch] >= k)
            found = graph.search(unit[batch[own]], EF_BUILD, done, k)[0] if done and len(own) else np.full((len(own), 0), -1)
            for j, i in enumerate(own):
                earlier = own[own < i]
                close = earlier[np.argsort(-inside[i, earlier])[:EF_BUILD // 2]]
                cands = np.concatenate([found[j][found[j] >= 0], batch[close]]).astype(np.int64)
                if len(cands):
                    connect(k, int(batch[i]), cands)
        done += size
    return graph


def linked(graph: Graph, exact: np.ndarray, queries: np.ndarray, threshold: float, ef: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs with cosine >= threshold that the beam finds, verified in double precision."""
    n, ef = len(exact), ef or graph.ef
    single = queries.astype(np.float32)
    out_q, out_n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    todo = np.arange(len(queries))
    while len(todo):
        again = []
        for at in range(0, len(todo), max(1, min(256, 16_000_000 // max(n, 1)))):
            part = todo[at:at + max(1, min(256, 16_000_000 // max(n, 1)))]
            if ef >= n:  # as wide as the shard: all of it
                ids = np.tile(np.arange(n), (len(part), 1))
                sims = single[part] @ graph.unit.T
            else:
                ids, sims = graph.search(single[part], ef)
                full = sims.min(1) >= threshold - 1e-3
                again.append(part[full])
                ids[full] = -1
            r, c = np.nonzero((ids >= 0) & (sims >= threshold - 1e-3))
            q, node = part[r], ids[r, c]
            true = np.einsum("nd,nd->n", exact[node], queries[q]) >= threshold
            out_q.append(q[true])
            out_n.append(node[true])
        todo, ef = (np.concatenate(again) if again else np.zeros(0, np.int64)), ef * 4
    return np.concatenate(out_q), np.concatenate(out_n)


def probes(exact: np.ndarray, sample: int, threshold: float) -> np.ndarray:
    """Unit vectors halfway between the threshold and 1 from vectors of the shard: each has a link that the
    audit must find, and none is in the shard, so no vector's hit on itself counts."""
    near = exact[np.linspace(0, len(exact) - 1, min(sample, len(exact))).astype(int)]
    noise = np.random.default_rng(len(exact)).normal(size=near.shape)
    noise -= np.einsum("nd,nd->n", noise, near)[:, None] * near
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-300)
    cosine = (1 + threshold) / 2
    moved = cosine * near + np.sqrt(max(1 - cosine ** 2, 0.0)) * noise
    return moved / np.linalg.norm(moved, axis=1, keepdims=True)


def audited(graph: Graph, exact: np.ndarray, threshold: float, recall: float, sample: int) -> Graph:
    """Doubles the beam until the links of `sample` probes are found as by brute force."""
    n = len(exact)
    if not n:
        return graph
    asked = probes(exact, sample, threshold)
    truth = int((asked @ exact.T >= threshold).sum())
    while graph.ef < n and len(linked(graph, exact, asked, threshold)[0]) < recall * truth:
        graph.ef *= 2
    return graph


def packed_arrays(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unit_rows(column: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in column])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A forest of the links that connects what they connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def near_duplicate_report(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *,
                          threshold: float = THRESHOLD, shard_rows: int = 50_000, least_shards: int = 4, block_rows: int = 12_500,
                          audit_recall: float = 0.99, audit_rows: int = 256) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components, rows with a null label or a
    null id link with nothing: n_links 0, own component (null for a null id). Vectors of different lengths are
    never compared. Rows that repeat an id are separate vectors of one node. Ids are integers.
    """
    x, size = F.col("v"), F.size("v")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (size > 0) & fine & F.exists(x, lambda e: e != 0)
    rows = stored(rows.withColumn("usable", F.coalesce(usable, F.lit(False))).withColumn("key", F.struct("label", "v")), "op4-rows")
    own = stored(lowest_of(rows.where("usable").select("vec_id", "key"), "key", "vec_id", "rep"), "op4-classes")
    counts = own.groupBy("rep").agg(F.count(F.lit(1)).alias("copies"))
    reps = rows.where("usable").select("vec_id", "label", "v").join(counts.withColumnRenamed("rep", "vec_id"), "vec_id").dropDuplicates(["vec_id", "label", "v"])
    dims = F.size("v")
    reps = stored(reps.withColumn("label", F.concat_ws("|", "label", dims.cast("string"))), "op4-reps")
    per_label = stored(reps.groupBy("label").agg(F.greatest(F.ceil(F.count(F.lit(1)) / shard_rows), F.lit(least_shards)).cast("int").alias("shards"),
                                                 F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")), "op4-labels")
    dealt = reps.join(small(per_label), "label").select(
        "label", "vec_id", "copies", "v", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int").alias("shard"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.greatest("blocks", F.lit(1)) * 2).cast("int").alias("block"))

    def build_shard(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id")
        exact = unit_rows(group["v"])
        graph = audited(build(exact.astype(np.float32)), exact, threshold, audit_recall, audit_rows)
        data = packed_arrays(exact=exact, ids=group["vec_id"].to_numpy(), copies=group["copies"].to_numpy(), top=graph.top, ef=np.array(graph.ef),
                             **{f"level{k}": lists for k, lists in enumerate(graph.levels)})
        return pd.DataFrame({"label": [group["label"].iloc[0]], "shard": [int(group["shard"].iloc[0])], "graph": [data]})

    def pack_block(group: pd.DataFrame) -> pd.DataFrame:
        data = packed_arrays(exact=unit_rows(group["v"]), ids=group["vec_id"].to_numpy())
        return pd.DataFrame({"label": [group["label"].iloc[0]], "block": [int(group["block"].iloc[0])], "queries": [data]})

    graphs = stored(dealt.groupBy("label", "shard").applyInPandas(build_shard, "label string, shard int, graph binary"), "op4-graphs")
    blocks = stored(dealt.select("label", "vec_id", "v", "block").groupBy("label", "block").applyInPandas(pack_block, "label string, block int, queries binary"), "op4-blocks")

    def query(batches):
        for batch in batches:
            for raw, asked in zip(batch.column(0), batch.column(1)):
                g, q = np.load(io.BytesIO(raw.as_py())), np.load(io.BytesIO(asked.as_py()))
                exact, ids, copies = g["exact"], g["ids"], g["copies"]
                graph = Graph(exact.astype(np.float32), [g[f"level{k}"] for k in range(len([f for f in g.files if f.startswith("level")]))], g["top"], int(g["ef"]))
                at, node = linked(graph, exact, q["exact"], threshold)
                a, b = q["ids"][at], ids[node]
                other = a != b
                n = np.bincount(at[other], weights=copies[node[other]], minlength=len(q["ids"])).astype(np.int64)
                tree = spanning(a[other], b[other])
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array(np.concatenate([q["ids"][some], np.array([x for x, _ in tree], np.int64)]), pa.int64()),
                    "b": pa.array([*[None] * len(some), *[y for _, y in tree]], pa.int64()),
                    "n": pa.array([*n[some].tolist(), *[0] * len(tree)], pa.int64())})

    pairs = graphs.join(blocks, "label").select("graph", "queries", "shard", "block", "label").repartition("label", "shard", "block")
    found = stored(pairs.select("graph", "queries").mapInArrow(query, "a long, b long, n long"), "op4-found")
    components = stored(connected_components(found.where("b IS NOT NULL"), "a", "b").withColumnRenamed("node", "rep"), "op4-components")
    links = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    # a row per class, then by (class, salt) to the rows, so a class of very many copies is spread
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(32))
    told = (own.withColumn("salt", salt).groupBy("rep").agg(F.count(F.lit(1)).alias("copies"), F.collect_set("salt").alias("salts"))
            .join(links.withColumnRenamed("a", "rep"), "rep", "left").join(components, "rep", "left")
            .select("rep", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"), F.explode("salts").alias("salt")))
    good = own.withColumn("salt", salt).join(told, ["rep", "salt"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
