"""Approximate nearest neighbours by stable projections in kd-trees (operator 13).

Largest inner product becomes smallest distance by one more coordinate: with R the greatest norm,
(x, sqrt(R^2 - |x|^2)) and (q, 0) have distance^2 = |q|^2 + R^2 - 2 q.x. A Gaussian projection to
`dims` coordinates is 2-stable: squared projected distance over squared distance is chi-square
with `dims` degrees of freedom, whatever the vectors are.

1. Equal vectors are one class; only the k + 1 smallest ids of a class can be among anyone's nearest k,
   so a vector that a third of all rows share is one point with k + 1 ids.
2. A kd-tree over a bounded sample of projected points gives regions; a region with more than
   `shard_rows` points is dealt to parts by hash. Every class is in one shard (region, part).
3. Each query is searched in one shard of the region nearest to it. The k + 1st score found bounds the
   projected radius that matters, and the query goes on to the shards of the regions that radius reaches.
4. A task reads a shard, builds its kd-tree and streams that shard's queries past it. Leaves are
   taken in the order of their projected distance; points inside the radius are verified on the
   original vectors, the k + 1st best score shrinks the radius, and the search stops when the chi-square
   test holds: a point still unseen would be nearer than the k + 1st with probability below 1 - `confidence`.
5. A window keeps the best k + 1 of each distinct query; the query's own row is taken out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

LEAF = 128
#: Most regions of the kd-tree: the directory of regions has a fixed size bound, parts take the growth.
MOST_REGIONS = 4096
SALTS = 32
ROW = "region int, part int, kind int, id long, ids array<long>, v array<double>, least double"
FOUND = "qid long, ids array<long>, scores array<double>, same array<boolean>"


def chi_square_cdf(x: float, dims: int) -> float:
    """P(chi-square with `dims` degrees <= x), by the series of the lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, h = dims / 2.0, x / 2.0
    term = total = 1.0 / a
    k = a
    while term > total * 1e-16:
        k += 1.0
        term *= h / k
        total += term
    return min(1.0, total * math.exp(a * math.log(h) - h - math.lgamma(a)))


def chi_square_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, dims) < p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, dims) < p else (low, middle)
    return high


def kd_leaves(points: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows of each leaf: halved at the median of the widest coordinate down to `most` rows. Equal
    points may part, so every leaf ends within the bound."""
    todo, done = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            done.append(rows)
            continue
        here = points[rows]
        axis = int(np.argmax(here.max(0) - here.min(0)))
        order = np.argpartition(here[:, axis], len(rows) // 2)
        todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
    return done


class Space:
    """What all tasks share: scale, greatest norm, projection, the regions' splits."""

    def __init__(self, length: int, top: float, norm: float, dims: int, confidence: float, seed: int):
        # a power of two: scaling and its undoing are exact
        self.scale = 2.0 ** math.ceil(math.log2(top))
        self.radius2 = (norm / self.scale) ** 2 * (1 + 1e-12)
        self.dims, self.chi = dims, chi_square_quantile(confidence, dims) * (1 + 1e-9)
        self.directions = np.random.default_rng([seed, length]).normal(size=(length + 1, dims))
        # the added coordinate is common to all differences: its image gets its expected length, so that one
        # unlucky draw does not stretch the distances of every query alike
        self.directions[-1] *= math.sqrt(dims) / np.linalg.norm(self.directions[-1])
        self.axes, self.cuts, self.depth = np.zeros(0, int), np.zeros(0), 0

    def scaled(self, v: pa.ListArray) -> np.ndarray:
        return v.flatten().to_numpy().reshape(len(v), -1) / self.scale

    def placed(self, x: np.ndarray) -> np.ndarray:
        """Projected candidates."""
        rest = np.sqrt(np.maximum(self.radius2 - np.einsum("nd,nd->n", x, x), 0))
        return x @ self.directions[:-1] + rest[:, None] * self.directions[-1]

    def asked(self, x: np.ndarray) -> np.ndarray:
        """Projected queries."""
        return x @ self.directions[:-1]

    def reach2(self, x: np.ndarray, score: np.ndarray | float) -> np.ndarray:
        """Squared projected radius beyond which the chi-square test holds for a k + 1st score."""
        distance2 = np.maximum(np.einsum("...d,...d->...", x, x) + self.radius2 - 2 * score, 0)
        return self.chi * distance2

    def split(self, sample: np.ndarray, depth: int) -> None:
        """A complete kd-tree of `depth` levels; an empty node repeats its parent's cut."""
        self.depth = depth
        self.axes, self.cuts = np.zeros(2 ** depth, int), np.zeros(2 ** depth)
        parts = {1: sample}
        for node in range(1, 2 ** depth):
            here = parts.pop(node)
            if len(here):
                self.axes[node] = int(np.argmax(here.max(0) - here.min(0)))
                self.cuts[node] = np.median(here[:, self.axes[node]])
            elif node > 1:
                self.axes[node], self.cuts[node] = self.axes[node // 2], self.cuts[node // 2]
            right = here[:, self.axes[node]] > self.cuts[node]
            parts[2 * node], parts[2 * node + 1] = here[~right], here[right]

    def region(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), int)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + (points[rows, self.axes[node]] > self.cuts[node])
        return node - 2 ** self.depth


def outside2(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to each box."""
    gap = np.maximum(np.maximum(low - point, point - high), 0)
    return np.einsum("bm,bm->b", gap, gap)


class Shard:
    """One shard's vectors in the order of its kd-leaves."""

    def __init__(self, space: Space, x: np.ndarray, ids: list[np.ndarray]):
        points = space.placed(x)
        leaves = kd_leaves(points, LEAF)
        order = np.concatenate(leaves)
        self.space, self.x, self.points = space, x[order], points[order]
        self.ids = [ids[k] for k in order]
        self.first = np.array([a[0] for a in self.ids])
        self.members = np.array([len(a) for a in self.ids])
        self.ends = np.cumsum([0, *map(len, leaves)])
        self.low = np.array([points[rows].min(0) for rows in leaves])
        self.high = np.array([points[rows].max(0) for rows in leaves])

    def search(self, q: np.ndarray, want: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, scores, same vector as q) of the `want` nearest members with scores of at least
        `least`, as far as the stopping test lets them be seen."""
        at = self.space.asked(q[None])[0]
        gap2 = outside2(at, self.low, self.high)
        order = np.argsort(gap2, kind="stable")
        rows, scores = np.zeros(0, int), np.zeros(0)
        worst, taken, step = least, 0, 2
        while taken < len(order):
            reach2 = self.space.reach2(q, worst) if worst > -math.inf else math.inf
            batch = order[taken:taken + step]
            batch = batch[gap2[batch] <= reach2]
            if not len(batch):
                break
            near = np.concatenate([np.arange(self.ends[k], self.ends[k + 1]) for k in batch])
            if reach2 < math.inf:
                off = self.points[near] - at
                near = near[np.einsum("nm,nm->n", off, off) <= reach2]
            score = self.x[near] @ q
            good = score >= worst
            rows, scores = np.concatenate([rows, near[good]]), np.concatenate([scores, score[good]])
            best = np.lexsort((self.first[rows], -scores))[:want]
            rows, scores = rows[best], scores[best]
            full = np.flatnonzero(np.cumsum(self.members[rows]) >= want)
            if len(full):
                worst = max(worst, scores[full[0]])
            taken, step = taken + step, step * 2
        exact = np.einsum("nd,d->n", self.x[rows], q)
        count = self.members[rows]
        ids = np.concatenate([np.zeros(0, np.int64), *[self.ids[k] for k in rows]])
        same = np.repeat((self.x[rows] == q).all(1), count)
        score = np.repeat(exact, count)
        best = np.lexsort((ids, -score))[:want]
        return ids[best], score[best], same[best]


def _search(space: Space, want: int):
    """Streams (shard rows, then its queries) by shard; only one shard is held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, vectors, ids, shard = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            region, part, kind = (batch.column(k).to_numpy() for k in range(3))
            code = (region.astype(np.int64) << 33) + (part.astype(np.int64) << 1) + kind
            starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            for a, b in zip(starts, [*starts[1:], len(code)]):
                run_of, x = batch.slice(a, b - a), space.scaled(batch.column(5).slice(a, b - a))
                if code[a] >> 1 != key:
                    key, vectors, ids, shard = code[a] >> 1, [], [], None
                if kind[a] == 0:
                    vectors.append(x)
                    lists = run_of.column(4)
                    ids += np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])
                    continue
                if shard is None:  # a query comes only to a shard that has points, and after them
                    shard = Shard(space, np.concatenate(vectors), ids)
                    vectors = []
                got = [shard.search(q, want, s) for q, s in zip(x, run_of.column(6).to_numpy())]
                ends = pa.array(np.cumsum([0, *[len(g[0]) for g in got]]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([g[k] for g in got]))) for k in range(3)]
                yield pa.RecordBatch.from_arrays([run_of.column(3), *lists], ["qid", "ids", "scores", "same"])
    return run


def _extremes(classes: DataFrame) -> tuple[float, float]:
    """Greatest component and norm, one row per batch combined by Spark."""
    def scan(batches):
        for batch in batches:
            x = np.abs(batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)) if batch.num_rows else np.zeros((0, 1))
            if len(x):
                top = x.max(1, keepdims=True)
                norm = top[:, 0] * np.sqrt(np.einsum("nd,nd->n", x / top, x / top))
                yield pa.RecordBatch.from_pydict({"top": [float(top.max())], "norm": [float(norm.max())]})

    row = classes.select("v").mapInArrow(scan, "top double, norm double").agg(F.max("top").alias("top"), F.max("norm").alias("norm")).first()
    return row["top"], row["norm"]


def _directory(space: Space, classes: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(region, points, low, high) of the regions that have points: at most MOST_REGIONS rows."""
    names = [f"{e}{k}" for e in ("l", "h") for k in range(space.dims)]

    def scan(batches):
        for batch in batches:
            if batch.num_rows:
                points = space.placed(space.scaled(batch.column(0)))
                region = space.region(points)
                for r in np.unique(region):
                    here = points[region == r]
                    yield pa.RecordBatch.from_pydict({"region": pa.array([int(r)], pa.int32()), "n": pa.array([len(here)], pa.int64()),
                                                      **{c: [float(v)] for c, v in zip(names, np.concatenate([here.min(0), here.max(0)]))}})

    schema = "region int, n long, " + ", ".join(f"{c} double" for c in names)
    rows = (classes.select("v").mapInArrow(scan, schema).groupBy("region")
            .agg(F.sum("n").alias("n"), *[(F.min if c[0] == "l" else F.max)(c).alias(c) for c in names]).orderBy("region").collect())
    box = np.array([[r[c] for c in names] for r in rows])
    return np.array([r["region"] for r in rows]), np.array([r["n"] for r in rows]), box[:, :space.dims], box[:, space.dims:]


def _sample(space: Space, classes: DataFrame, fit_rows: int) -> np.ndarray:
    """At most `fit_rows` projected points, those with the smallest hashes of their class."""
    chosen = classes.select("id", "v").withColumn("h", F.xxhash64("id", F.lit(13))).orderBy("h").limit(fit_rows)

    def project(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(space.placed(space.scaled(batch.column(0)))), pa.list_(pa.float64()))], ["p"])

    return np.array([r["p"] for r in chosen.select("v").mapInArrow(project, "p array<double>").collect()]).reshape(-1, space.dims)


def _found(classes: DataFrame, asked: DataFrame, length: int, want: int, dims: int, confidence: float, shard_rows: int,
           fit_rows: int, seed: int) -> DataFrame:
    """Rows (qid, ids, scores, same) from the home shards and from the others within reach."""
    space = Space(length, *_extremes(classes), dims, confidence, seed)
    shards = max(1, math.ceil(classes.count() / shard_rows))
    space.split(_sample(space, classes, fit_rows), min(math.ceil(math.log2(shards)), int(math.log2(MOST_REGIONS))))
    regions, sizes, low, high = _directory(space, classes)
    parts = -(-sizes // shard_rows)
    place = np.zeros(2 ** space.depth, int)
    place[regions] = np.arange(len(regions))

    def spread(x: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Part of a row in its region, by a hash of its number."""
        return (number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % x

    def rows_of(region, part, kind, ids, lists, v, least):
        n = len(region)
        return pa.RecordBatch.from_arrays([pa.array(region, pa.int32()), pa.array(part, pa.int32()), pa.array(np.full(n, kind), pa.int32()),
                                           ids, lists if lists is not None else pa.nulls(n, pa.list_(pa.int64())), v, pa.array(least, pa.float64())],
                                          ["region", "part", "kind", "id", "ids", "v", "least"])

    def deal(batches):
        for batch in batches:
            if batch.num_rows:
                region = space.region(space.placed(space.scaled(batch.column(2))))
                yield rows_of(region, spread(parts[place[region]], batch.column(0).to_numpy()), 0, batch.column(0), batch.column(1), batch.column(2),
                              np.zeros(batch.num_rows))

    def homes(x: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.array([np.argmin(outside2(p, low, high)) for p in space.asked(x)], int)
        return at, spread(parts[at], number)

    def go_home(batches):
        for batch in batches:
            if batch.num_rows:
                at, part = homes(space.scaled(batch.column(1)), batch.column(0).to_numpy())
                yield rows_of(regions[at], part, 1, batch.column(0), None, batch.column(1), np.full(batch.num_rows, -math.inf))

    def go_on(batches):
        for batch in batches:
            x, least = space.scaled(batch.column(1)), batch.column(2).to_numpy()
            at, own = homes(x, batch.column(0).to_numpy()) if len(x) else ([], [])
            for k, p in enumerate(space.asked(x) if len(x) else []):
                reach2 = space.reach2(x[k], least[k]) if least[k] > -math.inf else math.inf
                reached = np.flatnonzero(outside2(p, low, high) <= reach2)
                where = np.repeat(reached, parts[reached])
                part = np.arange(len(where)) - np.repeat(np.cumsum(parts[reached]) - parts[reached], parts[reached])
                other = (where != at[k]) | (part != own[k])
                n = int(other.sum())
                if n:
                    same = pa.array(np.full(n, k))
                    yield rows_of(regions[where[other]], part[other], 1, batch.column(0).take(same), None, batch.column(1).take(same), np.full(n, least[k]))

    points = classes.select("id", "ids", "v").mapInArrow(deal, ROW)
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def searched(queries: DataFrame, label: str) -> DataFrame:
        dealt = points.unionByName(queries).repartition(tasks, "region", "part").sortWithinPartitions("region", "part", "kind")
        return stored(dealt.mapInArrow(_search(space, want), FOUND), label)

    first = searched(asked.select("id", "v").mapInArrow(go_home, ROW), "op13-home")
    least = first.select(F.col("qid").alias("id"), F.coalesce(F.get("scores", F.lit(want - 1)), F.lit(-math.inf)).alias("least"))
    onward = asked.join(least, "id").select("id", "v", "least").mapInArrow(go_on, ROW)
    both = first.unionByName(searched(onward, "op13-onward"))
    undo = F.lit(space.scale)
    return both.withColumn("scores", F.transform("scores", lambda s: s * undo * undo))


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 20, dims: int = 8,
            confidence: float = 0.95, shard_rows: int = 8_192, fit_rows: int = 16_384, seed: int = 13) -> DataFrame:
    """Per query row its k nearest other rows: query_id, rank (from 1), vec_id, score.

    `is_query` is a condition on the input's columns. Nearness is the inner product of the original vectors in
    double precision; equal scores go to the smaller id. The regions are fitted to at most `fit_rows` points (by hash);
    every row is indexed. A true neighbour is seen with probability of at least `confidence`; what is returned has its exact score.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id,
    take no part. Vectors of different lengths are never compared. Rows that repeat an id or a whole row are
    rows of their own: a query leaves out one row with its id and vector, and a repeated query
    row has its list repeated. With fewer than k candidates all are returned, without any the query has no
    rows. Only the id, the vector and the columns of `is_query` are read.
    """
    v = F.col("v")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("query"))
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(math.inf))) & F.exists(v, lambda e: e != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).withColumn("v", F.transform(v, lambda e: e + F.lit(0.0)))
    rows = stored(rows, "op13-rows")
    lowest = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    classes = (rows.select("vec_id", "v").withColumn("n", lowest).where(F.col("n") <= k + 1)
               .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "op13-classes")
    queries = rows.where("query").select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).alias("salt"))
    asked = queries.groupBy("v").agg(F.collect_set("salt").alias("salts"))
    asked = stored(asked.withColumn("id", F.monotonically_increasing_id()), "op13-queries")
    found = None
    for length in [r[0] for r in asked.select(F.size("v")).distinct().collect()]:
        one = _found(classes.where(F.size("v") == length), asked.where(F.size("v") == length), length, k + 1, dims, confidence,
                     shard_rows, fit_rows, seed)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return rows.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    each = found.select("qid", F.explode(F.arrays_zip("ids", "scores", "same")).alias("e")).select("qid", "e.*")
    order = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("scores"), "ids"))
    best = (each.withColumn("n", order).where(F.col("n") <= k + 1)
            .groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("n", "ids", "scores", "same"))).alias("near")))
    # a row per distinct query and salt, so a query vector of very many rows is spread
    told = best.join(asked.select(F.col("id").alias("qid"), "v", F.explode("salts").alias("salt")), "qid")
    mine = queries.join(told, ["v", "salt"])
    own = F.aggregate("near", F.lit(0), lambda at, e: F.when((at == 0) & (e["ids"] == F.col("vec_id")) & e["same"], e["n"]).otherwise(at))
    kept = F.slice(F.filter("near", lambda e: e["n"] != F.col("own")), 1, k)
    return (mine.withColumn("own", own).select(F.col("vec_id").alias("query_id"), F.posexplode(kept).alias("at", "e"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.ids").alias("vec_id"), F.col("e.scores").alias("score")))
