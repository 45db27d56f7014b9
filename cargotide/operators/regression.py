"""Least squares per key from sums.

A fit needs the cross products of its rows only. Tasks sum them per key and batch, Spark adds up
the cells with map-side combining, and one small system per key is solved in a task: rows are never
gathered by key, so a key with a third of all rows is as cheap as any other. Losses whose weight depends on the
prediction are fitted by reweighting: each round is one more pass over the stored rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

Keys = Sequence[str]
#: (predicted, actual) -> factor of a row's weight.
Reweight = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class GroupedModel:
    """Coefficients (intercept first) of all keys together and, in a table of one row per key, of each."""

    keys: tuple[str, ...]
    pooled: tuple[float, ...]
    table: DataFrame | None


def asymmetric_squares(over: float = 2.0, under: float = 1.0) -> Reweight:
    """Squared error that costs `over` above the actual and `under` below it."""
    return lambda predicted, actual: F.when(predicted > actual, F.lit(float(over))).otherwise(F.lit(float(under)))


def quantile_loss(q: float, least: float) -> Reweight:
    """Pinball loss: |error| times `q` below the actual and 1 - `q` above it, as a square divided by |error|.
    Errors below `least` count as `least`, so that no weight is infinite; a tenth of a usual error settles in
    about 15 rounds, a thousandth takes twice as many."""
    def factor(predicted: Column, actual: Column) -> Column:
        e = actual - predicted
        return F.when(e > 0, F.lit(float(q))).otherwise(F.lit(1.0 - q)) / F.greatest(F.abs(e), F.lit(float(least)))
    return factor


def huber_loss(delta: float = 1.0) -> Reweight:
    """Squared up to `delta`, linear beyond."""
    return lambda predicted, actual: F.least(F.lit(1.0), F.lit(float(delta)) / F.greatest(F.abs(actual - predicted), F.lit(1e-12)))


def _usable(rows: DataFrame, keys: Keys, features: str, label: str, weight: str | None) -> DataFrame:
    w = F.lit(1.0) if weight is None else F.col(weight)
    out = rows.select(*keys, F.col(features).cast("array<double>").alias("features"), F.col(label).cast("double").alias("label"),
                      w.cast("double").alias("weight"))
    known = F.forall("features", lambda v: v.isNotNull() & ~F.isnan(v))
    return out.filter(known & F.col("label").isNotNull() & (F.col("weight") > 0))


def cross_products(rows: DataFrame, keys: Keys, size: int) -> DataFrame:
    """(keys, cell, s): sums of weight * z_i * z_j over z = (1, features, label), cells of the upper
    triangle in row order; cell -1 counts the rows."""
    wide = size + 2
    upper = np.triu_indices(wide)
    cells = np.concatenate([[-1], np.arange(len(upper[0]))]).astype(np.int32)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x, y, w = (batch.column(len(keys) + k) for k in range(3))
            z = np.column_stack([np.ones(n), x.flatten().to_numpy().reshape(n, size), y.to_numpy()])
            code = np.zeros(n, int)
            if keys:
                code = batch.select(range(len(keys))).to_pandas().groupby(list(keys), dropna=False, sort=False).ngroup().to_numpy()
            first = np.unique(code, return_index=True)[1]
            sums = []
            for k in code[first]:
                mine = code == k
                square = z[mine].T @ (z[mine] * w.to_numpy()[mine, None])
                sums.append(np.concatenate([[mine.sum()], square[upper]]))
            owner = pa.array(np.repeat(first, len(cells)))
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(owner) for k in range(len(keys))], pa.array(np.tile(cells, len(first))),
                                              pa.array(np.concatenate(sums))], [*keys, "cell", "s"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema], "cell int", "s double"])
    return rows.mapInArrow(partial, schema).groupBy(*keys, "cell").agg(F.sum("s").alias("s"))


def _matrix(cells: np.ndarray, size: int) -> np.ndarray:
    """The symmetric matrix of the cells 0, 1, ..."""
    out = np.zeros((size + 2, size + 2))
    out[np.triu_indices(size + 2)] = cells
    return out + np.triu(out, 1).T


def solve(square: np.ndarray) -> np.ndarray:
    """Coefficients of the last column on the others; features without a direction of their own
    get the least-norm solution in units of their size."""
    a, b = square[:-1, :-1], square[:-1, -1]
    unit = np.sqrt(np.maximum(np.diag(a), 0))
    unit[unit == 0] = 1.0
    return np.linalg.lstsq(a / np.outer(unit, unit), b / unit, rcond=1e-12)[0] / unit


def fit_grouped(rows: DataFrame, keys: Keys, size: int, features: str = "features", label: str = "label", weight: str | None = None,
                shrink: float = 0.0) -> GroupedModel:
    """F2. Weighted least squares of `label` on `size` features, over all rows and per key.

    `shrink` adds that much weight of the average row of all keys to each key, so a key with few rows
    stays near the pooled model and a key with many is its own. Rows with a null label or feature or a
    weight that is not positive are left out; null keys are a key. Without rows all coefficients are 0.
    """
    usable = _usable(rows, keys, features, label, weight)
    sums = cross_products(usable, keys, size)
    if keys:
        sums = cut_lineage(sums, "cross-products")
    cells = (size + 2) * (size + 3) // 2
    pooled = np.zeros(cells + 1)
    for r in sums.groupBy("cell").agg(F.sum("s").alias("s")).collect():  # as many rows as cells
        pooled[r["cell"] + 1] = r["s"]
    whole = _matrix(pooled[1:], size)
    prior = whole / whole[0, 0] * shrink if whole[0, 0] > 0 else whole
    common = tuple(solve(whole).tolist())
    if not keys:
        return GroupedModel((), common, None)

    def per_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.array(v) for v in batch.column(len(keys)).to_pylist()]
            found = [solve(_matrix(v[1:], size) + prior).tolist() for v in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keys)], pa.array([int(v[0]) for v in lists], pa.int64()),
                                              pa.array(found, pa.list_(pa.float64()))], [*keys, "rows", "coefficients"])

    packed = sums.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "s"))), lambda c: c["s"]).alias("cells"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema], "rows bigint", "coefficients array<double>"])
    return GroupedModel(tuple(keys), common, cut_lineage(packed.mapInArrow(per_key, schema), "coefficients"))


def predict_grouped(model: GroupedModel, rows: DataFrame, features: str = "features", out: str = "predicted", least_rows: int = 0) -> DataFrame:
    """Adds `out` and `model`: `own` for keys fitted on at least `least_rows` rows, `pooled` for all others."""
    common = F.array(*[F.lit(float(c)) for c in model.pooled])
    if model.table is None:
        joined = rows.withColumn("_own", F.lit(None).cast("array<double>"))
    else:
        own = model.table.filter(F.col("rows") >= least_rows).select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(model.keys)],
                                                                    F.col("coefficients").alias("_own"))
        same = [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(model.keys)]
        joined = rows.join(own, same, "left").drop(*[f"_k{n}" for n in range(len(model.keys))])
    used = F.coalesce("_own", common)
    dot = F.aggregate(F.zip_with(features, F.slice("_used", 2, len(model.pooled) - 1), lambda x, c: x * c), F.get("_used", F.lit(0)), lambda a, v: a + v)
    return (joined.withColumn("_used", used).withColumns({out: dot, "model": F.when(F.col("_own").isNotNull(), "own").otherwise("pooled")})
            .drop("_own", "_used"))


def fit_reweighted(rows: DataFrame, keys: Keys, size: int, loss: Reweight, features: str = "features", label: str = "label",
                   weight: str | None = None, shrink: float = 0.0, rounds: int = 18) -> GroupedModel:
    """F1 / E13 in the fit: least squares whose row weights are multiplied by the loss's factor at the
    last prediction, `rounds` times. Rows are stored once; only coefficients change between rounds."""
    kept = cut_lineage(_usable(rows, keys, features, label, weight), "fit-rows")
    model = fit_grouped(kept, keys, size, weight="weight", shrink=shrink)
    for _ in range(rounds):
        scored = predict_grouped(model, kept).withColumn("weight", F.col("weight") * loss(F.col("predicted"), F.col("label")))
        model = fit_grouped(scored, keys, size, weight="weight", shrink=shrink)
    return model


__all__ = ["GroupedModel", "Reweight", "asymmetric_squares", "cross_products", "fit_grouped", "fit_reweighted", "huber_loss", "predict_grouped",
           "quantile_loss", "solve"]
