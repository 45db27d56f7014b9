"""Grouped fits against numpy, and losses against what they should reach."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargotide.operators import regression as G

SCHEMA = "k string, g int, features array<double>, label double, w double"


def frame(spark, seed=1, n=400):
    rng = np.random.default_rng(seed)
    rows = []
    for key, slope in (("a", 2.0), ("b", -1.0), (None, 0.5)):
        for _ in range(n):
            x = rng.normal(size=2) * [1.0, 100.0]
            rows.append((key, 1, x.tolist(), float(3 + slope * x[0] + 0.01 * x[1] + rng.normal()), float(rng.uniform(0.5, 2))))
    rows += [("few", 1, [0.5, 1.0], 9.0, 1.0), ("flat", 2, [1.0, 5.0], 4.0, 1.0), ("flat", 2, [1.0, 5.0], 6.0, 1.0)]
    odd = [("a", 1, [None, 1.0], 1.0, 1.0), ("a", 1, [float("nan"), 1.0], 1.0, 1.0), ("a", 1, [1.0, 1.0], None, 1.0), ("a", 1, [9.0, 9.0], 1e9, 0.0), ("gone", 1, [1.0, 1.0], None, 1.0)]
    return rows, spark.createDataFrame(rows + odd, SCHEMA).repartition(5)


def least_squares(rows):
    z = np.array([[1.0, *r[2]] for r in rows])
    w = np.sqrt([r[4] for r in rows])
    return np.linalg.lstsq(z * w[:, None], np.array([r[3] for r in rows]) * w, rcond=None)[0]


def test_coefficients_equal_numpy(spark):
    rows, df = frame(spark)
    model = G.fit_grouped(df, ["k", "g"], 2, weight="w")
    assert model.pooled == pytest.approx(least_squares(rows), abs=1e-9)
    got = {(r.k, r.g): r for r in model.table.collect()}
    assert set(got) == {("a", 1), ("b", 1), (None, 1), ("few", 1), ("flat", 2)}
    for key in (("a", 1), ("b", 1), (None, 1)):
        mine = [r for r in rows if (r[0], r[1]) == key]
        assert got[key].coefficients == pytest.approx(least_squares(mine), abs=1e-8) and got[key]["rows"] == len(mine)
    scored = {r.k: r for r in G.predict_grouped(model, df.filter("k IN ('few', 'flat')").unionByName(
        spark.createDataFrame([("new", 1, [1.0, 2.0], None, 1.0)], SCHEMA)), least_rows=2).collect()}
    assert scored["flat"].predicted == pytest.approx(5.0) and scored["flat"].model == "own"
    assert scored["few"].model == scored["new"].model == "pooled"
    assert scored["new"].predicted == pytest.approx(np.dot(model.pooled, [1, 1, 2]))


def test_shrinking_moves_small_keys_to_the_pooled_model(spark):
    rows, df = frame(spark)
    near = G.fit_grouped(df, ["k"], 2, weight="w", shrink=1e9)
    assert all(r.coefficients == pytest.approx(near.pooled, rel=1e-4, abs=1e-4) for r in near.table.collect())
    some = {r.k: r.coefficients for r in G.fit_grouped(df, ["k"], 2, weight="w", shrink=5.0).table.collect()}
    assert some["a"][1] == pytest.approx(2.0, abs=0.2)  # many rows: its own
    few = rows[-3]
    z = np.array([[1.0, *r[2]] for r in rows])
    w = np.array([r[4] for r in rows])
    y = np.array([r[3] for r in rows])
    own = np.array([1.0, *few[2]])
    a = np.outer(own, own) + 5 * (z.T @ (z * w[:, None])) / w.sum()
    assert some["few"] == pytest.approx(np.linalg.solve(a, own * few[3] + 5 * (z.T @ (y * w)) / w.sum()), rel=1e-6)


def test_no_rows(spark):
    empty = frame(spark)[1].limit(0)
    model = G.fit_grouped(empty, ["k"], 2)
    assert model.pooled == (0.0, 0.0, 0.0) and model.table.count() == 0
    assert G.predict_grouped(model, empty).count() == 0


@pytest.mark.parametrize("q", [0.5, 0.9])
def test_quantile_fit_covers_its_share(spark, q):
    rng = np.random.default_rng(8)
    rows = [(k, 1, [float(x)], float(5 + 3 * x + (1 + x) * rng.exponential()), 1.0) for k in ("a", "b") for x in rng.uniform(0, 4, 2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = G.fit_reweighted(df, ["k"], 1, G.quantile_loss(q, 0.2), rounds=12)
    share = G.predict_grouped(model, df).groupBy("k").agg(F.avg((F.col("label") < F.col("predicted")).cast("double")).alias("s")).collect()
    assert all(abs(r.s - q) < 0.02 for r in share)


def test_asymmetric_and_huber_fits(spark):
    rng = np.random.default_rng(9)
    y = rng.normal(size=3000)
    rows = [("a", 1, [float(x)], float(v), 1.0) for x, v in zip(rng.normal(size=3000), y)]
    df = spark.createDataFrame(rows, SCHEMA)
    level = G.fit_reweighted(df, [], 1, G.asymmetric_squares(over=4.0, under=1.0), rounds=6).pooled[0]
    err = y - level  # an expectile: weighted errors of both sides balance
    assert level < -0.3 and abs(4 * -err[err < 0].sum() - err[err > 0].sum()) / 3000 < 0.02
    wild = spark.createDataFrame([*rows, *[("a", 1, [0.0], 1e4, 1.0)] * 30], SCHEMA)
    assert abs(G.fit_reweighted(wild, [], 1, G.huber_loss(1.0), rounds=8).pooled[0]) < 0.1 < G.fit_grouped(wild, [], 1).pooled[0]
