"""Forecasts on feature columns: state against windows, learned effects, complete keys."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargotide.operators import feature_forecast as M, regression as G
from cargotide.plans import jobs as J
from cargotide.sources.calendars import holiday_calendar

from conftest import day, days

SCHEMA = "ACTUALSHIPDATE date, CATEGORY string, `Total CBM` double"


def series(spark, n=800, keys=("DRY", "FRESH"), first="2022-01-01", effect=None):
    rng = np.random.default_rng(2)
    rows = []
    for level, k in enumerate(keys, 1):
        for d in days(first, n):
            rows.append((d, k, float(50 * level + 10 * (d.weekday() < 5) + rng.normal() + (effect(d) if effect else 0))))
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_state_gives_the_features_of_the_windows(spark):
    rows, df = series(spark)
    features = M.FeatureSet(years=(1, 2), baseline=21)
    want = {(r.CATEGORY, r.date): r for r in M._rows(M._prepared(df, ["CATEGORY"], "Total CBM", "ACTUALSHIPDATE", None), features, 10, ["CATEGORY"], 1)
            .filter(F.col("origin") == F.lit("2024-02-25").cast("date")).collect()}
    state = M.feature_state(df, features, ["CATEGORY"], "2024-02-26", "Total CBM", "ACTUALSHIPDATE")
    got = M.state_rows(state, features, ["CATEGORY"], "2024-02-26", "2024-03-06", 10).collect()
    assert len(got) == 20 and dt.date(2024, 2, 29) in {r.date for r in got}
    for r in got:
        w = want[(r.CATEGORY, r.date)]
        assert r.features == pytest.approx(w.features, abs=1e-9) and r.baseline == pytest.approx(w.baseline) and r.horizon_step == w.horizon_step
        assert len(r.features) == len(features.names)


def test_short_and_gappy_histories(spark):
    df = spark.createDataFrame([(day("2024-01-30"), "new", 7.0), (day("2024-01-28"), "new", 4.0), (day("2024-01-02"), "old", 9.0)], SCHEMA)
    features = M.FeatureSet(rolling=(7,), momentum=None, lags=(1, 3, 9), years=(1,), step=False)
    state = M.feature_state(df, features, ["CATEGORY"], "2024-02-01", "Total CBM", "ACTUALSHIPDATE")
    got = {r.CATEGORY: r for r in state.collect()}
    assert got["new"]["values"] == [4.0, 0.0, 7.0, 0.0] and len(got["old"]["values"]) == 30
    rows = {r.CATEGORY: r.features for r in M.state_rows(state, features, ["CATEGORY"], "2024-02-01", "2024-02-01", 31).collect()}
    assert rows["new"] == [11 / 4, 0.0, 0.0, 4.0, 0.0] and rows["old"] == [0.0] * 5


def test_a_planted_holiday_effect_is_learned(spark):
    cal = holiday_calendar(spark)
    dates = {r.date for r in cal.filter("kind = 'model'").collect()}
    _, df = series(spark, 1000, effect=lambda d: 40.0 if d in dates else 0.0)
    features = J.model_features(cal, columns=("holiday_indicator", "is_weekend"), rolling=(28,), momentum=None, lags=(), years=())
    train = df.filter("ACTUALSHIPDATE < '2024-02-01'")
    model = M.fit_features(train, features, 31, ["CATEGORY"], stride=3)
    out = M.forecast_features(model, train, "2024-02-01", "2024-04-30").collect()
    assert len(out) == 2 * 90 and {r.model for r in out} == {"own"}
    for level, k in enumerate(("DRY", "FRESH"), 1):
        mine = [r for r in out if r.CATEGORY == k]
        on = [r.predicted for r in mine if r.date in dates]
        off = [r.predicted for r in mine if r.date not in dates and r.date.weekday() < 5]
        assert len(on) >= 5 and abs(np.mean(on) - 50 * level - 45) < 15 and abs(np.mean(off) - 50 * level - 10) < 4
    scored = M.evaluate_features(model, df, first="2024-01-31", stride=5)
    assert scored.agg(F.avg(F.abs("error"))).first()[0] < 4


def test_a_quantile_loss_reaches_the_model(spark):
    _, df = series(spark, 500)
    one = M.FeatureSet(rolling=(7,), momentum=None, lags=(), years=(), step=False)
    model = M.fit_features(df, one, 7, ["CATEGORY"], loss=G.quantile_loss(0.9, 0.05))
    covered = M.evaluate_features(model, df).groupBy("CATEGORY").agg(F.avg((F.col("actual") < F.col("predicted")).cast("double")).alias("c")).collect()
    assert all(abs(r.c - 0.9) < 0.02 for r in covered)


def test_residual_baseline_and_floor(spark):
    df = spark.createDataFrame([(d, "a", 10.0) for d in days("2024-01-01", 60)] + [(d, "b", 0.0) for d in days("2024-01-01", 60)], SCHEMA)
    features = M.FeatureSet(rolling=(7,), momentum=None, lags=(), years=(), step=False, baseline=14)
    model = M.FeatureModel(features, G.GroupedModel(("CATEGORY",), (-1.0, 0.0), None), 31, ("CATEGORY",))
    got = {(r.CATEGORY, r.date.isoformat()): r.predicted for r in M.forecast_features(model, df, "2024-03-01", "2024-04-02").collect()}
    assert got[("a", "2024-03-31")] == 9.0 and got[("b", "2024-03-01")] == 0.0  # not below the floor
    assert got[("a", "2024-04-01")] == 8.0  # the baseline of April is March's forecast


def test_complete_forecast_loses_no_key(spark):
    rows = [(d, "DRY", b, v) for d in days("2024-01-01", 60) for b, v in (("A", 6.0), ("B", 2.0))] + [(day("2024-02-29"), "DRY", "C", 1.0)]
    df = spark.createDataFrame(rows, "ACTUALSHIPDATE date, CATEGORY string, BRAND string, `Total CBM` double")
    keys = ["CATEGORY", "BRAND"]
    one = M.FeatureSet(rolling=(7,), momentum=None, lags=(), years=(), step=False)
    model = M.fit_features(df, one, 7, keys, scaled=False, least_rows=10)
    own = M.forecast_features(model, df, "2024-03-01", "2024-03-05")
    parents = spark.createDataFrame([(d, "DRY", 100.0) for d in days("2024-03-01", 5)], "date date, CATEGORY string, predicted double")
    wanted = spark.createDataFrame([("DRY", b) for b in "ABCDD"], "CATEGORY string, BRAND string")
    got = M.complete_forecast(own, parents, wanted, df, smoothing=10.0).collect()
    assert len(got) == 4 * 5 and len({(r.BRAND, r.date) for r in got}) == 20
    by = {r.BRAND: r for r in got}
    assert by["A"].model == by["B"].model == "own" and by["A"].predicted == pytest.approx(6.0)
    total = 360 + 120 + 1 + 40
    assert by["C"].model == "allocated" and by["C"].predicted == pytest.approx(100 * 11 / total) and by["D"].predicted == pytest.approx(100 * 10 / total)
    shares = M.smoothed_shares(wanted, df.limit(0), smoothing=1.0).collect()
    assert [r.share for r in shares] == [0.25] * 4
