import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargotide.functions import lunar as L
from cargotide.operators import history as H, sampling as S, series as O
from cargotide.operators.quantiles import exact_quantiles, grouped_quantiles
from cargotide.operators.ranking import with_positions
from conftest import day, days
from test_calendar import lunar_by_stepping


def series(spark, rows):
    return spark.createDataFrame([(d, "k", v) for d, v in rows], "d date, k string, v double")


def values(df):
    return [r.v for r in df.orderBy("d").collect()]


def test_the_two_carry_overs_differ(spark):
    rows = list(zip(days("2025-01-05", 2), [5.0, 1.0])) + [(day("2025-01-13"), 2.0)]
    assert values(O.carryover_train(series(spark, rows), ["k"], "v", "d")) == [5.0, 6.0, 7.0]
    assert values(O.carryover_forecast(series(spark, rows), ["k"], "v", "d")) == [0.0, 6.0, 2.0]


def test_leap_day_gives_no_double_rows(spark):
    rows = [(d, float(n)) for n, d in enumerate(days("2023-02-20", 800))]
    out = O.yoy_volume(series(spark, rows), (1, 2), ["k"], "v", "d").collect()
    assert len(out) == 800
    known = dict(rows)
    for r in out:
        back = None if (r.d.month, r.d.day) == (2, 29) else known.get(r.d.replace(year=r.d.year - 1))
        assert r.cbm_last_year == (back or 0.0), r.d
        back = None if (r.d.month, r.d.day) == (2, 29) else known.get(r.d.replace(year=r.d.year - 2))
        assert r.cbm_2_years_ago == (back or 0.0), r.d


def test_moving_average_skips_flagged_days(spark):
    df = spark.createDataFrame([(d, "k", v, f) for d, v, f in zip(days("2025-01-01", 4), [1.0, 100.0, 3.0, 9.0], [1, 1, 0, 0])],
                               "d date, k string, v double, is_operational_anomaly int")
    out = O.moving_average_baseline(df, 2, ["k"], "v", "d").orderBy("d").collect()
    assert [r.v_MA2 for r in out] == [None, None, 3.0, 6.0]


def test_fill_gaps_stays_inside_the_key(spark):
    df = spark.createDataFrame([(day("2025-01-01"), "a", None), (day("2025-01-02"), "a", 2.0), (day("2025-01-03"), "a", None),
                                (day("2025-01-01"), "b", None)], "d date, k string, v double")
    got = {(r.k, r.d.day): r.f for r in df.withColumn("f", O.fill_gaps("v", ["k"], "d")).collect()}
    assert got == {("a", 1): 2.0, ("a", 2): 2.0, ("a", 3): 2.0, ("b", 1): 0.0}


def test_pad_short_history(spark):
    out = O.pad_short_history(series(spark, [(d, float(d.day)) for d in days("2025-01-01", 3)]), 5, ["k"], "d")
    rows = out.orderBy("pad", "d").collect()
    assert [(r.v, r.pad) for r in rows] == [(1.0, 0), (2.0, 0), (3.0, 0), (3.0, 1), (3.0, 2)]


def test_lunar_yoy_equals_the_row_rule(spark):
    rng = random.Random(11)
    all_days = days("2022-12-01", 900)
    history = {d: rng.random() for d in all_days if rng.random() < 0.45}
    first = {}
    for d in days("2021-01-01", 2000):
        first.setdefault((d.year, lunar_by_stepping(d)), d)
    out = H.lunar_yoy_volume(series(spark, history.items()), (1, 2), ["k"], "v", "d").collect()
    assert len(out) == len(history)
    for r in out:
        for n, got in ((1, r.cbm_last_year), (2, r.cbm_2_years_ago)):
            target = first.get((r.d.year - n, lunar_by_stepping(r.d)))
            found = next((history[target + dt.timedelta(o)] for o in (0, -1, 1, -2, 2, -3, 3)
                          if target and target + dt.timedelta(o) in history), 0.0)
            assert got == found, (r.d, n)


def test_warm_up_only_for_empty_windows(spark):
    history = series(spark, [(d, 7.0) for d in days("2023-01-01", 800)])
    empty = series(spark, [(d, 0.0) for d in days("2025-02-01", 10)])
    assert set(values(H.warm_up(empty, history, ["k"], "v", "d"))) == {7.0}
    busy = series(spark, [(d, 0.2) for d in days("2025-02-01", 10)])
    assert set(values(H.warm_up(busy, history, ["k"], "v", "d"))) == {0.2}


@pytest.mark.parametrize("n,drop,expected", [(10, False, 4), (10, True, 3), (7, False, 1), (6, False, 0)])
def test_window_counts(spark, n, drop, expected):
    rows = series(spark, [(d, float(k)) for k, d in enumerate(days("2025-01-01", n))])
    out = S.sliding_windows(rows, 4, 3, ["v"], "v", ["k"], "d", drop).orderBy("window_id").collect()
    assert len(out) == expected
    if expected:
        assert out[0].x == [[0.0], [1.0], [2.0], [3.0]] and out[0].y == [4.0, 5.0, 6.0]
        assert out[0].label_date == day("2025-01-05") and out[0].y_dates == days("2025-01-05", 3)


def test_splits(spark):
    rows = series(spark, [(d, 1.0) for d in days("2025-01-01", 103)])
    got = S.temporal_split(rows, keys=["k"], date="d").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 72, "val": 10, "test": 21}
    with pytest.raises(ValueError):
        S.temporal_split(rows, 0.5, 0.1, 0.1)
    one = S.random_split(rows, seed=1, keys=["k"], date="d").orderBy("d").select("split").collect()
    two = S.random_split(rows.repartition(3), seed=1, keys=["k"], date="d").orderBy("d").select("split").collect()
    assert one == two


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_exact_quantiles_with_a_third_of_one_value(spark, ranges):
    rng = np.random.default_rng(2)
    data = np.concatenate([np.zeros(1000), rng.normal(5, 3, 2000).round(2)])
    rng.shuffle(data)
    df = spark.createDataFrame([(float(x),) for x in data] + [(None,)], "v double").repartition(5)
    qs = [0.0, 0.1, 0.25, 0.5, 0.8, 0.95, 0.999, 1.0]
    got = exact_quantiles(df, "v", qs, ranges).first().quantiles
    assert got == pytest.approx(list(np.quantile(data, qs)), abs=1e-9)


def test_grouped_quantiles_of_a_hot_null_constant_and_empty_group(spark):
    rng = np.random.default_rng(4)
    groups = {("hot", 1): rng.normal(size=3000), ("hot", None): [7.0] * 500, (None, 1): rng.integers(0, 4, 90).astype(float), ("one", 2): [3.5], ("none", 3): []}
    rows = [(*k, float(x)) for k, v in groups.items() for x in v] + [("none", 3, None), ("one", 2, None)]
    df = spark.createDataFrame(rows, "a string, b int, v double").repartition(4)
    qs = [0.0, 0.3, 0.5, 0.99, 1.0]
    for ranges in (2, 23):
        got = {(r.a, r.b): (r.n, r.quantiles) for r in grouped_quantiles(df, ["a", "b"], "v", qs, ranges).collect()}
        assert got.keys() == {k for k, v in groups.items() if len(v)}
        for k, (n, quantiles) in got.items():
            assert n == len(groups[k]) and quantiles == pytest.approx(list(np.quantile(groups[k], qs)), abs=1e-12)
    assert grouped_quantiles(df.limit(0), ["a"], "v", qs).count() == 0


def test_positions_follow_the_order_without_gaps(spark):
    rng = np.random.default_rng(6)
    rows = [(int(rng.integers(0, 5)) if k % 7 else None, k) for k in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(6)
    got = {r.position: (r.a, r.b) for r in with_positions(df, [F.desc_nulls_last("a"), F.asc("b")]).collect()}
    assert [got[k] for k in range(2000)] == sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert with_positions(df.limit(0), [F.col("a")]).count() == 0


def test_quantiles_without_values(spark):
    nothing = spark.createDataFrame([("a", day("2024-01-01"), None), ("b", day("2024-01-01"), None)], "k string, d date, v double")
    assert exact_quantiles(nothing, "v", [0.5]).first().quantiles == []
    assert {r.v for r in O.median_fill(nothing, "v", ["k"]).collect()} == {None}
    assert O.median_fill(nothing.filter("false"), "v", ["k"]).count() == 0


def test_exact_quantile_of_few_rows(spark):
    df = spark.createDataFrame([(3.0,), (1.0,)], "v double")
    assert exact_quantiles(df, "v", [0.5, 0.8]).first().quantiles == pytest.approx([2.0, 2.6])


def test_median_fill_falls_back_to_the_whole(spark):
    df = spark.createDataFrame([(day("2025-01-01"), "a", 1.0), (day("2025-01-02"), "a", 5.0), (day("2025-01-03"), "a", None),
                                (day("2025-01-01"), "b", None)], "d date, k string, v double")
    got = {(r.k, r.d.day): r.v for r in O.median_fill(df, "v", ["k"]).collect()}
    assert got[("a", 3)] == 3.0 and got[("b", 1)] == 3.0


def test_density_handles_missing_quantities(spark):
    from cargotide.functions.measures import density

    rows = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (None, 2.0), (-1.0, 2.0)], "c double, q double")
    assert [r.x for r in rows.select(density("c", "q").alias("x")).collect()] == [0.25, 1.0, 0.0, 0.0]


def test_festival_of_year_matches_anchor(spark):
    df = spark.createDataFrame([(day("2025-03-01"),), (day("2024-12-31"),)], "d date")
    assert [r.f for r in df.select(L.festival_of_year("d").alias("f")).collect()] == [day("2025-10-06"), day("2024-09-17")]
    assert df.select(F.max("d")).first()[0] == day("2025-03-01")


def test_random_split_has_exact_sizes_and_stays(spark):
    rows = spark.createDataFrame([(f"k{n % 7}" if n % 11 else None, day("2024-01-01"), n) for n in range(1003)], "k string, d date, v int").repartition(5)
    got = S.random_split(rows, 0.7, 0.1, 0.2, keys=["k"], date="d")
    assert got.columns == ["k", "d", "v", "split"]
    sizes = {r.split: r["count"] for r in got.groupBy("split").count().collect()}
    assert sizes == {"train": 702, "val": 100, "test": 201}
    again = S.random_split(rows.repartition(2), 0.7, 0.1, 0.2, keys=["k"], date="d")
    assert got.exceptAll(again).count() == 0
    other = S.random_split(rows, 0.7, 0.1, 0.2, seed=1, keys=["k"], date="d")
    assert got.exceptAll(other).count() > 0 and S.random_split(rows.limit(0), keys=["k"], date="d").count() == 0


def test_fingerprint_is_order_free_and_sees_every_row(spark):
    from cargotide.operators.stats import dataset_fingerprint, encode_categories

    data = [(f"a{n}", float(n) / 3, n % 2 == 0, day("2024-01-01")) for n in range(200)] + [(None, None, None, None), ("", 0.0, False, None)]
    schema = "s string, x double, b boolean, d date"

    def mark(rows, n=3):
        return dataset_fingerprint(spark.createDataFrame(rows, schema).repartition(n), ["s", "x", "b", "d"]).first().asDict()
    whole = mark(data)
    assert whole["rows"] == 202 and whole == mark(data[::-1], 7)
    for changed in (data + [data[5]], data[1:], data[:-1] + [(None, 0.0, False, None)], [("a0", 0.1, True, day("2024-01-01")), *data[1:]],
                    [("a", 0.0, True, day("2024-01-01")), *data[1:]]):
        assert mark(changed)["fingerprint"] != whole["fingerprint"]
    assert mark([])["rows"] == 0 and mark([])["fingerprint"] == "0"
    names = spark.createDataFrame([(c,) for c in ["b", "a", None, "c", "a"]], "CATEGORY string")
    assert {r.CATEGORY: r.CATEGORY_ID for r in encode_categories(names).collect()} == {"a": 0, "b": 1, "c": 2}
