import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cargotide.functions import cleaning as C
from cargotide.operators import history as H, panel as P
from conftest import day, days

LINES = "ACTUALSHIPDATE timestamp_ntz, WHSEID string, SKU string, CATEGORY string, QTY double, CUBE_OUT double"


def test_business_date_is_the_two_step_rule(spark):
    rng = random.Random(3)
    stamps = [dt.datetime(2024, 12, 31) + dt.timedelta(seconds=rng.randrange(200_000)) for _ in range(300)]
    rows = spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz").select("t", C.business_date("t").alias("d")).collect()
    for r in rows:
        local = r.t + dt.timedelta(hours=7)
        assert r.d == (local + dt.timedelta(days=local.hour >= 17)).date()


def test_null_category_is_kept(spark):
    rows = spark.createDataFrame([("TEST",), ("OFFBOM",), (None,), ("DRY",)], "CATEGORY string")
    assert {r.CATEGORY for r in P.drop_categories(rows).collect()} == {None, "DRY"}


def test_unit_rules_and_rescaling(spark):
    rows = [("4305254", 32.0, 9.0), ("ZW840244", 240.0, 5.0), ("A", 1.0, 2.7), ("A", 1.0, 2.69)]
    got = P.clean_measures(spark.createDataFrame(rows, "SKU string, QTY double, CUBE_OUT double")).collect()
    assert got[0].CUBE_OUT == pytest.approx(32 / 16 * 0.027) and got[0].QTY == 32.0
    assert got[1].QTY == pytest.approx(240 / 120 * 0.019) and got[1].CUBE_OUT == pytest.approx(0.005)
    assert got[2].CUBE_OUT == pytest.approx(0.0027) and got[3].CUBE_OUT == 2.69


def test_master_headers_trim_and_first_row(spark):
    raw = spark.createDataFrame([(" 1 ", "B", "dry", 2), ("1", "A", "tet", 1), ("2", " C ", None, 3)],
                                ["Sku ", "Brand name", "Group of cago", "line"])
    got = {r.SKU: (r.BRAND, r.CATEGORY_MASTER) for r in P.load_sku_master(raw, ["line"]).collect()}
    assert got == {"1": ("A", "TET"), "2": ("C", None)}
    with pytest.raises(ValueError):
        P.load_sku_master(spark.createDataFrame([(1,)], ["x"]))


def test_panel_with_a_hot_sku_and_unknown_skus(spark):
    stamp = dt.datetime(2024, 1, 1, 3)
    hot = [(stamp + dt.timedelta(days=k % 3), "W1", "hot", "DRY", 1.0, 1.0) for k in range(3000)]
    rest = [(stamp + dt.timedelta(days=k % 9), f"W{k % 4}", f"s{k % 50}", "DRY", 1.0, 0.5) for k in range(2000)]
    unknown = [(stamp, "W1", "nobody", "DRY", 100.0, 1.0)] * 10
    lines = spark.createDataFrame(hot + rest + unknown, LINES)
    master = spark.createDataFrame([("hot", "H", None)] + [(f"s{k}", "S", "TET") for k in range(50)],
                                   "SKU string, BRAND string, CATEGORY_MASTER string")
    got = P.daily_panel(lines, master).groupBy("CATEGORY", "BRAND").agg(F.sum("Total QTY").alias("q"), F.sum("Total CBM").alias("c"))
    assert {(r.CATEGORY, r.BRAND): (r.q, r.c) for r in got.collect()} == {("DRY", "H"): (3000.0, 3000.0), ("TET", "S"): (2000.0, 1000.0)}
    lost = P.unmatched_sku_count(lines, master).first()
    assert (lost.lines, lost.skus) == (10, 1)


@pytest.mark.parametrize("scope", ["all", "year"])
def test_densify_equals_brute_force(spark, scope):
    rng = random.Random(5)
    rows = {(day("2023-12-20") + dt.timedelta(rng.randrange(30)), rng.choice("ab"), rng.choice("xy")): rng.random() for _ in range(25)}
    rows[(day("2022-05-01"), "c", "x")] = 1.0
    frame = spark.createDataFrame([(*k, v, 2 * v) for k, v in rows.items()], "d date, k string, l string, q double, v double")
    got = {(r.d, r.k, r.l): r.v for r in P.densify_calendar(frame, ["k", "l"], scope, "d", ["q", "v"]).collect()}
    wanted = {}
    for group in ({None} if scope == "all" else {k[0].year for k in rows}):
        part = {k: v for k, v in rows.items() if group is None or k[0].year == group}
        lo, hi = min(k[0] for k in part), max(k[0] for k in part)
        for key in {k[1:] for k in part}:
            for n in range((hi - lo).days + 1):
                d = lo + dt.timedelta(n)
                wanted[(d, *key)] = 2 * part.get((d, *key), 0.0)
    assert got == wanted


def test_slice_business_dates_is_a_filter_on_the_raw_column(spark):
    stamps = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(96)]
    lines = spark.createDataFrame([(s, "W", "s", "DRY", 1.0, 1.0) for s in stamps], LINES)
    got = P.slice_business_dates(lines, "2024-01-02", "2024-01-03").select(C.business_date("ACTUALSHIPDATE").alias("d"))
    assert {r.d for r in got.collect()} == {day("2024-01-02"), day("2024-01-03")} and got.count() == 48


def test_mixed_dates(spark):
    rows = [("03/02/2024",), ("2024-02-03",), ("2024-02-03 10:00:00",), ("03-02-2024",), ("soon",), (None,)]
    got = [r.d for r in spark.createDataFrame(rows, "t string").select(C.parse_mixed_date("t").alias("d")).collect()]
    assert got == [day("2024-02-03")] * 4 + [None, None]


def test_upsert_and_append(spark):
    old = spark.createDataFrame([("2024", "DRY", 1.0, "x"), ("2025", "DRY", 2.0, "y"), ("", "DRY", 9.0, "z")],
                                "Year string, CATEGORY string, a double, note string")
    new = spark.createDataFrame([("2025", "DRY", None, 5.0), ("2026", "DRY", 3.0, 6.0)], "Year string, CATEGORY string, a double, b double")
    out = H.upsert(old, new, ["Year", "CATEGORY"], "Year")
    assert out.columns == ["Year", "CATEGORY", "a", "b", "note"]
    assert {r.Year: (r.a, r.b, r.note) for r in out.collect()} == {"2024": (1.0, None, "x"), "2025": (2.0, 5.0, "y"), "2026": (3.0, 6.0, None)}
    both = H.append_history(old, new)
    assert both.columns == ["Year", "CATEGORY", "a", "note", "b"] and both.count() == 5


def test_merge_history_last_wins(spark):
    h = spark.createDataFrame([(d, "k", 1.0, 0) for d in days("2024-01-01", 3)], "d date, k string, v double, extra int")
    n = spark.createDataFrame([(d, "k", 2.0) for d in days("2024-01-03", 2)], "d date, k string, v double")
    got = {r.d: r.v for r in H.merge_history(h, n, ["k"], "d").collect()}
    assert got == dict(zip(days("2024-01-01", 4), [1.0, 1.0, 2.0, 2.0]))
