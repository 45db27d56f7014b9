import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cargotide.functions import calendar as K, lunar as L
from cargotide.functions.measures import early_month_weight
from cargotide.sources.calendars import HOLIDAY_TEXT, holiday_calendar, holiday_dates, parse_calendar, us_holidays

from conftest import day, days


def frame(spark, dates):
    return spark.createDataFrame([(d,) for d in dates], "d date")


def test_early_month_interaction_with_default_busy_days(spark):
    got = {r.d: r["is_high_vol_weekday_AND_early_month"]
           for r in frame(spark, days("2025-01-01", 15)).withColumns(K.early_month("d")).collect()}
    wanted = dict(zip(days("2025-01-01", 15), [-5, 0, -5, 0, 0, -2, 0, -2, 0, -2, 0, 0, 0, 0, 0]))
    assert got == wanted


def test_early_month_flags_around_a_month_end(spark):
    rows = frame(spark, days("2025-01-31", 6)).withColumns({**K.early_month("d"), **K.end_of_month("d")}).orderBy("d").collect()
    assert [r.is_first_3_days for r in rows] == [0, 1, 1, 1, 0, 0]
    assert [r.is_EOM for r in rows] == [1, 0, 0, 0, 0, 0]
    assert rows[1].post_peak_signal == 1.0 and rows[0].early_month_low_tier == 2


def test_early_month_weight_schedule(spark):
    got = [r.w for r in spark.range(1, 13).select(early_month_weight(F.col("id"), 50.0).alias("w")).collect()]
    assert got[:5] == [50.0] * 5
    assert got[5:10] == pytest.approx([22.865, 10.456, 4.782, 2.187, 1.0], abs=1e-3)
    assert got[10:] == [1.0, 1.0]


def test_fresh_monday_has_the_highest_tier(spark):
    rows = frame(spark, days("2025-01-06", 7)).withColumns(K.weekday_tier("d", "fresh")).orderBy("d").collect()
    assert [r.weekday_volume_tier for r in rows] == [6, 0, 5, 0, 5, -3, -3]
    assert [r.is_high_volume_weekday for r in rows] == [1, 0, 1, 0, 1, 0, 0]


def lunar_by_stepping(d: dt.date) -> tuple[int, int]:
    anchors = {y: day(t) for y, t in L.MID_AUTUMN_ANCHORS.items()}
    current = anchors[min(max(d.year, 2023), 2026)]
    month, number = 8, 15
    while current < d:
        current += dt.timedelta(1)
        number += 1
        if number > 30:
            month, number = month % 12 + 1, 1
    while current > d:
        current -= dt.timedelta(1)
        number -= 1
        if number < 1:
            month, number = (month - 2) % 12 + 1, 30
    return month, number


def test_lunar_closed_form_equals_stepping_through_days(spark):
    span = days("2020-01-01", 4018)
    rows = frame(spark, span).withColumns(L.lunar_date("d")).collect()
    for r in rows[::7]:
        assert (r.lunar_month, r.lunar_day) == lunar_by_stepping(r.d), r.d


@pytest.mark.parametrize("date,lunar", [("2023-09-29", (8, 15)), ("2024-09-03", (8, 1)), ("2025-08-15", (6, 23)),
                                        ("2025-09-22", (8, 1)), ("2025-10-06", (8, 15)), ("2026-01-01", (11, 18)),
                                        ("2022-06-30", (5, 9))])
def test_known_lunar_dates(spark, date, lunar):
    r = frame(spark, [day(date)]).withColumns(L.lunar_date("d")).first()
    assert (r.lunar_month, r.lunar_day) == lunar


def test_gregorian_for_lunar_is_the_first_date_of_the_year(spark):
    year = [d for d in days("2024-01-01", 366)]
    first = {}
    for d in year:
        first.setdefault(lunar_by_stepping(d), d)
    rows = spark.createDataFrame([(m, n, 2024) for m, n in first], "m int, n int, y int").select(
        "m", "n", L.gregorian_for_lunar("m", "n", "y").alias("g")).collect()
    assert {(r.m, r.n): r.g for r in rows} == first


def test_season_rules_differ_at_their_edges(spark):
    d = frame(spark, [day("2025-08-01"), day("2025-07-31"), day("2025-10-21"), day("2025-10-22")])
    rows = d.withColumns(L.lunar_date("d")).select(
        "d", L.mooncake_active("d", "mid_autumn_window").alias("a")).orderBy("d").collect()
    assert [r.a for r in rows] == [False, True, True, False]
    with pytest.raises(ValueError):
        L.mooncake_active(F.col("d"), "unknown")


def test_calendar_content(spark):
    rows = parse_calendar(HOLIDAY_TEXT)
    assert ("business", 2023, "new_year", day("2022-12-31")) in rows
    assert ("business", 2025, "reunification_labor", day("2024-04-29")) in rows
    cal = holiday_calendar(spark)
    got = [r.date for r in holiday_dates(cal, "business", "2024-12-01", "2025-01-27").orderBy("date").collect()]
    assert got == [day("2024-12-31"), day("2025-01-01"), day("2025-01-26"), day("2025-01-27")]


def test_us_holidays(spark):
    got = {r.name: r.date for r in us_holidays(spark.createDataFrame([(2024,)], "year int")).collect()}
    assert got["mlk"] == day("2024-01-15") and got["memorial"] == day("2024-05-27")
    assert got["labor"] == day("2024-09-02") and got["thanksgiving"] == day("2024-11-28")
    assert got["columbus"] == day("2024-10-14") and got["presidents"] == day("2024-02-19") and len(got) == 10


def test_cycle_is_periodic(spark):
    r = frame(spark, [day("2025-04-01")]).withColumns(K.temporal_cyclic("d")).first()
    assert r.month_sin == pytest.approx(math.sin(2 * math.pi * 3 / 12))
