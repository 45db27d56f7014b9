import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cargotide.operators import forecast as X, history as H, rules as R
from cargotide.plans import jobs as J
from cargotide.sources.calendars import holiday_calendar
from conftest import day, days


def forecast(spark, dates, values, category="DRY", brand="B"):
    return spark.createDataFrame([(d, category, brand, float(v), 0.0) for d, v in zip(dates, values)],
                                 "date date, CATEGORY string, BRAND string, predicted double, actual double")


def predicted(df):
    return {r.date: r.predicted for r in df.collect()}


def test_floors(spark):
    df = forecast(spark, days("2025-06-02", 4), [-1, 0.5, 1.5, 3])
    assert list(predicted(R.clip_floor(df).orderBy("date")).values()) == [0.0, 0.5, 1.5, 3.0]
    assert list(predicted(R.clip_floor(df, R.BRAND_FLOOR).orderBy("date")).values()) == [0.0, 0.0, 1.5, 3.0]


def test_closed_days_in_original_units(spark):
    cal = holiday_calendar(spark)
    got = predicted(R.zero_closed_days(forecast(spark, days("2025-01-01", 5), [9] * 5), cal))
    assert got == {day("2025-01-01"): 0.0, day("2025-01-02"): 9.0, day("2025-01-03"): 9.0, day("2025-01-04"): 9.0, day("2025-01-05"): 0.0}


def test_event_multiplier(spark):
    cal = holiday_calendar(spark)
    got = predicted(R.pre_holiday_multiplier(forecast(spark, days("2025-09-20", 18), [1] * 18), cal))
    assert [got[day("2025-10-06") - dt.timedelta(n)] for n in (0, 1, 3, 4, 7, 8, 10, 11)] == [1.0, 2.5, 2.5, 1.5, 1.5, 1.2, 1.2, 1.0]


def test_overrides_apply_in_order(spark):
    rules = [R.DayOverride(" b ", (22,), 1.0, 2.0), R.DayOverride("B", (22,), 0.0, 3.0), R.DayOverride("other", (22,), 9.0, 9.0)]
    assert predicted(R.day_overrides(forecast(spark, [day("2025-01-22")], [5]), rules)) == {day("2025-01-22"): 33.0}


def test_brand_chain(spark):
    cal = holiday_calendar(spark)
    got = predicted(R.postprocess_brand(forecast(spark, days("2025-06-06", 4), [10, 0.4, 7, 5]), cal))
    assert got == {day("2025-06-06"): 10.0, day("2025-06-07"): 0.0, day("2025-06-08"): 0.0, day("2025-06-09"): 5.0}


def test_month_chunks():
    assert X.month_chunks("2024-01-30", "2024-03-02") == [("2024-01-30", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-02")]
    assert X.month_chunks("2024-02-01", "2024-02-29", 14) == [("2024-02-01", "2024-02-14"), ("2024-02-15", "2024-02-28"), ("2024-02-29", "2024-02-29")]


@pytest.fixture(scope="module")
def history(spark):
    rows = [(d, c, 50.0 * k + 10 * math.sin(n / 7 * 2 * math.pi)) for k, c in enumerate(("DRY", "FRESH"), 1)
            for n, d in enumerate(days("2023-01-01", 500))]
    return spark.createDataFrame(rows, "ACTUALSHIPDATE date, CATEGORY string, `Total CBM` double")


def test_forecasts_cover_exactly_the_range(spark, history):
    model = X.fit_direct(history, 14, 31)
    one = X.forecast_direct(model, history, "2024-05-15", "2024-06-14").collect()
    assert len(one) == 2 * 31 and {r.date for r in one} == set(days("2024-05-15", 31))
    for r in one[:20]:
        base = 50.0 if r.CATEGORY == "DRY" else 100.0
        assert abs(r.predicted - base) < 15
    with pytest.raises(ValueError):
        X.forecast_direct(model, history, "2024-05-15", "2024-06-15")
    many = X.forecast_rolling_monthly(model, history, "2024-05-15", "2024-07-31").collect()
    assert len(many) == 2 * 78 and len({(r.date, r.CATEGORY) for r in many}) == 2 * 78
    scored = X.teacher_forcing_eval(model, history)
    assert scored.count() == 2 * (500 - 14 - 31 + 1) * 31
    assert scored.agg(F.avg("abs_error")).first()[0] < 5


def test_forecast_job_rules_and_scores(spark, history, tmp_path):
    cal = holiday_calendar(spark)
    out = J.forecast_job(spark, history, history, cal, "2024-05-15", "2024-06-20", str(tmp_path / "f"))
    rows = out.collect()
    assert len(rows) == 2 * 37 and min(r.predicted for r in rows) >= 0
    assert all(r.predicted == 0 for r in rows if r.date.weekday() == 6)
    assert set(J.score_job(out)) >= {"metrics", "accuracy", "segments"}
    assert J.score_job(out)["accuracy"].filter("level = 'overall'").count() == 1


def test_feature_frame_keeps_its_rows(spark, history):
    daily = history.withColumn("Total QTY", F.col("`Total CBM`") * 10)
    out = J.feature_frame(daily, holiday_calendar(spark))
    assert out.count() == 1000 and out.select("ACTUALSHIPDATE", "CATEGORY").distinct().count() == 1000
    training = J.training_job(out, 7, 3)
    assert training.windows.filter("split = 'train'").count() == 2 * (350 - 7 - 3 + 1)
    assert training.scaler.count() == 2


def test_attach_actuals_modes(spark):
    f = forecast(spark, days("2025-01-01", 2), [5, 6]).drop("actual")
    a = spark.createDataFrame([(day("2025-01-01"), "DRY", 1.0), (day("2025-01-01"), "DRY", 2.0)], "ACTUALSHIPDATE date, CATEGORY string, `Total CBM` double")
    zero = {r.date.day: (r.actual, r.error) for r in H.attach_actuals(f, a).collect()}
    assert zero == {1: (3.0, 2.0), 2: (0.0, 6.0)}
    null = {r.date.day: (r.actual, r.error) for r in H.attach_actuals(f, a, missing="null").collect()}
    assert null == {1: (3.0, 2.0), 2: (None, None)}
    with pytest.raises(ValueError):
        H.attach_actuals(f, a, missing="drop")


@pytest.mark.parametrize("name", ["forecast_with_features", "forecast_scores"])
def test_forecast_queries_read_the_lines_once(spark, monkeypatch, name):
    """History, actuals and wanted keys come from one stored table, not from the lines again."""
    from cargotide.plans import queries_jobs as Q

    class Stop(Exception):
        pass

    given = []

    def job(session, train, actuals, *args, wanted=None, **options):
        given.extend(df for df in (train, actuals, wanted) if df is not None)
        raise Stop

    monkeypatch.setattr(Q.J, "forecast_job", job)
    with pytest.raises(Stop):
        getattr(Q, name)(spark, "/root/testdata/sf0.001")
    assert len(given) >= 2 and not any("lineitem" in path for df in given for path in df.inputFiles())
