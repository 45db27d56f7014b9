"""Queries: weights, baselines, rules and forecast jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..columns import BRAND, CATEGORY, CBM, DATE
from ..functions import calendar as K, lunar as L
from ..functions.measures import WeightProfile, sample_weight
from ..operators import forecast as X, history as H, rules as B
from . import shipments as S
from .catalog import query, r, rounded
from .sqltext import V, dow, flag as sflag, i, pos, r as rs, sql


def forecast_frame(spark: SparkSession, d: str, keys=(CATEGORY,)) -> DataFrame:
    """`date, keys, predicted, actual`: the mean of the seven days before each day."""
    return X.baseline_forecast(S.dense(spark, d, keys), "moving_average", keys)


PROFILE = WeightProfile(weekday={0: 3.0, 2: 2.0, 4: 2.0}, early_month_base=50.0, golden=12.0, peak_loss=20.0,
                        august=30.0, category={"DRY": 1.5})


@query("F1_sample_weights", sql(f"""
    SELECT ACTUALSHIPDATE, CATEGORY, {rs(f'''
      (CASE WHEN {V} > t THEN 3e0 ELSE 1e0 END)
      * (CASE isodow(ACTUALSHIPDATE) WHEN 1 THEN 3e0 WHEN 3 THEN 2e0 WHEN 5 THEN 2e0 ELSE 1e0 END)
      * (CASE WHEN day(ACTUALSHIPDATE) <= 5 THEN 50e0 WHEN day(ACTUALSHIPDATE) <= 10
          THEN 50e0 * pow(50e0, -(day(ACTUALSHIPDATE) - 5) / 5e0) ELSE 1e0 END)
      * (CASE WHEN CATEGORY = 'MOONCAKE' AND month(ACTUALSHIPDATE) = 8 THEN 120e0 ELSE 1e0 END)
      * (CASE WHEN CATEGORY = 'MOONCAKE' AND p BETWEEN 194 AND 224 THEN 20e0 ELSE 1e0 END)
      * (CASE WHEN month(ACTUALSHIPDATE) = 8 THEN 30e0 ELSE 1e0 END)
      * (CASE WHEN CATEGORY = 'DRY' THEN 15e-1 ELSE 1e0 END)''', 4)} AS weight
    FROM (SELECT *, {pos('ACTUALSHIPDATE')} AS p, quantile_cont({V}, 8e-1) OVER (PARTITION BY CATEGORY) AS t FROM dense)""", "dense"))
def f1(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    rows = S.dense(spark, d).withColumns(L.lunar_date(DATE, S.ANCHORS)).withColumn("days_to_tet", F.lit(365))
    rows = rows.withColumns(L.season_window(DATE, anchors=S.ANCHORS)).withColumn(
        "t", F.percentile(F.col(f"`{CBM}`"), F.lit(0.8)).over(Window.partitionBy(CATEGORY)))
    weight = sample_weight(CBM, DATE, "t", PROFILE, golden="is_golden_window", peak_loss="is_peak_loss_window")
    return rows.select(DATE, CATEGORY, r(weight, 4).alias("weight"))


@query("F3_baseline_seasonal_naive", sql(f"""
    SELECT * FROM (SELECT ACTUALSHIPDATE AS date, CATEGORY, {rs(f'lag({V}, 7) OVER (PARTITION BY CATEGORY ORDER BY ACTUALSHIPDATE)')} AS predicted,
      {rs(V)} AS actual FROM dense) WHERE predicted IS NOT NULL""", "dense"))
def f3_naive(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.baseline_forecast(S.dense(spark, d), "seasonal_naive"), "predicted", "actual")


@query("F3_baseline_moving_average", sql(f"""
    SELECT date, CATEGORY, {rs('predicted')} AS predicted, {rs('actual')} AS actual FROM fc""", "fc"))
def f3_mean(spark: SparkSession, d: str) -> DataFrame:
    return rounded(forecast_frame(spark, d), "predicted", "actual")


@query("F3_baseline_last_year", sql(f"""
    SELECT a.ACTUALSHIPDATE AS date, a.CATEGORY, {rs(f'coalesce(l.{V}, 0e0)')} AS predicted, {rs(f'a.{V}')} AS actual
    FROM dense a LEFT JOIN dense l ON l.CATEGORY = a.CATEGORY AND month(l.ACTUALSHIPDATE) = month(a.ACTUALSHIPDATE)
      AND day(l.ACTUALSHIPDATE) = day(a.ACTUALSHIPDATE) AND year(l.ACTUALSHIPDATE) = year(a.ACTUALSHIPDATE) - 1""", "dense"))
def f3_last_year(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.baseline_forecast(S.dense(spark, d), "last_year"), "predicted", "actual")


# ---------------------------------------------------------------- rules

def rule_frame(spark: SparkSession, d: str, keys=(CATEGORY,)) -> DataFrame:
    """Forecast minus a constant, so that small and negative values occur."""
    return forecast_frame(spark, d, keys).withColumn("predicted", F.col("predicted") * 1.5 - 1.0)


RF = "SELECT date, CATEGORY, predicted * 15e-1 - 1e0 AS predicted, actual FROM fc"
RFB = "SELECT date, CATEGORY, BRAND, predicted * 15e-1 - 1e0 AS predicted, actual FROM fcb"
CLOSED = "date IN (SELECT date FROM closed)"
FLOORED = "CASE WHEN predicted < 0 THEN 0e0 ELSE predicted END"
FESTIVAL = "(CASE year(date) " + " ".join(f"WHEN {y} THEN DATE '{a}'" for y, a in S.ANCHORS.items()) + " END)"
SEASON = f"date_diff('day', {FESTIVAL}, date) BETWEEN -66 AND 15"
EVENT_FACTOR = """(CASE WHEN ahead BETWEEN 1 AND 3 THEN 25e-1 WHEN ahead BETWEEN 4 AND 7 THEN 15e-1
    WHEN ahead BETWEEN 8 AND 10 THEN 12e-1 ELSE 1e0 END)"""
AHEAD = "SELECT day, date_diff('day', day, (SELECT min(date) FROM major m WHERE m.date > day)) AS ahead FROM span"


def carried(source: str, keys: str) -> str:
    """SQL of the Sunday carry-over."""
    return f"""SELECT date, {keys}, actual, CASE WHEN isodow(date) = 7 THEN 0e0
        WHEN isodow(date) = 1 AND lag(date) OVER w = date - 1 THEN predicted + lag(predicted) OVER w
        ELSE predicted END AS predicted FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY date)"""


@query("F9_clip_floor", sql(f"""
    SELECT date, CATEGORY, {rs("CASE WHEN predicted < 0 OR (CATEGORY = 'MOONCAKE' AND predicted < 2) THEN 0e0 ELSE predicted END")} AS predicted
    FROM x""", "fc", extra={"x": RF}))
def f9(spark: SparkSession, d: str) -> DataFrame:
    out = B.clip_floor(B.clip_floor(rule_frame(spark, d)), B.MOONCAKE_FLOOR, "MOONCAKE")
    return rounded(out.select("date", CATEGORY, "predicted"), "predicted")


@query("F10_zero_closed_days", sql(f"""
    SELECT date, CATEGORY, {rs(f'CASE WHEN {CLOSED} OR isodow(date) = 7 THEN 0e0 ELSE predicted END')} AS predicted
    FROM x""", "fc", "closed", extra={"x": RF}))
def f10(spark: SparkSession, d: str) -> DataFrame:
    out = B.zero_closed_days(rule_frame(spark, d), S.calendar(spark))
    return rounded(out.select("date", CATEGORY, "predicted"), "predicted")


@query("F11_season_mask_and_boost", sql(f"""
    SELECT date, CATEGORY, {rs(f"predicted * CASE WHEN CATEGORY = 'MOONCAKE' AND NOT ({SEASON}) THEN 0 WHEN CATEGORY = 'MOONCAKE' AND month(date) = 8 THEN 2 ELSE 1 END")} AS predicted
    FROM x""", "fc", extra={"x": RF}))
def f11(spark: SparkSession, d: str) -> DataFrame:
    out = B.month_boost(B.season_mask(rule_frame(spark, d), S.ANCHORS))
    return rounded(out.select("date", CATEGORY, "predicted"), "predicted")


@query("F12_pre_holiday_multiplier", sql(f"""
    SELECT x.date, CATEGORY, {rs(f'predicted * {EVENT_FACTOR}')} AS predicted FROM x JOIN h ON h.day = x.date""",
    "fc", "major", extra={"x": RF, "h": AHEAD}))
def f12(spark: SparkSession, d: str) -> DataFrame:
    out = B.pre_holiday_multiplier(rule_frame(spark, d), S.calendar(spark))
    return rounded(out.select("date", CATEGORY, "predicted"), "predicted")


DAY_RULES = (B.DayOverride("brand#3", (22, 23), 0.5, 2.0), B.DayOverride(" Brand#3 ", (23,), 0.0, 1.5),
             B.DayOverride("BRAND#11", (1, 15), 0.25, 1.0), B.DayOverride("BRAND#12", (2, 3), 1.0, 2.0, category="dry"))


@query("F13_day_overrides", sql(f"""
    SELECT CATEGORY, BRAND, {i('day(date)')} AS day, {rs('''sum(CASE
        WHEN BRAND = 'Brand#3' AND day(date) = 22 THEN 5e-1 + predicted * 2
        WHEN BRAND = 'Brand#3' AND day(date) = 23 THEN (5e-1 + predicted * 2) * 15e-1
        WHEN BRAND = 'Brand#11' AND day(date) IN (1, 15) THEN 25e-2 + predicted
        WHEN BRAND = 'Brand#12' AND day(date) IN (2, 3) AND CATEGORY = 'DRY' THEN 1 + predicted * 2 ELSE predicted END)''')} AS predicted
    FROM x GROUP BY ALL""", "fcb", extra={"x": RFB}))
def f13(spark: SparkSession, d: str) -> DataFrame:
    out = B.day_overrides(rule_frame(spark, d, (CATEGORY, BRAND)), DAY_RULES)
    return out.groupBy(CATEGORY, BRAND, F.dayofmonth("date").alias("day")).agg(r(F.sum("predicted")).alias("predicted"))


@query("F14_postprocess_category", sql(f"""SELECT date, CATEGORY, {rs('predicted')} AS predicted FROM ({carried('s4', 'CATEGORY')})""",
    "fc", "closed", extra={
        "x": RF, "s1": f"SELECT date, CATEGORY, actual, {FLOORED} AS predicted FROM x",
        "s2": f"SELECT date, CATEGORY, actual, predicted * CASE WHEN CATEGORY = 'MOONCAKE' AND NOT ({SEASON}) THEN 0 WHEN CATEGORY = 'MOONCAKE' AND month(date) = 8 THEN 2 ELSE 1 END AS predicted FROM s1",
        "s3": "SELECT date, CATEGORY, actual, CASE WHEN CATEGORY = 'MOONCAKE' AND predicted < 2 THEN 0e0 ELSE predicted END AS predicted FROM s2",
        "s4": f"SELECT date, CATEGORY, actual, CASE WHEN {CLOSED} THEN 0e0 ELSE predicted END AS predicted FROM s3"}))
def f14_category(spark: SparkSession, d: str) -> DataFrame:
    out = B.postprocess_category(rule_frame(spark, d), S.calendar(spark), S.ANCHORS)
    return rounded(out.select("date", CATEGORY, "predicted"), "predicted")


@query("F14_postprocess_brand", sql(f"""
    SELECT CATEGORY, BRAND, {i('year(date)')} AS year, {i('month(date)')} AS month, count(*) AS days, {rs('sum(predicted)')} AS predicted
    FROM ({carried('s3', 'CATEGORY, BRAND')}) GROUP BY ALL""",
    "fcb", "closed", "major", extra={
        "x": RFB, "h": AHEAD,
        "s1": f"SELECT date, CATEGORY, BRAND, actual, CASE WHEN {CLOSED} OR isodow(date) = 7 OR predicted < 1 THEN 0e0 ELSE predicted END AS predicted FROM x",
        "s2": f"SELECT s1.* EXCLUDE (predicted), predicted * {EVENT_FACTOR} AS predicted FROM s1 JOIN h ON h.day = s1.date",
        "s3": """SELECT * EXCLUDE (predicted), CASE WHEN BRAND = 'Brand#3' AND day(date) = 22 THEN 5e-1 + predicted * 2
            WHEN BRAND = 'Brand#3' AND day(date) = 23 THEN (5e-1 + predicted * 2) * 15e-1
            WHEN BRAND = 'Brand#11' AND day(date) IN (1, 15) THEN 25e-2 + predicted
        WHEN BRAND = 'Brand#12' AND day(date) IN (2, 3) AND CATEGORY = 'DRY' THEN 1 + predicted * 2 ELSE predicted END AS predicted FROM s2"""}))
def f14_brand(spark: SparkSession, d: str) -> DataFrame:
    out = B.postprocess_brand(rule_frame(spark, d, (CATEGORY, BRAND)), S.calendar(spark), DAY_RULES)
    return out.groupBy(CATEGORY, BRAND, F.year("date").alias("year"), F.month("date").alias("month")).agg(
        F.count("*").alias("days"), r(F.sum("predicted")).alias("predicted"))


@query("F8_month_boundary_signal", sql(f"""
    SELECT ACTUALSHIPDATE, CATEGORY, {sflag('k <= 3 OR day(ACTUALSHIPDATE) <= 5')} AS is_first_5_days,
      {rs('CASE WHEN k <= 3 THEN 1e0 ELSE exp(-3e-1 * (day(ACTUALSHIPDATE) - 1)) END')} AS post_peak_signal,
      {i(f'CASE WHEN {dow()} NOT IN (2, 4) THEN 0 WHEN k <= 3 THEN -2 WHEN day(ACTUALSHIPDATE) <= 5 THEN -5 WHEN day(ACTUALSHIPDATE) <= 10 THEN -2 ELSE 0 END')} AS "is_high_vol_weekday_AND_early_month"
    FROM (SELECT *, row_number() OVER (PARTITION BY CATEGORY ORDER BY ACTUALSHIPDATE DESC) AS k FROM dense)""", "dense"))
def f8(spark: SparkSession, d: str) -> DataFrame:
    tier = K.weekday_tier(DATE)
    rows = S.dense(spark, d, measures=()).withColumns(tier)
    rows = rows.withColumns(K.early_month(DATE, F.col("is_high_volume_weekday")))
    out = B.month_boundary_signal(rows, [CATEGORY])
    return out.select(DATE, CATEGORY, "is_first_5_days", r("post_peak_signal").alias("post_peak_signal"),
                      "is_high_vol_weekday_AND_early_month")


@query("F6_warm_up", sql(f"""
    SELECT w.ACTUALSHIPDATE, w.CATEGORY, {rs('CASE WHEN t.total <= 1 AND l.v > 0 THEN l.v ELSE w.v END')} AS "Total CBM"
    FROM (SELECT ACTUALSHIPDATE, CATEGORY, CASE WHEN CATEGORY = 'MOONCAKE' THEN 0e0 ELSE {V} END AS v FROM dense
          WHERE ACTUALSHIPDATE > DATE '2001-06-30' AND ACTUALSHIPDATE <= DATE '2001-07-28') w
    JOIN (SELECT CATEGORY, sum(abs(CASE WHEN CATEGORY = 'MOONCAKE' THEN 0e0 ELSE {V} END)) AS total FROM dense
          WHERE ACTUALSHIPDATE > DATE '2001-06-30' AND ACTUALSHIPDATE <= DATE '2001-07-28' GROUP BY 1) t USING (CATEGORY)
    LEFT JOIN (SELECT min_by({V}, ACTUALSHIPDATE) AS v, CATEGORY, {pos('ACTUALSHIPDATE')} AS p FROM dense
          WHERE year(ACTUALSHIPDATE) = 2000 GROUP BY 2, 3) l ON l.CATEGORY = w.CATEGORY AND l.p = {pos('w.ACTUALSHIPDATE')}""", "dense"))
def f6(spark: SparkSession, d: str) -> DataFrame:
    """The seasonal category has an empty window; the others keep theirs."""
    history = S.dense(spark, d)
    v = F.when(F.col(CATEGORY) == "MOONCAKE", F.lit(0.0)).otherwise(F.col(f"`{CBM}`"))
    window = history.filter((F.col(DATE) > F.lit("2001-06-30").cast("date"))
                            & (F.col(DATE) <= F.lit("2001-07-28").cast("date"))).select(DATE, CATEGORY, v.alias(CBM))
    return rounded(H.warm_up(window, history, anchors=S.ANCHORS), CBM)


# ---------------------------------------------------------------- fitted forecasts (rows only)

TRAIN_END, FORECAST_START, FORECAST_END = "2000-12-31", "2001-01-01", "2001-03-31"


def fitted(spark: SparkSession, d: str, weight=None) -> tuple[X.DirectModel, DataFrame]:
    rows = S.dense(spark, d)
    train = rows.filter(F.col(DATE) <= F.lit(TRAIN_END).cast("date"))
    return X.fit_direct(train, weight=weight), rows


@query("F2_fit_direct")
def f2(spark: SparkSession, d: str) -> DataFrame:
    """Coefficients of the pooled model with label-date weights, next to each key's scale."""
    model, _ = fitted(spark, d, F.when(F.dayofmonth("date") <= 5, F.lit(3.0)).otherwise(F.lit(1.0)))
    return model.scaler.withColumns({
        "features": F.lit(len(model.model.coefficients)), "intercept": F.lit(float(model.model.intercept)),
        "weight_of_yesterday": F.lit(float(model.model.coefficients[model.inputs - 1]))})


@query("F4_forecast_direct")
def f4(spark: SparkSession, d: str) -> DataFrame:
    model, rows = fitted(spark, d)
    return X.forecast_direct(model, rows, FORECAST_START, "2001-01-31")


@query("F5_forecast_rolling_monthly")
def f5(spark: SparkSession, d: str) -> DataFrame:
    model, rows = fitted(spark, d)
    raw = X.forecast_rolling_monthly(model, rows, FORECAST_START, FORECAST_END)
    return B.postprocess_category(raw, S.calendar(spark), S.ANCHORS)


@query("F7_teacher_forcing_eval")
def f7(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.scoring import mae, rmse

    model, rows = fitted(spark, d)
    test = rows.filter(F.col(DATE) > F.lit(TRAIN_END).cast("date"))
    scored = X.teacher_forcing_eval(model, test)
    return scored.groupBy(CATEGORY, "horizon_step").agg(F.count("*").alias("windows"), mae().alias("mae"),
                                                        rmse().alias("rmse"))
