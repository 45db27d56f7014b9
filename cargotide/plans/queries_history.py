"""Queries: joins between forecasts, actuals and history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..columns import BRAND, CATEGORY, CBM, DATE
from ..functions import calendar as K
from ..operators import events as E, history as H, stats
from ..sources.calendars import holiday_dates
from . import shipments as S
from .catalog import query, rounded
from .queries_calendar import TIER
from .queries_forecast import forecast_frame
from .queries_series import CYC, OFFS, lunar_match
from .sqltext import V, r as rs, sql


def _attach(missing: str) -> None:
    fill = "coalesce(a.v, 0e0)" if missing == "zero" else "a.v"
    text = sql(f"""
        SELECT f.date, f.CATEGORY, {rs('f.predicted')} AS predicted, {rs(fill)} AS actual, {rs(f'f.predicted - {fill}')} AS error,
          {rs(f'abs(f.predicted - {fill})')} AS abs_error
        FROM fc f LEFT JOIN (SELECT ACTUALSHIPDATE AS date, CATEGORY, sum({V}) AS v FROM panel
          WHERE day(ACTUALSHIPDATE) <> 13 GROUP BY ALL) a USING (date, CATEGORY)""", "fc", "panel")

    @query(f"J3_attach_actuals_{missing}", text)
    def j3(spark: SparkSession, d: str) -> DataFrame:
        """Actuals of the 13th of each month are missing; the panel has many rows per day."""
        actuals = S.panel(spark, d).filter(F.dayofmonth(DATE) != 13)
        out = H.attach_actuals(forecast_frame(spark, d).drop("actual"), actuals, missing=missing)
        return rounded(out.select("date", CATEGORY, "predicted", "actual", "error", "abs_error"),
                       "predicted", "actual", "error", "abs_error")


_attach("zero")
_attach("null")


def day_flags(spark: SparkSession, rows: DataFrame, date: str) -> DataFrame:
    """Month-end, holiday and near-holiday flags of the days of a frame."""
    cal = S.calendar(spark)
    out = E.flag_membership(rows.withColumns(K.end_of_month(date)), holiday_dates(cal, "model"), "holiday_indicator", date)
    return E.pre_holiday_surge(out, cal, date)


def spike_frame(spark: SparkSession, d: str) -> DataFrame:
    """Forecast rows with spikes, reasons and the split they belong to."""
    rows = stats.spike_flags(forecast_frame(spark, d), "actual", 0.8)
    split = F.when(F.year("date") < 2000, "train").when(F.year("date") == 2000, "val").otherwise("test")
    rows = rows.withColumn("split", split)
    days = rows.select(F.col("date").alias(DATE)).distinct()
    return H.attach_spike_reason(rows, stats.spike_reasons(day_flags(spark, days, DATE)))


SPIKE = f"""SELECT f.*, actual > (SELECT quantile_cont(actual, 8e-1) FROM fc) AS is_spike,
    CASE WHEN actual > (SELECT quantile_cont(actual, 8e-1) FROM fc) THEN
      CASE WHEN date > last_day(date) - 3 THEN 'EOM_rush' WHEN date IN (SELECT date FROM observed) OR ({TIER}) <> 0 THEN 'holiday_effect' END END AS spike_reason,
    CASE WHEN year(date) < 2000 THEN 'train' WHEN year(date) = 2000 THEN 'val' ELSE 'test' END AS split
    FROM fc f JOIN days ON days.day = f.date"""


@query("E16_spike_flags", sql("SELECT date, CATEGORY, is_spike, spike_reason FROM x", "fc", "days", extra={"x": SPIKE}))
def e16(spark: SparkSession, d: str) -> DataFrame:
    return spike_frame(spark, d).select("date", CATEGORY, "is_spike", "spike_reason")


@query("E16_spike_flags_per_key", sql(f"""
    SELECT ACTUALSHIPDATE, CATEGORY, {V} > quantile_cont({V}, 8e-1) OVER (PARTITION BY CATEGORY) AS is_spike FROM dense""", "dense"))
def e16_key(spark: SparkSession, d: str) -> DataFrame:
    return stats.spike_flags(S.dense(spark, d), CBM, 0.8, [CATEGORY]).select(DATE, CATEGORY, "is_spike")


@query("J11_attach_spike_reason", sql("""
    SELECT split, spike_reason, is_spike, count(*) AS rows FROM x GROUP BY ALL""", "fc", "days", extra={"x": SPIKE}))
def j11(spark: SparkSession, d: str) -> DataFrame:
    return spike_frame(spark, d).groupBy("split", "spike_reason", "is_spike").agg(F.count("*").alias("rows"))


@query("A14_spike_labels", sql("""
    SELECT date, split, bool_or(is_spike) AS is_spike, min(spike_reason) AS spike_reason FROM x GROUP BY ALL""",
    "fc", "days", extra={"x": SPIKE}))
def a14(spark: SparkSession, d: str) -> DataFrame:
    return stats.spike_labels(spike_frame(spark, d))


@query("J12_split_by_presence", sql("""
    SELECT k.CATEGORY, k.BRAND, k.BRAND || k.CATEGORY IN (SELECT BRAND || CATEGORY FROM panel WHERE ACTUALSHIPDATE < DATE '1995-02-01') AS present
    FROM (SELECT DISTINCT CATEGORY, BRAND FROM panel) k""", "panel"))
def j12(spark: SparkSession, d: str) -> DataFrame:
    """Series already seen in the first month against those that appear later."""
    rows = S.panel(spark, d)
    keys = rows.select(CATEGORY, BRAND).distinct()
    early = rows.filter(F.col(DATE) < F.lit("1995-02-01").cast("date"))
    have, lack = H.split_by_presence(keys, early, [CATEGORY, BRAND])
    return have.withColumn("present", F.lit(True)).unionByName(lack.withColumn("present", F.lit(False)))


@query("J13_merge_history", sql(f"""
    SELECT CATEGORY, ACTUALSHIPDATE, {rs(f'CASE WHEN ACTUALSHIPDATE >= DATE {chr(39)}2000-06-01{chr(39)} THEN {V} * 2 ELSE {V} END')} AS "Total CBM"
    FROM dense""", "dense"))
def j13(spark: SparkSession, d: str) -> DataFrame:
    """History up to the end of 2000, recent rows from June 2000 on with twice the volume."""
    rows = S.dense(spark, d)
    day = F.col(DATE)
    history = rows.filter(day <= F.lit("2000-12-31").cast("date"))
    recent = rows.filter(day >= F.lit("2000-06-01").cast("date")).select(
        CATEGORY, DATE, (F.col(f"`{CBM}`") * 2).alias(CBM))
    return rounded(H.merge_history(history, recent), CBM)


@query("J14_yoy_for_forecast", sql(f"""
    SELECT a.ACTUALSHIPDATE, a.CATEGORY, {rs('coalesce(m1.v, 0e0)')} AS cbm_last_year, {rs('coalesce(m2.v, 0e0)')} AS cbm_2_years_ago
    FROM daily a LEFT JOIN m1 ON m1.d = a.ACTUALSHIPDATE AND m1.c = a.CATEGORY LEFT JOIN m2 ON m2.d = a.ACTUALSHIPDATE AND m2.c = a.CATEGORY
    WHERE year(a.ACTUALSHIPDATE) = 2001""",
    "daily", extra={"cyc": CYC, "offs": OFFS, "m1": lunar_match("daily", 1), "m2": lunar_match("daily", 2)}))
def j14(spark: SparkSession, d: str) -> DataFrame:
    """The year 2001 is the future."""
    rows = S.daily(spark, d)
    out = H.yoy_for_forecast(rows.filter(F.year(DATE) < 2001), rows.filter(F.year(DATE) == 2001), anchors=S.ANCHORS)
    return rounded(out.select(DATE, CATEGORY, "cbm_last_year", "cbm_2_years_ago"), "cbm_last_year", "cbm_2_years_ago")
