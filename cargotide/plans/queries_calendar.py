"""Queries: calendar, lunar and event features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..columns import CATEGORY, CBM, DATE, QTY
from ..functions import calendar as K, lunar as L, measures
from ..operators import events as E, sampling, stats
from ..sources import calendars as Cal
from . import shipments as S
from .catalog import query, r, rounded
from .queries_panel import SPLIT_SQL
from .sqltext import FAR, Q, V, dow, flag as sflag, i, pos, r as rs, sql

HEAD = "ACTUALSHIPDATE, CATEGORY"


def base(spark: SparkSession, d: str, measures=()) -> DataFrame:
    """Gap-free days per category."""
    return S.dense(spark, d, measures=measures)


def with_features(rows: DataFrame, features: K.Features, *floats: str) -> DataFrame:
    return rounded(rows.select(DATE, CATEGORY).withColumns(features), *floats)


def wave(expr: str, period: int, name: str) -> str:
    angle = f"2 * pi() * ({expr}) / {period}e0"
    return f"{rs(f'sin({angle})')} AS {name}_sin, {rs(f'cos({angle})')} AS {name}_cos"


@query("C1_temporal_cyclic", sql(f"""SELECT {HEAD}, {wave('month(ACTUALSHIPDATE) - 1', 12, 'month')},
    {wave('day(ACTUALSHIPDATE) - 1', 31, 'dayofmonth')} FROM dense""", "dense"))
def c1(spark: SparkSession, d: str) -> DataFrame:
    f = K.temporal_cyclic(DATE)
    return with_features(base(spark, d), f, *f)


@query("C2_weekend", sql(f"SELECT {HEAD}, {dow()} AS day_of_week, {sflag('isodow(ACTUALSHIPDATE) >= 6')} AS is_weekend FROM dense", "dense"))
def c2(spark: SparkSession, d: str) -> DataFrame:
    return with_features(base(spark, d), K.weekend(DATE))


@query("C3_dow_cyclic", sql(f"SELECT {HEAD}, {wave('isodow(ACTUALSHIPDATE) - 1', 7, 'day_of_week')} FROM dense", "dense"))
def c3(spark: SparkSession, d: str) -> DataFrame:
    f = K.dow_cyclic(DATE)
    return with_features(base(spark, d), f, *f)


@query("C4_is_monday", sql(f"""SELECT {HEAD}, {sflag("dayname(ACTUALSHIPDATE) = 'Monday'")} AS "Is_Monday" FROM dense""", "dense"))
def c4(spark: SparkSession, d: str) -> DataFrame:
    return with_features(base(spark, d), K.is_monday(DATE))


DN = "dayname(ACTUALSHIPDATE)"


@query("C5_weekday_tier", sql(f"""
    SELECT {HEAD}, {i(f'''CASE WHEN CATEGORY = 'FRESH' THEN CASE {DN} WHEN 'Monday' THEN 6 WHEN 'Wednesday' THEN 5 WHEN 'Friday' THEN 5
        WHEN 'Tuesday' THEN 0 WHEN 'Thursday' THEN 0 ELSE -3 END
      ELSE CASE {DN} WHEN 'Wednesday' THEN 2 WHEN 'Friday' THEN 1 WHEN 'Tuesday' THEN 0 WHEN 'Thursday' THEN 0 ELSE -1 END END''')} AS weekday_volume_tier,
      {sflag(f"{DN} IN ('Wednesday', 'Friday') OR (CATEGORY = 'FRESH' AND {DN} = 'Monday')")} AS is_high_volume_weekday
    FROM dense""", "dense"))
def c5(spark: SparkSession, d: str) -> DataFrame:
    return with_features(base(spark, d), K.by_category(CATEGORY, lambda p: K.weekday_tier(DATE, p)))


@query("C6_end_of_month", sql(f"""
    SELECT {HEAD}, {i("date_diff('day', ACTUALSHIPDATE, last_day(ACTUALSHIPDATE))")} AS days_until_month_end,
      {sflag('ACTUALSHIPDATE > last_day(ACTUALSHIPDATE) - 3')} AS "is_EOM" FROM dense""", "dense"))
def c6(spark: SparkSession, d: str) -> DataFrame:
    return with_features(base(spark, d), K.end_of_month(DATE))


DAY = "day(ACTUALSHIPDATE)"


@query("C7_mid_month_peak", sql(f"""
    SELECT {HEAD}, {i(f'''CASE WHEN CATEGORY = 'FRESH' THEN
        CASE WHEN {DAY} BETWEEN 10 AND 12 THEN 4 WHEN {DAY} = 9 OR {DAY} BETWEEN 13 AND 15 THEN 3 WHEN {DAY} = 8 THEN 2
          WHEN {DAY} BETWEEN 16 AND 18 THEN 1 ELSE 0 END
      ELSE CASE WHEN {DAY} BETWEEN 22 AND 23 THEN 5 WHEN {DAY} IN (21, 24) THEN 4 WHEN {DAY} IN (19, 20) THEN 3
          WHEN {DAY} BETWEEN 25 AND 27 THEN 1 ELSE 0 END END''')} AS mid_month_peak_tier,
      {sflag(f"CASE WHEN CATEGORY = 'FRESH' THEN {DAY} BETWEEN 10 AND 12 ELSE {DAY} BETWEEN 21 AND 24 END")} AS is_mid_month_peak,
      {i(f"{DAY} - CASE WHEN CATEGORY = 'FRESH' THEN 11 ELSE 23 END")} AS days_to_mid_month_peak FROM dense""", "dense"))
def c7(spark: SparkSession, d: str) -> DataFrame:
    return with_features(base(spark, d), K.by_category(CATEGORY, lambda p: K.mid_month_peak(DATE, p)))


@query("C8_early_month", sql(f"""
    SELECT {HEAD}, {i(f'CASE WHEN {DAY} <= 5 THEN -10 WHEN {DAY} <= 10 THEN 1 ELSE 2 END')} AS early_month_low_tier,
      {sflag(f'{DAY} <= 10')} AS is_early_month_low, {sflag(f'{DAY} <= 5')} AS is_first_5_days, {sflag(f'{DAY} <= 3')} AS is_first_3_days,
      {i(f'{DAY} - 1')} AS days_from_month_start, {rs(f'exp(-3e-1 * ({DAY} - 1))')} AS post_peak_signal,
      {i(f"CASE WHEN {DN} NOT IN ('Monday', 'Wednesday', 'Friday') OR {DAY} > 10 THEN 0 WHEN {DAY} <= 5 THEN -5 ELSE -2 END")} AS "is_high_vol_weekday_AND_early_month"
    FROM dense""", "dense"))
def c8(spark: SparkSession, d: str) -> DataFrame:
    return with_features(base(spark, d), K.early_month(DATE), "post_peak_signal")


@query("C8_early_month_with_tier", sql(f"""
    SELECT {HEAD}, {i(f'CASE WHEN {DAY} <= 5 THEN -10 WHEN {DAY} <= 10 THEN 1 ELSE 2 END')} AS early_month_low_tier,
      {sflag(f'{DAY} <= 10')} AS is_early_month_low, {sflag(f'{DAY} <= 5')} AS is_first_5_days, {sflag(f'{DAY} <= 3')} AS is_first_3_days,
      {i(f'{DAY} - 1')} AS days_from_month_start, {rs(f'exp(-3e-1 * ({DAY} - 1))')} AS post_peak_signal,
      {i(f"CASE WHEN NOT ({DN} IN ('Wednesday', 'Friday') OR (CATEGORY = 'FRESH' AND {DN} = 'Monday')) OR {DAY} > 10 THEN 0 WHEN {DAY} <= 5 THEN -5 ELSE -2 END")} AS "is_high_vol_weekday_AND_early_month"
    FROM dense""", "dense"))
def c8_tier(spark: SparkSession, d: str) -> DataFrame:
    """With the busy weekdays of each category's profile."""
    tier = K.by_category(CATEGORY, lambda p: K.weekday_tier(DATE, p))
    rows = base(spark, d).select(DATE, CATEGORY).withColumns(tier)
    f = K.early_month(DATE, F.col("is_high_volume_weekday"))
    return rounded(rows.withColumns(f).select(DATE, CATEGORY, *f), "post_peak_signal")


@query("C9_lunar_date", sql(f"""SELECT {HEAD}, {i(f"{pos('ACTUALSHIPDATE')} // 30 + 1")} AS lunar_month,
    {i(f"{pos('ACTUALSHIPDATE')} % 30 + 1")} AS lunar_day FROM dense""", "dense"))
def c9(spark: SparkSession, d: str) -> DataFrame:
    return with_features(base(spark, d), L.lunar_date(DATE, S.ANCHORS))


def lunar_base(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d).withColumns(L.lunar_date(DATE, S.ANCHORS))


LUNAR = "dense JOIN lunar ON lunar.day = ACTUALSHIPDATE"


@query("C10_lunar_cyclic", sql(f"""SELECT {HEAD}, {wave('lm - 1', 12, 'lunar_month')}, {wave('ld - 1', 30, 'lunar_day')}
    FROM {LUNAR}""", "dense", "lunar"))
def c10(spark: SparkSession, d: str) -> DataFrame:
    f = L.lunar_cyclic()
    return rounded(lunar_base(spark, d).withColumns(f).select(DATE, CATEGORY, *f), *f)


@query("C11_gregorian_for_lunar", sql(f"""
    SELECT x.day, {i('year(x.day) + 1')} AS target_year, min(c.day) AS found FROM lunar x
    JOIN (SELECT day, {pos('day')} AS p FROM (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '2002-12-31', INTERVAL 1 DAY)) AS DATE) AS day)) c
      ON year(c.day) = year(x.day) + 1 AND c.p = x.p GROUP BY ALL""", "lunar"))
def c11(spark: SparkSession, d: str) -> DataFrame:
    """For every shipping day, the date with the same lunar date in the next year."""
    days = lunar_base(spark, d).select(DATE, "lunar_month", "lunar_day").distinct()
    year = F.year(DATE) + 1
    return days.select(F.col(DATE).alias("day"), year.alias("target_year"),
                       L.gregorian_for_lunar("lunar_month", "lunar_day", year, S.ANCHORS).alias("found"))


@query("C12_high_volume_month", sql(f"""
    SELECT {HEAD}, {i('month(ACTUALSHIPDATE)')} AS month,
      {i('CASE WHEN lm = 12 THEN 0 WHEN month(ACTUALSHIPDATE) = 12 OR lm IN (7, 8) THEN 2 ELSE 1 END')} AS high_volume_month_tier,
      {sflag('month(ACTUALSHIPDATE) = 12 OR lm IN (7, 8)')} AS is_high_volume_month, {sflag('lm = 12')} AS is_low_volume_month
    FROM {LUNAR}""", "dense", "lunar"))
def c12(spark: SparkSession, d: str) -> DataFrame:
    f = K.high_volume_month(DATE)
    return lunar_base(spark, d).withColumns(f).select(DATE, CATEGORY, *f)


DAYS = "dense JOIN days ON days.day = ACTUALSHIPDATE"


@query("C13_holiday_features", sql(f"""
    SELECT {HEAD}, {sflag('ACTUALSHIPDATE IN (SELECT date FROM observed)')} AS holiday_indicator,
      {i('i_next')} AS days_until_next_holiday, {i('i_last')} AS days_since_holiday FROM {DAYS}""", "dense", "days", "observed"))
def c13(spark: SparkSession, d: str) -> DataFrame:
    holidays = Cal.holiday_dates(S.calendar(spark), "model")
    return E.holiday_features(base(spark, d).select(DATE, CATEGORY), holidays)


US_SQL = """SELECT y, make_date(y, 1, 1) AS date FROM ys UNION ALL SELECT y, make_date(y, 7, 4) FROM ys
    UNION ALL SELECT y, make_date(y, 11, 11) FROM ys UNION ALL SELECT y, make_date(y, 12, 25) FROM ys
    UNION ALL SELECT year(day), day FROM yd WHERE isodow(day) = 1 AND month(day) IN (1, 2) AND day(day) BETWEEN 15 AND 21
    UNION ALL SELECT year(day), day FROM yd WHERE isodow(day) = 1 AND month(day) = 5 AND day(day) >= 25
    UNION ALL SELECT year(day), day FROM yd WHERE isodow(day) = 1 AND month(day) = 9 AND day(day) <= 7
    UNION ALL SELECT year(day), day FROM yd WHERE isodow(day) = 1 AND month(day) = 10 AND day(day) BETWEEN 8 AND 14
    UNION ALL SELECT year(day), day FROM yd WHERE isodow(day) = 4 AND month(day) = 11 AND day(day) BETWEEN 22 AND 28"""


@query("C14_us_holidays", sql(f"""
    SELECT {HEAD}, {sflag('ACTUALSHIPDATE IN (SELECT date FROM us)')} AS holiday_indicator,
      {i(f"coalesce(date_diff('day', ACTUALSHIPDATE, (SELECT min(u.date) FROM us u WHERE u.date > ACTUALSHIPDATE)), {FAR})")} AS days_until_next_holiday
    FROM dense""", "dense", extra={
        "ys": "SELECT DISTINCT CAST(year(ACTUALSHIPDATE) AS BIGINT) AS y FROM dense",
        "yd": "SELECT CAST(unnest(generate_series(make_date(min(y), 1, 1), make_date(max(y), 12, 31), INTERVAL 1 DAY)) AS DATE) AS day FROM ys",
        "us": US_SQL}))
def c14(spark: SparkSession, d: str) -> DataFrame:
    """Holidays of the years seen in the data; flag and days to the next."""
    rows = base(spark, d).select(DATE, CATEGORY)
    us = Cal.us_holidays(rows.select(F.year(DATE).alias("year")).distinct()).select("date")
    return E.next_event(E.flag_membership(rows, us, "holiday_indicator"), us, "days_until_next_holiday")


@query("C15_vietnam_holidays", sql(f"""
    SELECT d.CATEGORY, c.date, {rs(f'd.{V}')} AS cbm FROM dense d
    JOIN (SELECT DISTINCT date FROM cal WHERE kind = 'business' AND date BETWEEN DATE '1996-06-01' AND DATE '2000-03-31') c
      ON c.date = d.ACTUALSHIPDATE""", "dense", "cal"))
def c15(spark: SparkSession, d: str) -> DataFrame:
    """Volume on the closed days of a range."""
    closed = Cal.holiday_dates(S.calendar(spark), "business", "1996-06-01", "2000-03-31")
    return base(spark, d, (CBM,)).join(F.broadcast(closed), F.col(DATE) == F.col("date")).select(CATEGORY, "date", r(CBM).alias("cbm"))


@query("C16_days_to_tet", sql(f"SELECT {HEAD}, {i('tet')} AS days_to_tet FROM {DAYS}", "dense", "days"))
def c16(spark: SparkSession, d: str) -> DataFrame:
    return E.days_to_tet(base(spark, d).select(DATE, CATEGORY), S.calendar(spark))


@query("C17_days_to_mid_autumn", sql(f"""
    SELECT {HEAD}, {i(f'''CASE WHEN lunar.lm < 8 THEN (8 - lunar.lm) * 30 + 15 - lunar.ld WHEN lunar.lm = 8 AND lunar.ld <= 15 THEN 15 - lunar.ld
      WHEN next_autumn IS NOT NULL THEN next_autumn WHEN lunar.lm = 8 THEN {FAR} ELSE (20 - lunar.lm) * 30 + 15 - lunar.ld END''')} AS days_to_mid_autumn
    FROM {DAYS} JOIN lunar ON lunar.day = ACTUALSHIPDATE""", "dense", "lunar"))
def c17(spark: SparkSession, d: str) -> DataFrame:
    out = E.days_to_mid_autumn(lunar_base(spark, d), S.calendar(spark))
    return out.select(DATE, CATEGORY, "days_to_mid_autumn")


TIER = """CASE WHEN near BETWEEN 1 AND 3 THEN 3 WHEN near BETWEEN 4 AND 7 THEN 2 WHEN near BETWEEN 8 AND 10 THEN 1 ELSE 0 END"""
FRESH_TIER = """CASE WHEN abs(near) BETWEEN 1 AND 3 THEN 3 WHEN abs(near) BETWEEN 4 AND 7 THEN 2 WHEN abs(near) BETWEEN 8 AND 10 THEN 1 ELSE 0 END
    * CASE WHEN near > 0 THEN -1 ELSE 1 END"""


@query("C18_pre_holiday_surge", sql(f"""
    SELECT {HEAD}, {i(f"CASE WHEN CATEGORY = 'FRESH' THEN {FRESH_TIER} ELSE {TIER} END")} AS pre_holiday_surge_tier,
      {sflag(f"CASE WHEN CATEGORY = 'FRESH' THEN {FRESH_TIER} ELSE {TIER} END <> 0")} AS is_pre_holiday_surge FROM {DAYS}""", "dense", "days"))
def c18(spark: SparkSession, d: str) -> DataFrame:
    return E.pre_holiday_surge(base(spark, d).select(DATE, CATEGORY), S.calendar(spark), pattern=None)


GOLD = {"gregorian_august": "month(ACTUALSHIPDATE) = 8",
        "lunar_0615_0801": "((lm = 6 AND ld >= 15) OR lm = 7 OR (lm = 8 AND ld <= 1))"}
FESTIVAL = "(CASE year(ACTUALSHIPDATE) " + " ".join(f"WHEN {y} THEN DATE '{a}'" for y, a in S.ANCHORS.items()) + " END)"
ACTIVE = {"lunar_gregorian": "lm BETWEEN 7 AND 9 AND month(ACTUALSHIPDATE) BETWEEN 7 AND 9", "lunar_6_9": "lm BETWEEN 6 AND 9",
          "mid_autumn_window": f"date_diff('day', {FESTIVAL}, ACTUALSHIPDATE) BETWEEN -66 AND 15"}


def _season(rule: str, golden: str) -> None:
    text = sql(f"""SELECT {HEAD},
      {sflag(f"(CATEGORY = 'MOONCAKE' AND {ACTIVE[rule]}) OR (CATEGORY = 'TET' AND tet <= 45)")} AS is_active_season,
      {sflag(f"CATEGORY = 'MOONCAKE' AND {GOLD[golden]}")} AS is_golden_window,
      {sflag("CATEGORY = 'MOONCAKE' AND ((lm = 7 AND ld >= 15) OR (lm = 8 AND ld <= 15))")} AS is_peak_loss_window,
      {i(f'''CASE CATEGORY WHEN 'TET' THEN tet WHEN 'MOONCAKE' THEN CASE WHEN lm = 8 THEN abs(ld - 15)
        WHEN lm < 8 THEN (8 - lm) * 30 + 15 - ld ELSE (lm - 8) * 30 + ld - 15 END ELSE {FAR} END''')} AS days_until_peak
      FROM {DAYS} JOIN lunar ON lunar.day = ACTUALSHIPDATE""", "dense", "lunar")

    @query(f"C19_season_window_{rule}", text)
    def c19(spark: SparkSession, d: str) -> DataFrame:
        rows = E.days_to_tet(lunar_base(spark, d), S.calendar(spark))
        f = L.season_window(DATE, rule=rule, golden_rule=golden, anchors=S.ANCHORS)
        return rows.withColumns(f).select(DATE, CATEGORY, *f)


_season("lunar_gregorian", "gregorian_august")
_season("lunar_6_9", "lunar_0615_0801")
_season("mid_autumn_window", "gregorian_august")


@query("C20_days_until_lunar_0801", sql(f"""
    SELECT {HEAD}, {i('''CASE WHEN lm < 8 THEN (8 - lm) * 30 - ld + 1 WHEN lm = 8 AND ld = 1 THEN 0
      ELSE (20 - lm) * 30 - ld + 1 END''')} AS days_until_lunar_08_01 FROM {LUNAR}""", "dense", "lunar"))
def c20(spark: SparkSession, d: str) -> DataFrame:
    f = L.days_until_lunar_0801()
    return lunar_base(spark, d).withColumns(f).select(DATE, CATEGORY, *f)


@query("C21_is_august", sql(f"SELECT {HEAD}, {sflag('monthname(ACTUALSHIPDATE) = ' + repr('August'))} AS is_august FROM dense", "dense"))
def c21(spark: SparkSession, d: str) -> DataFrame:
    return with_features(base(spark, d), K.is_august(DATE))


@query("C22_density", sql(f"""
    SELECT {HEAD}, {rs(f'least(1e0, greatest(0e0, coalesce({V}, 0e0) / CASE WHEN coalesce({Q}, 0) = 0 THEN 1e-3 ELSE {Q} END))')} AS cbm_per_qty
    FROM dense""", "dense"))
def c22(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d, (QTY, CBM)).select(DATE, CATEGORY, r(measures.density(CBM, QTY)).alias("cbm_per_qty"))


STATUS = f"""CASE WHEN ACTUALSHIPDATE IN (SELECT date FROM closed) THEN 'Holiday_OFF' WHEN isodow(ACTUALSHIPDATE) = 7 THEN 'Weekend_Downtime'
    WHEN coalesce({V}, 0) = 0 THEN 'Operational_Anomaly' ELSE 'Business_Day_Normal' END"""


@query("C23_operational_status", sql(f"""
    SELECT {HEAD}, s AS operational_status, {rs(f'coalesce({V}, 0e0)')} AS "Total CBM",
      {sflag("s IN ('Holiday_OFF', 'Weekend_Downtime')")} AS is_expected_zero, {sflag("s = 'Operational_Anomaly'")} AS is_operational_anomaly
    FROM (SELECT *, {STATUS} AS s FROM dense)""", "dense", "closed"))
def c23(spark: SparkSession, d: str) -> DataFrame:
    out = E.operational_status(base(spark, d, (CBM,)), S.calendar(spark), CBM)
    return rounded(out.select(DATE, CATEGORY, "operational_status", F.col(f"`{CBM}`"), "is_expected_zero",
                              "is_operational_anomaly"), CBM)


@query("C24_scale_unscale", sql(f"""
    SELECT {HEAD}, {rs('(v - mean) / std')} AS scaled, {rs('v')} AS unscaled FROM (SELECT ACTUALSHIPDATE, CATEGORY, {V} AS v FROM dense)
    JOIN (SELECT CATEGORY, avg({V}) AS mean, stddev_pop({V}) AS std FROM s WHERE split = 'train' GROUP BY 1) USING (CATEGORY)""",
    "dense", extra={"s": SPLIT_SQL}))
def c24(spark: SparkSession, d: str) -> DataFrame:
    rows = base(spark, d, (CBM,))
    scaler = stats.fit_scaler(sampling.temporal_split(rows).filter(F.col("split") == "train"))
    out = rows.join(scaler, CATEGORY).withColumn("scaled", measures.scale(CBM, "mean", "std"))
    return out.select(DATE, CATEGORY, r("scaled").alias("scaled"), r(measures.unscale("scaled", "mean", "std")).alias("unscaled"))


# ---------------------------------------------------------------- event lookups on their own

@query("J7_next_event", sql(f"""
    SELECT {HEAD}, {i(f"coalesce(date_diff('day', ACTUALSHIPDATE, (SELECT min(date) FROM closed c WHERE c.date > ACTUALSHIPDATE)), {FAR})")} AS strict_days,
      {i(f"coalesce(date_diff('day', ACTUALSHIPDATE, (SELECT min(date) FROM closed c WHERE c.date >= ACTUALSHIPDATE)), {FAR})")} AS inclusive_days
    FROM dense""", "dense", "closed"))
def j7(spark: SparkSession, d: str) -> DataFrame:
    closed = Cal.holiday_dates(S.calendar(spark), "business")
    rows = E.next_event(base(spark, d).select(DATE, CATEGORY), closed, "strict_days")
    return E.next_event(rows, closed, "inclusive_days", strict=False)


@query("J8_last_event", sql(f"""
    SELECT {HEAD}, {i(f"coalesce(date_diff('day', (SELECT max(date) FROM closed c WHERE c.date <= ACTUALSHIPDATE), ACTUALSHIPDATE), {FAR})")} AS days_all,
      {i(f"coalesce(date_diff('day', (SELECT max(date) FROM closed c WHERE c.date <= ACTUALSHIPDATE AND c.date >= lo), ACTUALSHIPDATE), {FAR})")} AS days_in_frame
    FROM (SELECT *, (SELECT min(ACTUALSHIPDATE) FROM dense) AS lo FROM dense)""", "dense", "closed"))
def j8(spark: SparkSession, d: str) -> DataFrame:
    closed = Cal.holiday_dates(S.calendar(spark), "business")
    rows = E.last_event(base(spark, d).select(DATE, CATEGORY), closed, "days_all")
    return E.last_event(rows, closed, "days_in_frame", lookback_days=0)


@query("J9_nearest_event", sql(f"SELECT {HEAD}, {i('near')} AS distance FROM {DAYS}", "dense", "days"))
def j9(spark: SparkSession, d: str) -> DataFrame:
    return E.nearest_event(base(spark, d).select(DATE, CATEGORY), Cal.major_events(S.calendar(spark)), "distance")


@query("J10_flag_membership", sql(f"SELECT {HEAD}, {sflag('ACTUALSHIPDATE IN (SELECT date FROM closed)')} AS closed FROM dense", "dense", "closed"))
def j10(spark: SparkSession, d: str) -> DataFrame:
    return E.flag_membership(base(spark, d).select(DATE, CATEGORY), Cal.holiday_dates(S.calendar(spark), "business"), "closed")
