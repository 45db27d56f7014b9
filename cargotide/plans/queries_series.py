"""Queries: windows over the daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..columns import BRAND, CATEGORY, CBM, DATE, PANEL_KEYS, QTY
from ..operators import events as E, history as H, panel as P, sampling as W, series as O
from . import shipments as S
from .catalog import query, r, rounded
from .queries_calendar import STATUS
from .queries_panel import SPLIT_SQL
from .sqltext import Q, V, i, pos, r as rs, sql

HEAD = "ACTUALSHIPDATE, CATEGORY"
BY = "PARTITION BY CATEGORY ORDER BY ACTUALSHIPDATE"


def trail(n: int, lag: int = 0, value: str = V) -> str:
    return f"avg({value}) OVER ({BY} ROWS BETWEEN {n - 1 + lag} PRECEDING AND {lag if lag else 'CURRENT ROW'}{' PRECEDING' if lag else ''})"


@query("W1_rolling_means", sql(f"""SELECT {HEAD}, {rs(trail(7))} AS rolling_mean_7d, {rs(trail(30))} AS rolling_mean_30d FROM dense""", "dense"))
def w1(spark: SparkSession, d: str) -> DataFrame:
    out = O.rolling_means(S.dense(spark, d))
    return rounded(out.select(DATE, CATEGORY, "rolling_mean_7d", "rolling_mean_30d"), "rolling_mean_7d", "rolling_mean_30d")


@query("W1_rolling_means_all_series", sql(f"""
    SELECT WHSEID, CATEGORY, BRAND, {i('year(ACTUALSHIPDATE)')} AS year, count(*) AS rows, {rs('sum(m)')} AS sum_of_means, {rs('max(m)')} AS peak
    FROM (SELECT *, avg({V}) OVER (PARTITION BY WHSEID, CATEGORY, BRAND ORDER BY ACTUALSHIPDATE ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS m FROM panel)
    GROUP BY ALL""", "panel"))
def w1_all(spark: SparkSession, d: str) -> DataFrame:
    """Every warehouse, category and brand series, without the current row."""
    out = O.rolling_means(S.panel(spark, d), (7,), PANEL_KEYS, lag=1)
    return out.groupBy(*PANEL_KEYS, F.year(DATE).alias("year")).agg(
        F.count("*").alias("rows"), r(F.sum("rolling_mean_7d")).alias("sum_of_means"), r(F.max("rolling_mean_7d")).alias("peak"))


@query("W2_momentum", sql(f"SELECT {HEAD}, {rs(trail(3) + ' - ' + trail(14))} AS momentum_3d_vs_14d FROM dense", "dense"))
def w2(spark: SparkSession, d: str) -> DataFrame:
    out = O.momentum(S.dense(spark, d))
    return rounded(out.select(DATE, CATEGORY, "momentum_3d_vs_14d"), "momentum_3d_vs_14d")


YOY = f"""SELECT a.*, coalesce(l1.{V}, 0e0) AS cbm_last_year, coalesce(l2.{V}, 0e0) AS cbm_2_years_ago FROM dense a
    LEFT JOIN dense l1 ON l1.CATEGORY = a.CATEGORY AND year(l1.ACTUALSHIPDATE) = year(a.ACTUALSHIPDATE) - 1
      AND month(l1.ACTUALSHIPDATE) = month(a.ACTUALSHIPDATE) AND day(l1.ACTUALSHIPDATE) = day(a.ACTUALSHIPDATE)
    LEFT JOIN dense l2 ON l2.CATEGORY = a.CATEGORY AND year(l2.ACTUALSHIPDATE) = year(a.ACTUALSHIPDATE) - 2
      AND month(l2.ACTUALSHIPDATE) = month(a.ACTUALSHIPDATE) AND day(l2.ACTUALSHIPDATE) = day(a.ACTUALSHIPDATE)"""


@query("J5_yoy_volume", sql(f"SELECT {HEAD}, {rs('cbm_last_year')} AS cbm_last_year, {rs('cbm_2_years_ago')} AS cbm_2_years_ago FROM y",
                            "dense", extra={"y": YOY}))
def j5(spark: SparkSession, d: str) -> DataFrame:
    out = O.yoy_volume(S.dense(spark, d)).select(DATE, CATEGORY, "cbm_last_year", "cbm_2_years_ago")
    return rounded(out, "cbm_last_year", "cbm_2_years_ago")


@query("W3_trend_vs_yoy", sql(f"""
    SELECT {HEAD}, {rs('m')} AS rolling_mean_21d, {rs('CASE WHEN cbm_last_year > 0 THEN m / cbm_last_year ELSE 1e0 END')} AS trend_vs_yoy_ratio,
      {rs('m - cbm_last_year')} AS trend_vs_yoy_diff FROM (SELECT *, {trail(21)} AS m FROM y)""", "dense", extra={"y": YOY}))
def w3(spark: SparkSession, d: str) -> DataFrame:
    out = O.trend_vs_yoy(O.yoy_volume(S.dense(spark, d)))
    names = ["rolling_mean_21d", "trend_vs_yoy_ratio", "trend_vs_yoy_diff"]
    return rounded(out.select(DATE, CATEGORY, *names), *names)


@query("W4_residual_target", sql(f"""
    SELECT {HEAD}, {rs('base')} AS baseline_for_target, {rs(f'{V} - base')} AS target_residual FROM (
      SELECT *, coalesce(lag(m) OVER ({BY}), m) AS base FROM (SELECT *, {trail(30)} AS m FROM dense))""", "dense"))
def w4(spark: SparkSession, d: str) -> DataFrame:
    out = O.residual_target(O.rolling_means(S.dense(spark, d)))
    names = ["baseline_for_target", "target_residual"]
    return rounded(out.select(DATE, CATEGORY, *names), *names)


@query("W5_carryover_train", sql(f"""
    SELECT m.ACTUALSHIPDATE, m.CATEGORY, {rs(f'''m.{V} + CASE WHEN isodow(m.ACTUALSHIPDATE) = 1 THEN coalesce(
      (SELECT max_by(s.{V}, s.ACTUALSHIPDATE) FROM daily s WHERE s.CATEGORY = m.CATEGORY AND isodow(s.ACTUALSHIPDATE) = 7
        AND s.ACTUALSHIPDATE < m.ACTUALSHIPDATE), 0e0) ELSE 0e0 END''')} AS "Total CBM" FROM daily m""", "daily"))
def w5(spark: SparkSession, d: str) -> DataFrame:
    """On the series with its natural gaps: the latest Sunday may be weeks back."""
    out = O.carryover_train(S.daily(spark, d)).select(DATE, CATEGORY, F.col(f"`{CBM}`"))
    return rounded(out, CBM)


@query("W6_carryover_forecast", sql(f"""
    SELECT m.ACTUALSHIPDATE, m.CATEGORY, {rs(f'''CASE WHEN isodow(m.ACTUALSHIPDATE) = 7 THEN 0e0 WHEN isodow(m.ACTUALSHIPDATE) = 1
      THEN m.{V} + coalesce(s.{V}, 0e0) ELSE m.{V} END''')} AS "Total CBM"
    FROM daily m LEFT JOIN daily s ON s.CATEGORY = m.CATEGORY AND s.ACTUALSHIPDATE = m.ACTUALSHIPDATE - 1""", "daily"))
def w6(spark: SparkSession, d: str) -> DataFrame:
    out = O.carryover_forecast(S.daily(spark, d), value=CBM, date=DATE).select(DATE, CATEGORY, F.col(f"`{CBM}`"))
    return rounded(out, CBM)


@query("W7_moving_average_baseline", sql(f"""
    SELECT {HEAD}, {rs(f'''avg(CASE WHEN s <> 'Operational_Anomaly' THEN {V} END) OVER ({BY} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)''')} AS ma
    FROM (SELECT *, {STATUS} AS s FROM dense)""", "dense", "closed"))
def w7(spark: SparkSession, d: str) -> DataFrame:
    rows = E.operational_status(S.dense(spark, d), S.calendar(spark), CBM)
    out = O.moving_average_baseline(rows)
    return out.select(DATE, CATEGORY, r(f"{CBM}_MA7").alias("ma"))


def window_sql(inputs: int, horizon: int, source: str, keys: str = "CATEGORY", spare: int = 0) -> str:
    """Windows written with list functions."""
    return f"""SELECT {keys}, window_id, label_date, array_to_string(list_transform(x, lambda v: CAST(CAST(round(v * 1000) AS BIGINT) AS VARCHAR)), ',') AS x,
        array_to_string(list_transform(y, lambda v: CAST(CAST(round(v * 1000) AS BIGINT) AS VARCHAR)), ',') AS y FROM (
      SELECT {keys}, {i(f'rn - {inputs}')} AS window_id, lead(ACTUALSHIPDATE) OVER w AS label_date, rn, n,
        list({V}) OVER (w ROWS BETWEEN {inputs - 1} PRECEDING AND CURRENT ROW) AS x,
        list({V}) OVER (w ROWS BETWEEN 1 FOLLOWING AND {horizon} FOLLOWING) AS y
      FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ACTUALSHIPDATE) AS rn, count(*) OVER (PARTITION BY {keys}) AS n FROM {source})
      WINDOW w AS (PARTITION BY {keys} ORDER BY ACTUALSHIPDATE)) WHERE rn >= {inputs} AND rn <= n - {horizon + spare}"""


def _listed(windows: DataFrame, *keys: str) -> DataFrame:
    def text(c):
        return F.array_join(F.transform(c, lambda v: F.round(v * 1000).cast("bigint").cast("string")), ",")

    return windows.select(*keys, "window_id", "label_date", text(F.flatten("x")).alias("x"), text("y").alias("y"))


@query("W8_sliding_windows", sql(window_sql(14, 7, "dense"), "dense"))
def w8(spark: SparkSession, d: str) -> DataFrame:
    return _listed(W.sliding_windows(S.dense(spark, d), 14, 7, [CBM]), CATEGORY)


TOTAL = f"""SELECT 'all' AS series, ACTUALSHIPDATE, sum({V}) AS "Total CBM" FROM panel GROUP BY ALL"""


@query("W9_sliding_windows_ungrouped", sql(window_sql(7, 3, "total", "series", 1), "panel", extra={"total": TOTAL}))
def w9(spark: SparkSession, d: str) -> DataFrame:
    """One series for the whole network: daily totals, so its length is that of the calendar."""
    total = S.panel(spark, d).withColumn("series", F.lit("all"))
    rows = P.aggregate_daily(total, ["series"])
    return _listed(W.sliding_windows(rows, 7, 3, [CBM], keys=["series"], drop_last=True), "series")


@query("W10_explode_windows", sql(f"""
    SELECT CATEGORY, window_id, {i('h')} AS horizon_step, label AS date, {i('day(label)')} AS day_of_month, {rs('actual')} AS actual,
      {rs('predicted')} AS predicted, {rs('predicted - actual')} AS error, {rs('abs(predicted - actual)')} AS abs_error FROM (
      SELECT b.CATEGORY, {i('b.rn - 14')} AS window_id, t.rn - b.rn AS h, t.ACTUALSHIPDATE AS label, t.{V} AS actual, b.m AS predicted
      FROM (SELECT *, {trail(14)} AS m FROM n) b JOIN n t ON t.CATEGORY = b.CATEGORY AND t.rn BETWEEN b.rn + 1 AND b.rn + 3
      WHERE b.rn >= 14 AND b.rn <= b.n - 3)""", "dense",
    extra={"n": f"SELECT *, row_number() OVER ({BY}) AS rn, count(*) OVER (PARTITION BY CATEGORY) AS n FROM dense"}))
def w10(spark: SparkSession, d: str) -> DataFrame:
    """Each window predicts the mean of its inputs for all three steps."""
    windows = W.sliding_windows(S.dense(spark, d), 14, 3, [CBM])
    mean = F.aggregate(F.flatten("x"), F.lit(0.0), lambda a, v: a + v) / 14
    out = W.explode_windows(windows.withColumn("p", F.array_repeat(mean, 3)), "p")
    return rounded(out, "actual", "predicted", "error", "abs_error")


@query("W11_temporal_split", sql(f"SELECT {HEAD}, split FROM s", "dense", extra={"s": SPLIT_SQL}))
def w11(spark: SparkSession, d: str) -> DataFrame:
    return W.temporal_split(S.dense(spark, d)).select(DATE, CATEGORY, "split")


@query("W12_random_split", sql("""
    SELECT CATEGORY, split, count(*) AS rows, min(ACTUALSHIPDATE) AS first_date, max(ACTUALSHIPDATE) AS last_date
    FROM (SELECT *, CASE WHEN place <= floor(7e-1 * n) THEN 'train' WHEN place <= floor(7e-1 * n) + floor(1e-1 * n) THEN 'val' ELSE 'test' END AS split
      FROM (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('42|' || CATEGORY || '|' || CAST(ACTUALSHIPDATE AS VARCHAR)), CATEGORY, ACTUALSHIPDATE) AS place
        FROM dense)) GROUP BY ALL""", "dense"))
def w12(spark: SparkSession, d: str) -> DataFrame:
    rows = W.random_split(S.dense(spark, d))
    return rows.groupBy(CATEGORY, "split").agg(F.count("*").alias("rows"), F.min(DATE).alias("first_date"),
                                               F.max(DATE).alias("last_date"))


@query("W13_fill_gaps", sql(f"""
    SELECT {HEAD}, {rs(f'coalesce(last_value(g IGNORE NULLS) OVER ({BY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(g IGNORE NULLS) OVER ({BY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0e0)')} AS filled
    FROM (SELECT *, CASE WHEN day(ACTUALSHIPDATE) > 6 AND CATEGORY <> 'TET' THEN {V} END AS g FROM dense)""", "dense"))
def w13(spark: SparkSession, d: str) -> DataFrame:
    """The first six days of each month are missing, and one category is missing altogether."""
    gaps = F.when((F.dayofmonth(DATE) > 6) & (F.col(CATEGORY) != "TET"), F.col(f"`{CBM}`"))
    rows = S.dense(spark, d).withColumn("g", gaps)
    return rows.select(DATE, CATEGORY, r(O.fill_gaps("g", [CATEGORY])).alias("filled"))


@query("W14_history_window", sql(f"""
    SELECT ACTUALSHIPDATE, WHSEID, CATEGORY, BRAND, {rs(V)} AS cbm FROM panel WHERE ACTUALSHIPDATE IN (
      SELECT DISTINCT ACTUALSHIPDATE FROM panel WHERE ACTUALSHIPDATE <= DATE '2000-08-15' ORDER BY 1 DESC LIMIT 28)""", "panel"))
def w14(spark: SparkSession, d: str) -> DataFrame:
    out = O.history_window(S.panel(spark, d), "2000-08-15", 28)
    return out.select(DATE, *PANEL_KEYS, r(CBM).alias("cbm"))


@query("W14_history_window_per_key", sql(f"""
    SELECT ACTUALSHIPDATE, WHSEID, CATEGORY, BRAND, {rs(V)} AS cbm FROM (SELECT *, dense_rank() OVER (
      PARTITION BY CATEGORY, BRAND ORDER BY ACTUALSHIPDATE DESC) AS k FROM panel WHERE ACTUALSHIPDATE <= DATE '2000-08-15') WHERE k <= 28""", "panel"))
def w14_key(spark: SparkSession, d: str) -> DataFrame:
    out = O.history_window(S.panel(spark, d), "2000-08-15", 28, [CATEGORY, BRAND])
    return out.select(DATE, *PANEL_KEYS, r(CBM).alias("cbm"))


@query("W15_full_month_window", sql(f"""
    SELECT ACTUALSHIPDATE, WHSEID, CATEGORY, BRAND, {rs(V)} AS cbm FROM panel
    WHERE ACTUALSHIPDATE BETWEEN DATE '1999-12-01' AND DATE '2000-01-20'""", "panel"))
def w15(spark: SparkSession, d: str) -> DataFrame:
    return O.full_month_window(S.panel(spark, d), "2000-01-20").select(DATE, *PANEL_KEYS, r(CBM).alias("cbm"))


@query("W16_pad_short_history", sql(f"""
    SELECT CATEGORY, BRAND, ACTUALSHIPDATE, {rs(V)} AS cbm, 0 AS pad FROM h
    UNION ALL SELECT CATEGORY, BRAND, ACTUALSHIPDATE, {rs(V)}, {i('k')} FROM (
      SELECT *, row_number() OVER (PARTITION BY CATEGORY, BRAND ORDER BY ACTUALSHIPDATE DESC) AS r, count(*) OVER (PARTITION BY CATEGORY, BRAND) AS n FROM h) h2,
      (SELECT unnest(range(1, 1200)) AS k) WHERE r = 1 AND k <= 1200 - n""", "brand_daily", extra={"h": "SELECT * FROM brand_daily"}))
def w16(spark: SparkSession, d: str) -> DataFrame:
    """Every series, filled up to 1200 rows."""
    out = O.pad_short_history(S.daily(spark, d, (CATEGORY, BRAND)), 1200, [CATEGORY, BRAND])
    return out.select(CATEGORY, BRAND, DATE, r(CBM).alias("cbm"), "pad")


@query("W17_category_median_fill", sql(f"""
    SELECT {HEAD}, {rs('coalesce(g, quantile_cont(g, 5e-1) OVER (PARTITION BY CATEGORY), (SELECT quantile_cont(g, 5e-1) FROM x))')} AS filled FROM x""",
    "dense", extra={"x": f"SELECT *, CASE WHEN isodow(ACTUALSHIPDATE) <> 7 AND CATEGORY <> 'TET' THEN {V} END AS g FROM dense"}))
def w17(spark: SparkSession, d: str) -> DataFrame:
    """Sundays are missing; one category is missing altogether and gets the overall median."""
    gaps = F.when((F.weekday(DATE) != 6) & (F.col(CATEGORY) != "TET"), F.col(f"`{CBM}`"))
    rows = S.dense(spark, d).withColumn("g", gaps)
    return O.median_fill(rows, "g").select(DATE, CATEGORY, r("g").alias("filled"))


DENSITY = f"SELECT *, least(1e0, greatest(0e0, {V} / CASE WHEN {Q} = 0 THEN 1e-3 ELSE {Q} END)) AS den FROM dense"


@query("J4_prior_year_density", sql(f"""
    SELECT a.ACTUALSHIPDATE, a.CATEGORY, {rs('a.den')} AS cbm_per_qty, {rs('coalesce(l.den, m.med)')} AS cbm_per_qty_last_year FROM x a
    JOIN (SELECT CATEGORY, quantile_cont(den, 5e-1) AS med FROM x GROUP BY 1) m USING (CATEGORY)
    LEFT JOIN x l ON l.CATEGORY = a.CATEGORY AND year(l.ACTUALSHIPDATE) = year(a.ACTUALSHIPDATE) - 1
      AND month(l.ACTUALSHIPDATE) = month(a.ACTUALSHIPDATE) AND day(l.ACTUALSHIPDATE) = day(a.ACTUALSHIPDATE)""", "dense", extra={"x": DENSITY}))
def j4(spark: SparkSession, d: str) -> DataFrame:
    out = O.prior_year_density(S.dense(spark, d, measures=(QTY, CBM))).select(DATE, CATEGORY, "cbm_per_qty", "cbm_per_qty_last_year")
    return rounded(out, "cbm_per_qty", "cbm_per_qty_last_year")


# ---------------------------------------------------------------- same lunar date

def lunar_match(source: str, n: int, history: str | None = None) -> str:
    """Row-by-row rule in SQL: the date with the same lunar position in year - n, else the
    first offset of -1, +1, -2, +2, -3, +3 that has a row."""
    return f"""SELECT a.ACTUALSHIPDATE AS d, a.CATEGORY AS c, t.day AS aligned, min_by(h.ACTUALSHIPDATE, o.k) AS matched, min_by(h.{V}, o.k) AS v
        FROM {source} a JOIN cyc t ON t.y = year(a.ACTUALSHIPDATE) - {n} AND t.p = {pos('a.ACTUALSHIPDATE')}
        CROSS JOIN offs o LEFT JOIN {history or source} h ON h.CATEGORY = a.CATEGORY AND h.ACTUALSHIPDATE = t.day + o.o
        WHERE h.ACTUALSHIPDATE IS NOT NULL OR o.k = 99 GROUP BY ALL"""


CYC = f"""SELECT year(day) AS y, {pos('day')} AS p, min(day) AS day FROM (
    SELECT CAST(unnest(generate_series(DATE '1993-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS day) GROUP BY 1, 2"""
OFFS = "SELECT * FROM (VALUES (0, 0), (-1, 1), (1, 2), (-2, 3), (2, 4), (-3, 5), (3, 6), (100000, 99)) AS t(o, k)"
SPARSE = "SELECT * FROM daily WHERE CATEGORY <> 'MOONCAKE' OR day(ACTUALSHIPDATE) % 5 = 0"


@query("J6_lunar_yoy_volume", sql(f"""
    SELECT a.ACTUALSHIPDATE, a.CATEGORY, {rs(f'a.{V}')} AS cbm, {rs('coalesce(m1.v, 0e0)')} AS cbm_last_year,
      {rs('coalesce(m2.v, 0e0)')} AS cbm_2_years_ago
    FROM daily a LEFT JOIN m1 ON m1.d = a.ACTUALSHIPDATE AND m1.c = a.CATEGORY LEFT JOIN m2 ON m2.d = a.ACTUALSHIPDATE AND m2.c = a.CATEGORY""",
    "daily", extra={"sparse": SPARSE, "cyc": CYC, "offs": OFFS, "m1": lunar_match("daily", 1, "sparse"), "m2": lunar_match("daily", 2, "sparse")}))
def j6(spark: SparkSession, d: str) -> DataFrame:
    """All rows; one category's history has a row every fifth day only, so the tolerance decides."""
    out = H.lunar_yoy_volume(S.daily(spark, d), anchors=S.ANCHORS, history=_sparse(spark, d))
    names = ["cbm", "cbm_last_year", "cbm_2_years_ago"]
    return rounded(out.withColumnRenamed(CBM, "cbm").select(DATE, CATEGORY, *names), *names)


def _sparse(spark: SparkSession, d: str) -> DataFrame:
    return S.daily(spark, d).filter((F.col(CATEGORY) != "MOONCAKE") | (F.dayofmonth(DATE) % 5 == 0))


@query("C25_lunar_yoy_check", sql(f"""
    SELECT a.ACTUALSHIPDATE, a.CATEGORY, t.day AS aligned_date_1, m1.matched AS matched_date_1,
      {i("date_diff('day', m1.matched, a.ACTUALSHIPDATE)")} AS days_back_1, {pos('m1.matched')} = {pos('a.ACTUALSHIPDATE')} AS same_lunar_date_1
    FROM daily a JOIN cyc t ON t.y = year(a.ACTUALSHIPDATE) - 1 AND t.p = {pos('a.ACTUALSHIPDATE')}
    LEFT JOIN m1 ON m1.d = a.ACTUALSHIPDATE AND m1.c = a.CATEGORY""", "daily",
    extra={"sparse": SPARSE, "cyc": CYC, "offs": OFFS, "m1": lunar_match("daily", 1, "sparse")}))
def c25(spark: SparkSession, d: str) -> DataFrame:
    out = H.lunar_yoy_volume(S.daily(spark, d), (1,), anchors=S.ANCHORS, audit=True, history=_sparse(spark, d))
    return out.select(DATE, CATEGORY, "aligned_date_1", "matched_date_1", "days_back_1", "same_lunar_date_1")
