"""Queries: master join, panel, densification, aggregates, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..columns import BRAND, CATEGORY, CBM, DATE, LINE_CBM, LINE_QTY, PANEL_KEYS, QTY, SKU, WAREHOUSE
from ..functions import calendar as K
from ..operators import history as H, panel as P, sampling, scoring, stats
from . import shipments as S
from .catalog import query, r, rounded
from .queries_forecast import forecast_frame
from .sqltext import Q, V, b, dow, i, r as rs, sql


@query("A1_daily_panel", sql(f"""
    SELECT ACTUALSHIPDATE, WHSEID, CATEGORY, BRAND, {rs(Q)} AS "Total QTY", {rs(V)} AS "Total CBM" FROM panel""", "panel"))
def a1(spark: SparkSession, d: str) -> DataFrame:
    return rounded(S.panel(spark, d), QTY, CBM)


@query("J1_enrich_sku", sql(f"""
    SELECT coalesce(CASE WHEN p_size % 10 <> 0 THEN m.CATEGORY_MASTER END, l.CATEGORY) AS CATEGORY, m.BRAND,
      count(*) AS rows, {rs('sum(l.QTY)')} AS qty
    FROM lines l JOIN master m ON l.SKU = m.SKU JOIN part p ON CAST(p.p_partkey AS VARCHAR) = m.SKU
    GROUP BY ALL""", "lines", "master"))
def j1(spark: SparkSession, d: str) -> DataFrame:
    """Every tenth size has no category in the master, so the line's own category is used."""
    sizes = S.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias(SKU), "p_size")
    m = S.master(spark, d).join(sizes, SKU).withColumn(
        "CATEGORY_MASTER", F.when(F.col("p_size") % 10 != 0, F.col("CATEGORY_MASTER"))).drop("p_size")
    return P.enrich_sku(S.lines(spark, d), m).groupBy(CATEGORY, BRAND).agg(
        F.count("*").alias("rows"), r(F.sum(LINE_QTY)).alias("qty"))


@query("J2_densify_calendar", sql(f"""
    SELECT ACTUALSHIPDATE, CATEGORY, {rs(Q)} AS "Total QTY", {rs(V)} AS "Total CBM" FROM dense""", "dense"))
def j2(spark: SparkSession, d: str) -> DataFrame:
    return rounded(S.dense(spark, d, measures=(QTY, CBM)), QTY, CBM).select(DATE, CATEGORY, F.col(f"`{QTY}`"), F.col(f"`{CBM}`"))


@query("J2_densify_calendar_by_year", sql(f"""
    SELECT {i('year(day)')} AS year, WHSEID, CATEGORY, BRAND, count(*) AS days, {b(f'count(*) FILTER (coalesce({V}, 0) = 0)')} AS zero_days,
      {rs(f'sum(coalesce({V}, 0e0))')} AS cbm
    FROM (SELECT k.*, CAST(unnest(generate_series(y.lo, y.hi, INTERVAL 1 DAY)) AS DATE) AS day
      FROM (SELECT DISTINCT year(ACTUALSHIPDATE) AS y, WHSEID, CATEGORY, BRAND FROM panel) k
      JOIN (SELECT year(ACTUALSHIPDATE) AS y, min(ACTUALSHIPDATE) AS lo, max(ACTUALSHIPDATE) AS hi FROM panel GROUP BY 1) y
        ON k.y = y.y) s
    LEFT JOIN panel p ON p.ACTUALSHIPDATE = s.day AND p.WHSEID = s.WHSEID AND p.CATEGORY = s.CATEGORY AND p.BRAND = s.BRAND
    GROUP BY ALL""".replace("WHSEID, CATEGORY, BRAND, count", "s.WHSEID, s.CATEGORY, s.BRAND, count"), "panel"))
def j2_year(spark: SparkSession, d: str) -> DataFrame:
    """All warehouse, category and brand series, filled within each year."""
    full = P.densify_calendar(S.panel(spark, d), PANEL_KEYS, "year", measures=(CBM,))
    v = F.col(f"`{CBM}`")
    return full.groupBy(F.year(DATE).alias("year"), *PANEL_KEYS).agg(
        F.count("*").alias("days"), F.count(F.when(v == 0, 1)).alias("zero_days"), r(F.sum(v)).alias("cbm"))


@query("A2_aggregate_daily", sql(f"""
    SELECT CAST(ACTUALSHIPDATE AS DATE) AS ACTUALSHIPDATE, CATEGORY, {rs('sum("Total CBM")')} AS "Total CBM",
      {rs('sum("Total QTY")')} AS "Total QTY", any_value({dow()}) AS day_of_week
    FROM panel GROUP BY ALL""".replace("any_value(" + dow() + ")", dow()), "panel"))
def a2(spark: SparkSession, d: str) -> DataFrame:
    rows = S.panel(spark, d).withColumns({"day_of_week": K.weekend(DATE)["day_of_week"]})
    return rounded(P.aggregate_daily(rows, keep=["day_of_week"]), CBM, QTY)


@query("A3_monthly_summary", sql(f"""
    SELECT {i('year(ACTUALSHIPDATE)')} AS "Year", CATEGORY, BRAND, {rs('sum("Total QTY")')} AS "Total QTY",
      {rs('sum("Total CBM")')} AS "Total CBM", {i('month(ACTUALSHIPDATE)')} AS "Month" FROM panel GROUP BY ALL
    ORDER BY 1, 6, 2, 3""", "panel"))
def a3(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.sort_summary(P.monthly_summary(S.panel(spark, d))), QTY, CBM)


YEARS = range(1995, 2002)


@query("A4_month_year_pivot", sql(f"""
    SELECT m AS "Month", {', '.join(f'coalesce({rs(f"""sum(CASE WHEN year(ACTUALSHIPDATE) = {y} THEN {V} ELSE 0e0 END)""")}, 0e0) AS "{y}"' for y in YEARS)}
    FROM (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS m) x LEFT JOIN panel p ON month(p.ACTUALSHIPDATE) = x.m
    GROUP BY ALL""", "panel"))
def a4(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.month_year_pivot(S.panel(spark, d), YEARS), *map(str, YEARS))


@query("A7_series_stats", sql(f"""
    SELECT CATEGORY, BRAND, count(*) AS samples, min(ACTUALSHIPDATE) AS first_date, max(ACTUALSHIPDATE) AS last_date,
      {rs(f'sum({V})')} AS total FROM panel GROUP BY ALL""", "panel"))
def a7(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.series_stats(S.panel(spark, d)), "total")


@query("A8_season_totals", sql(f"""
    SELECT CATEGORY, {i('year(ACTUALSHIPDATE)')} AS year, count(*) AS rows, {rs(f'sum({V})')} AS total, {rs(f'avg({V})')} AS mean
    FROM daily WHERE month(ACTUALSHIPDATE) IN (7, 8, 9) GROUP BY ALL""", "daily"))
def a8(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.season_totals(S.daily(spark, d), [7, 8, 9], [CATEGORY]), "total", "mean")


def flagged(spark: SparkSession, d: str) -> DataFrame:
    """Dense series with a few cheap features."""
    return S.dense(spark, d, measures=(QTY, CBM)).withColumns({**K.weekend(DATE), **K.temporal_cyclic(DATE), **K.end_of_month(DATE),
                                          "constant": F.lit(1)})


FEATURES = ["day_of_week", "is_weekend", "month_sin", "dayofmonth_cos", "days_until_month_end", QTY, "constant"]
FEATURE_SQL = f"""SELECT *, {dow()} AS day_of_week, CASE WHEN {dow()} >= 5 THEN 1 ELSE 0 END AS is_weekend,
    sin(2 * pi() * (month({'ACTUALSHIPDATE'}) - 1) / 12) AS month_sin, cos(2 * pi() * (day(ACTUALSHIPDATE) - 1) / 31) AS dayofmonth_cos,
    day(last_day(ACTUALSHIPDATE)) - day(ACTUALSHIPDATE) AS days_until_month_end, 1 AS constant FROM dense"""


def _union(template, names=FEATURES) -> str:
    return " UNION ALL ".join(template(f) for f in names)


@query("A9_feature_target_correlations", sql(_union(lambda f: f"""
    SELECT '{f}' AS feature, CASE WHEN min("{f}") = max("{f}") THEN 0e0 ELSE {rs(f'corr("{f}", {V})')} END AS r FROM x"""),
    "dense", extra={"x": FEATURE_SQL}))
def a9(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.feature_target_correlations(flagged(spark, d), FEATURES), "r")


@query("A10_feature_ranges", sql(_union(lambda f: f"""
    SELECT '{f}' AS feature, {rs(f'min("{f}")::DOUBLE')} AS min, {rs(f'max("{f}")::DOUBLE')} AS max FROM x""", [*FEATURES, CBM]),
    "dense", extra={"x": FEATURE_SQL}))
def a10(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.feature_ranges(flagged(spark, d), [*FEATURES, CBM]), "min", "max")


SPLIT_SQL = """SELECT *, CASE WHEN rn <= floor(7e-1 * n) THEN 'train' WHEN rn <= floor(7e-1 * n) + floor(1e-1 * n) THEN 'val'
    ELSE 'test' END AS split FROM (SELECT *, row_number() OVER (PARTITION BY CATEGORY ORDER BY ACTUALSHIPDATE) AS rn,
    count(*) OVER (PARTITION BY CATEGORY) AS n FROM dense)"""


@query("A11_fit_scaler", sql(f"""
    SELECT CATEGORY, {rs(f'avg({V})')} AS mean, {rs(f'CASE WHEN stddev_pop({V}) = 0 THEN 1e0 ELSE stddev_pop({V}) END')} AS std
    FROM s WHERE split = 'train' GROUP BY ALL""", "dense", extra={"s": SPLIT_SQL}))
def a11(spark: SparkSession, d: str) -> DataFrame:
    train = sampling.temporal_split(S.dense(spark, d)).filter(F.col("split") == "train")
    return rounded(stats.fit_scaler(train), "mean", "std")


@query("A12_encode_categories", sql(f"""
    SELECT CATEGORY, {i('dense_rank() OVER (ORDER BY CATEGORY) - 1')} AS "CATEGORY_ID", rows
    FROM (SELECT CATEGORY, count(*) AS rows FROM panel GROUP BY ALL)""", "panel"))
def a12(spark: SparkSession, d: str) -> DataFrame:
    rows = S.panel(spark, d)
    return rows.groupBy(CATEGORY).agg(F.count("*").alias("rows")).join(stats.encode_categories(rows), CATEGORY)


def _text(expr: str) -> str:
    """SQL: a value with its length, `-` for null."""
    return f"coalesce(CAST(length(CAST({expr} AS VARCHAR)) AS VARCHAR) || ':' || CAST({expr} AS VARCHAR), '-')"


FINGERPRINT_TEXT = " || ".join([_text("epoch_us(ACTUALSHIPDATE)"), *[_text(c) for c in ("WHSEID", "SKU", "CATEGORY")],
                                *[_text(f"TRY_CAST(floor({c} * 1e6 + 5e-1) AS BIGINT)") for c in ("QTY", "CUBE_OUT")]])


@query("A13_dataset_fingerprint", sql(f"""
    SELECT count(*) AS rows, CAST(sum(CAST(('0x' || md5({FINGERPRINT_TEXT})[1:15]) AS BIGINT)) % 18446744073709551616 AS VARCHAR) AS fingerprint FROM lines""", "lines"))
def a13(spark: SparkSession, d: str) -> DataFrame:
    return stats.dataset_fingerprint(S.lines(spark, d), [DATE, WAREHOUSE, SKU, CATEGORY, LINE_QTY, LINE_CBM])


@query("A15_busiest_dates", sql("""
    SELECT ACTUALSHIPDATE, count(*) AS rows FROM clean GROUP BY 1 ORDER BY rows DESC, ACTUALSHIPDATE LIMIT 20""", "clean"))
def a15(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.cleaning import business_date

    joined = P.drop_categories(P.enrich_sku(S.lines(spark, d), S.master(spark, d)))
    return P.busiest_dates(joined.withColumn(DATE, business_date(DATE)), 20)


@query("A16_coverage_report", sql(f"""
    SELECT CATEGORY, count(*) AS rows, min(ACTUALSHIPDATE) AS first_date, max(ACTUALSHIPDATE) AS last_date,
      {b('grouping(CATEGORY)')} AS level FROM panel GROUP BY ROLLUP (CATEGORY)""", "panel"))
def a16(spark: SparkSession, d: str) -> DataFrame:
    return P.coverage_report(S.panel(spark, d))


# ---------------------------------------------------------------- sorts and set operations

@query("L1_sort", sql(f"""SELECT CATEGORY, ACTUALSHIPDATE, {rs(V)} AS cbm FROM daily ORDER BY CATEGORY, ACTUALSHIPDATE""", "daily"))
def l1(spark: SparkSession, d: str) -> DataFrame:
    return S.daily(spark, d).orderBy(CATEGORY, DATE).select(CATEGORY, DATE, r(CBM).alias("cbm"))


@query("L2_top_n", sql(f"""SELECT ACTUALSHIPDATE, CATEGORY, {rs(V)} AS cbm FROM daily
    ORDER BY {rs(V)} DESC, ACTUALSHIPDATE, CATEGORY LIMIT 25""", "daily"))
def l2(spark: SparkSession, d: str) -> DataFrame:
    rows = S.daily(spark, d).select(DATE, CATEGORY, r(CBM).alias("cbm"))
    return rows.orderBy(F.desc("cbm"), DATE, CATEGORY).limit(25)


@query("L3_union_all", sql(f"""SELECT 'qty' AS measure, CATEGORY, {rs(f'sum({Q})')} AS total FROM panel GROUP BY ALL
    UNION ALL SELECT 'cbm', CATEGORY, {rs(f'sum({V})')} FROM panel GROUP BY ALL""", "panel"))
def l3(spark: SparkSession, d: str) -> DataFrame:
    rows = S.panel(spark, d).groupBy(CATEGORY).agg(F.sum(f"`{QTY}`").alias("q"), F.sum(f"`{CBM}`").alias("c"))
    return rows.select(F.lit("qty").alias("measure"), CATEGORY, r("q").alias("total")).unionByName(
        rows.select(F.lit("cbm").alias("measure"), CATEGORY, r("c").alias("total")))


@query("L4_keep_first_and_last", sql(f"""
    SELECT 'first' AS kept, SKU, ACTUALSHIPDATE, QTY FROM (SELECT *, row_number() OVER (PARTITION BY SKU ORDER BY ACTUALSHIPDATE, QTY, CUBE_OUT) AS k FROM lines) WHERE k = 1
    UNION ALL SELECT 'last', SKU, ACTUALSHIPDATE, QTY FROM (SELECT *, row_number() OVER (PARTITION BY SKU ORDER BY ACTUALSHIPDATE DESC, QTY DESC, CUBE_OUT DESC) AS k FROM lines) WHERE k = 1""", "lines"))
def l4(spark: SparkSession, d: str) -> DataFrame:
    rows = S.lines(spark, d).select(SKU, DATE, LINE_QTY, LINE_CBM)
    order = [DATE, LINE_QTY, LINE_CBM]
    first = H.keep_one(rows, [SKU], order).withColumn("kept", F.lit("first"))
    last = H.keep_one(rows, [SKU], order, last=True).withColumn("kept", F.lit("last"))
    return first.unionByName(last).select("kept", SKU, DATE, LINE_QTY)


RUN_SQL = "SELECT DISTINCT CAST(year(ACTUALSHIPDATE) AS VARCHAR) AS run, WHSEID || BRAND || CAST(day(ACTUALSHIPDATE) AS VARCHAR) AS feature FROM panel"


def _run_features(spark: SparkSession, d: str) -> DataFrame:
    """Names seen in each year stand for the features of a run."""
    return S.panel(spark, d).select(F.year(DATE).cast("string").alias("run"), F.concat(
        WAREHOUSE, BRAND, F.dayofmonth(DATE).cast("string")).alias("feature")).distinct()


@query("L5_feature_changes", sql("""
    SELECT feature, 'added' AS change FROM (SELECT feature FROM x WHERE run = '2001' EXCEPT ALL SELECT feature FROM x WHERE run = '2000')
    UNION ALL SELECT feature, 'removed' FROM (SELECT feature FROM x WHERE run = '2000' EXCEPT ALL SELECT feature FROM x WHERE run = '2001')""",
    "panel", extra={"x": RUN_SQL}))
def l5(spark: SparkSession, d: str) -> DataFrame:
    return H.feature_changes(_run_features(spark, d), "2000", "2001")


@query("L6_available", sql("""
    SELECT feature FROM x WHERE run = '1995' INTERSECT SELECT feature FROM x WHERE run = '1996'""", "panel", extra={"x": RUN_SQL}))
def l6(spark: SparkSession, d: str) -> DataFrame:
    x = _run_features(spark, d)
    return H.available(x.filter(F.col("run") == "1995"), x.filter(F.col("run") == "1996"), "feature")


# ---------------------------------------------------------------- forecast totals

@query("A5_totals_by_day", sql(f"""SELECT date, {rs('sum(actual)')} AS actual, {rs('sum(predicted)')} AS predicted
    FROM fc GROUP BY ALL""", "fc"))
def a5_day(spark: SparkSession, d: str) -> DataFrame:
    return rounded(scoring.totals_by_day(forecast_frame(spark, d)), "actual", "predicted")


@query("A5_totals_by_month", sql(f"""SELECT CAST(date_trunc('month', date) AS DATE) AS month, {rs('sum(actual)')} AS actual,
    {rs('sum(predicted)')} AS predicted FROM fc GROUP BY ALL""", "fc"))
def a5_month(spark: SparkSession, d: str) -> DataFrame:
    return rounded(scoring.totals_by_month(scoring.totals_by_day(forecast_frame(spark, d))), "actual", "predicted")


@query("A6_monthly_results", sql(f"""
    SELECT {i('year(date)')} AS "Year", CATEGORY, {i('month(date)')} AS "Month", {rs('sum(predicted)')} AS predicted,
      {rs('sum(actual)')} AS actual, {rs('sum(predicted) - sum(actual)')} AS error, {rs('abs(sum(predicted) - sum(actual))')} AS abs_error
    FROM fc GROUP BY ALL""", "fc"))
def a6(spark: SparkSession, d: str) -> DataFrame:
    return rounded(scoring.monthly_results(forecast_frame(spark, d)), "predicted", "actual", "error", "abs_error")
