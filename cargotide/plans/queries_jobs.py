"""Queries: whole jobs over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..columns import BRAND, CATEGORY, CBM, DATE, QTY
from ..session import scratch_path
from ..operators.scoring import accuracy_by
from . import jobs as J, shipments as S
from .catalog import ORACLES, query, r, rounded
from .sqltext import V, i, r as rs, sql

CALENDAR_PARTS = ("C1_temporal_cyclic", "C2_weekend", "C3_dow_cyclic", "C4_is_monday", "C5_weekday_tier", "C6_end_of_month",
                  "C7_mid_month_peak", "C8_early_month_with_tier", "C9_lunar_date", "C10_lunar_cyclic", "C12_high_volume_month", "C13_holiday_features",
                  "C16_days_to_tet", "C17_days_to_mid_autumn", "C18_pre_holiday_surge", "C19_season_window_lunar_gregorian",
                  "C20_days_until_lunar_0801", "C21_is_august")


def _calendar_sql() -> str:
    """The single-feature queries side by side."""
    from . import queries_calendar  # noqa: F401  (registers the parts)

    first, *rest = [f"({ORACLES[name]})" for name in CALENDAR_PARTS]
    return f"SELECT * FROM {first} t0 " + " ".join(
        f"JOIN {part} t{n} USING (ACTUALSHIPDATE, CATEGORY)" for n, part in enumerate(rest, 1))


@query("JOB_calendar_features", _calendar_sql())
def calendar_features(spark: SparkSession, d: str) -> DataFrame:
    """Every calendar feature of the training frame at once."""
    out = J.calendar_features(S.dense(spark, d, measures=()), S.calendar(spark), S.ANCHORS)
    return rounded(out, *[c for c, t in out.dtypes if t == "double"])


@query("JOB_panel_by_year", sql(f"""
    SELECT {i('year(ACTUALSHIPDATE)')} AS year, CATEGORY, {rs(f'sum({V})')} AS cbm, count(DISTINCT ACTUALSHIPDATE) AS shipping_days
    FROM panel GROUP BY ALL""", "panel"))
def panel_by_year(spark: SparkSession, d: str) -> DataFrame:
    """Lines to the written panel, read back."""
    written = J.panel_job(S.lines(spark, d), S.raw_master(spark, d), scratch_path(spark, "panel-job"), unit_rules=S.RULES)
    v = F.col(f"`{CBM}`")
    return written.groupBy("year", CATEGORY).agg(
        r(F.sum(v)).alias("cbm"), F.count_distinct(F.when(v > 0, F.col(DATE))).alias("shipping_days"))


@query("JOB_feature_frame")
def feature_frame(spark: SparkSession, d: str) -> DataFrame:
    """All features of all series; one row per category and month of the whole frame."""
    out = J.feature_frame(S.dense(spark, d, measures=(QTY, CBM)), S.calendar(spark), S.ANCHORS)
    numeric = [c for c, t in out.dtypes if t in ("double", "int") and c not in (QTY, CBM)]
    return out.groupBy(CATEGORY, F.trunc(DATE, "MM").alias("month_start")).agg(
        F.count("*").alias("days"), *[F.avg(F.col(c)).alias(c) for c in numeric])


def _two_months_sql() -> str:
    """Each category's January and February from its own line, the second from the first."""
    line = "greatest(a + b * {m}, 0e0)"
    return f"""SELECT CAST(t AS DATE) AS date, CATEGORY, CASE WHEN t < DATE '2001-02-01' THEN p ELSE {line.format(m='p')} END AS predicted
        FROM (SELECT CATEGORY, a, b, {line.format(m='m')} AS p FROM f JOIN (SELECT CATEGORY, m FROM o WHERE d = DATE '2000-12-31') USING (CATEGORY)),
          (SELECT unnest(generate_series(DATE '2001-01-01', DATE '2001-02-28', INTERVAL 1 DAY)) AS t)"""


def _scores_sql() -> str:
    from .queries_features import TRAIN, fitted, origins, pairs
    from .queries_forecast import CLOSED, FLOORED, SEASON, carried
    from .queries_scores import ABS, DAYT, MONT, NET, TOT

    return sql(f"""
    SELECT 'overall' AS level, NULL::VARCHAR AS CATEGORY, NULL::DATE AS month, {ABS} AS accuracy_abs, {NET} AS accuracy_net, {TOT} FROM mt
    UNION ALL SELECT 'month', NULL, month, {ABS}, {NET}, {TOT} FROM dt GROUP BY month
    UNION ALL SELECT 'category_month', CATEGORY, CAST(date_trunc('month', date) AS DATE) AS month, {ABS}, {NET}, {TOT} FROM z GROUP BY ALL""",
        "dense", "closed", extra={
            "o": origins("dense", "CATEGORY", TRAIN), "q": pairs("o", "CATEGORY", 31, 7), "f": fitted("q", "CATEGORY"),
            "x": f"SELECT g.date, g.CATEGORY, predicted, {V} AS actual FROM ({_two_months_sql()}) g JOIN dense e ON e.CATEGORY = g.CATEGORY AND e.ACTUALSHIPDATE = g.date",
            "s1": f"SELECT date, CATEGORY, actual, {FLOORED} AS predicted FROM x",
            "s2": f"SELECT date, CATEGORY, actual, predicted * CASE WHEN CATEGORY = 'MOONCAKE' AND NOT ({SEASON}) THEN 0 WHEN CATEGORY = 'MOONCAKE' AND month(date) = 8 THEN 2 ELSE 1 END AS predicted FROM s1",
            "s3": "SELECT date, CATEGORY, actual, CASE WHEN CATEGORY = 'MOONCAKE' AND predicted < 2 THEN 0e0 ELSE predicted END AS predicted FROM s2",
            "s4": f"SELECT date, CATEGORY, actual, CASE WHEN {CLOSED} THEN 0e0 ELSE predicted END AS predicted FROM s3",
            "z": carried("s4", "CATEGORY"), "dt": DAYT.replace("FROM fc", "FROM z"), "mt": MONT})


@query("JOB_forecast_scores", _scores_sql())
def forecast_scores(spark: SparkSession, d: str) -> DataFrame:
    """Fit a line per category on everything before 2001, forecast two months, apply the rules, score."""
    from .queries_features import ONE, before

    rows = S.stored_dense(spark, d)
    out = J.forecast_job(spark, before(rows), rows, S.calendar(spark), "2001-01-01", "2001-02-28", anchors=S.ANCHORS,
                         features=ONE, shrink=0.0, least_rows=0)
    scores = accuracy_by(out)
    return rounded(scores, *[c for c, t in scores.dtypes if t == "double"])


@query("JOB_forecast_features")
def forecast_with_features(spark: SparkSession, d: str) -> DataFrame:
    """All calendar and series features, brands shrunk to the pooled model; brands without history share out
    their category's forecast. Totals by brand and month."""
    keys = [CATEGORY, BRAND]
    rows = S.stored_dense(spark, d, keys)
    known = rows.filter((F.col(DATE) < F.lit("2001-01-01").cast("date")) & (F.col(BRAND) != "Brand#13"))
    out = J.forecast_job(spark, known, rows, S.calendar(spark), "2001-01-01", "2001-02-28", keys=keys, anchors=S.ANCHORS,
                         features=J.model_features(S.calendar(spark), S.ANCHORS), stride=28, wanted=rows.select(*keys))
    return out.groupBy(*keys, F.month("date").alias("month")).agg(F.count("*").alias("days"), F.sum("predicted").alias("predicted"),
                                                                  F.sum("actual").alias("actual"))
