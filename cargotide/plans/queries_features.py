"""Queries: models per key on feature columns, their forecasts and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..columns import BRAND, CATEGORY, CBM, DATE
from ..operators import feature_forecast as M, regression as G
from . import shipments as S
from .catalog import query, r, rounded
from .sqltext import V, r as rs, sql

TRAIN_END, START = "2000-12-31", "2001-01-01"
#: Mean of the 28 days up to the origin: one feature, so that SQL can fit it.
ONE = M.FeatureSet(rolling=(28,), momentum=None, lags=(), years=(), step=False)


def before(df: DataFrame) -> DataFrame:
    return df.filter(F.col(DATE) <= F.lit(TRAIN_END).cast("date"))


def origins(source: str, keys: str, where: str = "true") -> str:
    """SQL: each day with the 28-day mean and its number in the series."""
    return f"""SELECT {keys}, ACTUALSHIPDATE AS d, {V} AS v, row_number() OVER w AS rn,
        avg({V}) OVER (PARTITION BY {keys} ORDER BY ACTUALSHIPDATE ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS m
        FROM {source} WHERE {where} WINDOW w AS (PARTITION BY {keys} ORDER BY ACTUALSHIPDATE)"""


def pairs(source: str, keys: str, horizon: int, stride: int = 1) -> str:
    """SQL: origin and label rows of all steps."""
    same = " AND ".join(f"t.{k.strip()} = o.{k.strip()}" for k in keys.split(","))
    head = ", ".join(f"o.{k.strip()}" for k in keys.split(","))
    return f"""SELECT {head}, o.d AS origin, o.m AS x, t.v AS y, t.d AS date, CAST(t.rn - o.rn AS INTEGER) AS step
        FROM {source} o JOIN {source} t ON {same} AND t.rn BETWEEN o.rn + 1 AND o.rn + {horizon}
        WHERE date_diff('day', DATE '1970-01-01', o.d) % {stride} = 0"""


TRAIN = f"ACTUALSHIPDATE <= DATE '{TRAIN_END}'"


@query("F2_fit_per_key", sql(f"""
    SELECT CATEGORY, count(*) AS rows, {rs('regr_intercept(y, x)', 5)} AS intercept, {rs('regr_slope(y, x)', 5)} AS slope,
      any_value(pooled_intercept) AS pooled_intercept, any_value(pooled_slope) AS pooled_slope
    FROM p, (SELECT {rs('regr_intercept(y, x)', 5)} AS pooled_intercept, {rs('regr_slope(y, x)', 5)} AS pooled_slope FROM p) GROUP BY CATEGORY""",
    "dense", extra={"o": origins("dense", "CATEGORY", TRAIN), "p": pairs("o", "CATEGORY", 7)}))
def f2_per_key(spark: SparkSession, d: str) -> DataFrame:
    """Least squares per category and pooled."""
    model = M.fit_features(before(S.dense(spark, d)), ONE, 7, [CATEGORY], scaled=False).model
    c = F.col("coefficients")
    return model.table.select(CATEGORY, "rows", r(c[0], 5).alias("intercept"), r(c[1], 5).alias("slope"),
                              *[r(F.lit(v), 5).alias(f"pooled_{n}") for n, v in zip(("intercept", "slope"), model.pooled)])


@query("F2_fit_shrunk", sql(f"""
    SELECT CATEGORY, BRAND, {rs('(sy * sxx - sx * sxy) / (n * sxx - sx * sx)', 5)} AS intercept, {rs('(n * sxy - sx * sy) / (n * sxx - sx * sx)', 5)} AS slope
    FROM (SELECT CATEGORY, BRAND, s.n + l AS n, s.sx + l * g.sx / g.n AS sx, s.sxx + l * g.sxx / g.n AS sxx, s.sy + l * g.sy / g.n AS sy, s.sxy + l * g.sxy / g.n AS sxy
      FROM s, (SELECT sum(n) AS n, sum(sx) AS sx, sum(sxx) AS sxx, sum(sy) AS sy, sum(sxy) AS sxy, 200e0 AS l FROM s) g)""",
    "brand_dense", extra={"o": origins("brand_dense", "CATEGORY, BRAND", TRAIN), "p": pairs("o", "CATEGORY, BRAND", 3, 3),
        "s": "SELECT CATEGORY, BRAND, count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y) AS sy, sum(x * y) AS sxy FROM p GROUP BY ALL"}))
def f2_shrunk(spark: SparkSession, d: str) -> DataFrame:
    """Brand models that hold 200 rows' weight of the average row of all brands."""
    keys = [CATEGORY, BRAND]
    model = M.fit_features(before(S.dense(spark, d, keys)), ONE, 3, keys, shrink=200.0, stride=3, scaled=False).model
    c = F.col("coefficients")
    return model.table.select(*keys, r(c[0], 5).alias("intercept"), r(c[1], 5).alias("slope"))


COLD = ("Brand#13", "Brand#2", "Brand#21")
JANUARY = "SELECT CAST(unnest(generate_series(DATE '2001-01-01', DATE '2001-01-31', INTERVAL 1 DAY)) AS DATE) AS date"


def fitted(name: str, keys: str) -> str:
    return f"SELECT {keys}, regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM {name} GROUP BY ALL"


@query("F4_forecast_complete", sql(f"""
    SELECT date, CATEGORY, BRAND, {rs('greatest(a + b * m, 0e0)', 5)} AS predicted, 'own' AS model
    FROM bf JOIN (SELECT CATEGORY, BRAND, m FROM bo WHERE d = DATE '{TRAIN_END}') USING (CATEGORY, BRAND), days
    UNION ALL
    SELECT date, CATEGORY, BRAND, {rs('greatest(a + b * m, 0e0) * share', 5)}, 'allocated'
    FROM cf JOIN (SELECT CATEGORY, m FROM co WHERE d = DATE '{TRAIN_END}') USING (CATEGORY) JOIN shares USING (CATEGORY), days
    WHERE BRAND IN {COLD}""", "dense", "brand_dense", extra={
        "days": JANUARY,
        "bo": origins("brand_dense", "CATEGORY, BRAND", f"{TRAIN} AND BRAND NOT IN {COLD}"), "bp": pairs("bo", "CATEGORY, BRAND", 31, 7), "bf": fitted("bp", "CATEGORY, BRAND"),
        "co": origins("dense", "CATEGORY", TRAIN), "cp": pairs("co", "CATEGORY", 31, 7), "cf": fitted("cp", "CATEGORY"),
        "shares": f"""SELECT CATEGORY, BRAND, (coalesce(v, 0e0) + 5e0) / sum(coalesce(v, 0e0) + 5e0) OVER (PARTITION BY CATEGORY) AS share
            FROM (SELECT DISTINCT CATEGORY, BRAND FROM brand_dense) LEFT JOIN (SELECT CATEGORY, BRAND, sum({V}) AS v FROM brand_dense
              WHERE {TRAIN} AND BRAND NOT IN {COLD} GROUP BY ALL) USING (CATEGORY, BRAND)"""}))
def f4_complete(spark: SparkSession, d: str) -> DataFrame:
    """January of all brands; three brands have no history and share out their category's forecast."""
    keys = [CATEGORY, BRAND]
    brands = S.dense(spark, d, keys)
    known = before(brands).filter(~F.col(BRAND).isin(*COLD))
    own = M.forecast_features(M.fit_features(known, ONE, 31, keys, stride=7, scaled=False), known, START, "2001-01-31")
    whole = before(S.dense(spark, d))
    parents = M.forecast_features(M.fit_features(whole, ONE, 31, [CATEGORY], stride=7, scaled=False), whole, START, "2001-01-31")
    out = M.complete_forecast(own, parents, brands.select(*keys), known, smoothing=5.0)
    return rounded(out.select("date", *keys, "predicted", "model"), "predicted", digits=5)


#: Mean of 7 days, the same day last year and a residual target over the mean of 28 days.
TWO = M.FeatureSet(rolling=(7,), momentum=None, lags=(), years=(1,), step=False, baseline=28)
WEIGHTS = (0.05, 0.3, 0.2)


@query("F5_feature_state", sql(f"""
    SELECT CATEGORY, date, {rs('predicted')} AS predicted FROM (
      SELECT CATEGORY, unnest(days) AS date, unnest(p) AS predicted FROM st WHERE days IS NOT NULL)""", "dense", extra={
    "st": f"""SELECT CATEGORY, first, v, days, p FROM (
        WITH RECURSIVE s AS (
          SELECT CATEGORY, DATE '{START}' AS first, list({V} ORDER BY ACTUALSHIPDATE) AS v, CAST(NULL AS DATE[]) AS days, CAST(NULL AS DOUBLE[]) AS p
          FROM dense WHERE {TRAIN} GROUP BY CATEGORY
          UNION ALL
          SELECT CATEGORY, CAST(first + INTERVAL 1 MONTH AS DATE), list_concat(v, p), days, p FROM (
            SELECT CATEGORY, first, v, days, list_transform(days, lambda d: greatest(0e0, {WEIGHTS[0]}e0 + {WEIGHTS[1]}e0 * list_avg(v[-7:]) + list_avg(v[-28:])
                + {WEIGHTS[2]}e0 * CASE WHEN day(CAST(d - INTERVAL 1 YEAR AS DATE)) = day(d)
                    THEN v[len(v) + 1 - date_diff('day', CAST(d - INTERVAL 1 YEAR AS DATE), first)] ELSE 0e0 END)) AS p
            FROM (SELECT CATEGORY, first, v, list_transform(generate_series(first, last_day(first), INTERVAL 1 DAY), lambda t: CAST(t AS DATE)) AS days
                  FROM s WHERE first < DATE '2002-04-01')))
        SELECT * FROM s)"""}))
def f5_state(spark: SparkSession, d: str) -> DataFrame:
    """Fifteen months with a given model: means, baseline and last year's days come from earlier forecasts."""
    model = M.FeatureModel(TWO, G.GroupedModel((CATEGORY,), WEIGHTS, None), 31, (CATEGORY,))
    out = M.forecast_features(model, before(S.dense(spark, d)), START, "2002-03-31")
    return rounded(out.select(CATEGORY, "date", "predicted"), "predicted")


@query("F7_evaluate_features", sql(f"""
    SELECT CATEGORY, step AS horizon_step, count(*) AS windows, {rs('avg(abs(a + b * x - y))', 5)} AS mae, {rs('sqrt(avg(pow(a + b * x - y, 2)))', 5)} AS rmse
    FROM q JOIN f USING (CATEGORY) WHERE origin >= DATE '{TRAIN_END}' GROUP BY ALL""", "dense", extra={
        "o": origins("dense", "CATEGORY", TRAIN), "p": pairs("o", "CATEGORY", 7), "f": fitted("p", "CATEGORY"),
        "a": origins("dense", "CATEGORY"), "q": pairs("a", "CATEGORY", 7)}))
def f7_features(spark: SparkSession, d: str) -> DataFrame:
    """Fitted before 2001, scored on every origin from its last day on."""
    from ..operators.scoring import mae, rmse

    rows = S.dense(spark, d)
    model = M.fit_features(before(rows), ONE, 7, [CATEGORY])
    scored = M.evaluate_features(model, rows, first=TRAIN_END)
    return scored.groupBy(CATEGORY, "horizon_step").agg(F.count("*").alias("windows"), r(mae(), 5).alias("mae"), r(rmse(), 5).alias("rmse"))
