"""Queries: forecast scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..columns import BRAND, CATEGORY, CBM
from ..functions.measures import WeightProfile, sample_weight
from ..operators import forecast as X, quantiles, sampling, scoring as Sc
from . import shipments as S
from .catalog import query, r, rounded
from .queries_forecast import forecast_frame
from .sqltext import V, i, r as rs, sql

E_ = "(predicted - actual)"
MAE, MSE = f"avg(abs{E_})", f"avg({E_} * {E_})"


def _round_all(df: DataFrame) -> DataFrame:
    return rounded(df, *[c for c, t in df.dtypes if t == "double"])


@query("E1_error_metrics", sql(f"""SELECT CATEGORY, {rs(MAE)} AS mae, {rs(MSE)} AS mse, {rs(f'sqrt({MSE})')} AS rmse
    FROM fc WHERE isodow(date) <> 7 GROUP BY ALL""", "fc"))
def e1(spark: SparkSession, d: str) -> DataFrame:
    """Sundays are masked."""
    return _round_all(Sc.error_metrics(forecast_frame(spark, d), [CATEGORY], F.weekday("date") != 6))


def acc(num: str) -> str:
    den = "sum(abs(actual))"
    return rs(f"CASE WHEN {den} = 0 THEN NULL WHEN {num} > {den} THEN 0e0 ELSE 100e0 - {num} / {den} * 100e0 END")


ABS, NET = acc(f"sum(abs{E_})"), acc(f"abs(sum{E_})")


@query("E2_accuracy_abs", sql(f"SELECT CATEGORY, {ABS} AS accuracy_abs FROM fc GROUP BY ALL", "fc"))
def e2(spark: SparkSession, d: str) -> DataFrame:
    return forecast_frame(spark, d).groupBy(CATEGORY).agg(r(Sc.accuracy_abs()).alias("accuracy_abs"))


@query("E3_accuracy_net", sql(f"SELECT CATEGORY, {NET} AS accuracy_net FROM fc GROUP BY ALL", "fc"))
def e3(spark: SparkSession, d: str) -> DataFrame:
    return forecast_frame(spark, d).groupBy(CATEGORY).agg(r(Sc.accuracy_net()).alias("accuracy_net"))


TOT = f"{rs('sum(abs(actual))')} AS total_actual, {rs('sum(abs(predicted))')} AS total_predicted"
DAYT = "SELECT date, CAST(date_trunc('month', date) AS DATE) AS month, sum(actual) AS actual, sum(predicted) AS predicted FROM fc GROUP BY ALL"
MONT = "SELECT month, sum(actual) AS actual, sum(predicted) AS predicted FROM dt GROUP BY ALL"


@query("E4_accuracy_by", sql(f"""
    SELECT 'overall' AS level, NULL::VARCHAR AS CATEGORY, NULL::DATE AS month, {ABS} AS accuracy_abs, {NET} AS accuracy_net, {TOT} FROM mt
    UNION ALL SELECT 'month', NULL, month, {ABS}, {NET}, {TOT} FROM dt GROUP BY month
    UNION ALL SELECT 'category_month', CATEGORY, CAST(date_trunc('month', date) AS DATE) AS month, {ABS}, {NET}, {TOT} FROM fc GROUP BY ALL""",
    "fc", extra={"dt": DAYT, "mt": MONT}))
def e4(spark: SparkSession, d: str) -> DataFrame:
    return _round_all(Sc.accuracy_by(forecast_frame(spark, d)))


@query("E5_quantile_coverage", sql(f"""
    SELECT CATEGORY, {rs('count(*) FILTER (actual < predicted) / count(*)::DOUBLE')} AS coverage_rate, 9e-1 AS target_coverage,
      {rs('count(*) FILTER (actual < predicted) / count(*)::DOUBLE - 9e-1')} AS coverage_error, count(*) FILTER (actual > predicted) AS under_coverage,
      count(*) FILTER (actual < predicted) AS over_coverage, count(*) AS total_count,
      {rs('coalesce(avg(actual - predicted) FILTER (actual > predicted), 0e0)')} AS mean_excess FROM fc GROUP BY ALL""", "fc"))
def e5(spark: SparkSession, d: str) -> DataFrame:
    return _round_all(Sc.quantile_coverage(forecast_frame(spark, d), 0.9, [CATEGORY]))


def part(cond: str, name: str, count: str = "count") -> str:
    return (f"{rs(f'avg(abs{E_}) FILTER ({cond})')} AS {name}_mae, {rs(f'sqrt(avg({E_} * {E_}) FILTER ({cond}))')} AS {name}_rmse, "
            f"count(*) FILTER ({cond}) AS {name}_{count}")


@query("E6_segmented_metrics", sql(f"""
    SELECT {rs('max(t)')} AS threshold, {part('actual > t', 'spike')}, {part('actual <= t', 'non_spike')},
      count(*) FILTER ({E_} > 0) AS over_pred_count, count(*) FILTER ({E_} <= 0) AS under_pred_count,
      {rs(f'count(*) FILTER ({E_} > 0) / count(*)::DOUBLE * 100')} AS over_pred_pct, {rs(f'count(*) FILTER ({E_} <= 0) / count(*)::DOUBLE * 100')} AS under_pred_pct,
      {part('isodow(date) = 1', 'monday')}, {part('isodow(date) = 3', 'wednesday')}, {part('isodow(date) = 5', 'friday')},
      {part('isodow(date) IN (1, 3, 5)', 'high_volume_days')}
    FROM fc, (SELECT quantile_cont(actual, 8e-1) AS t FROM fc)""", "fc"))
def e6(spark: SparkSession, d: str) -> DataFrame:
    return _round_all(Sc.segmented_metrics(forecast_frame(spark, d)))


@query("E7_residual_statistics", sql(f"""
    SELECT CATEGORY, {rs('avg(x)')} AS residual_mean, {rs('sqrt(avg((x - m) * (x - m)))')} AS residual_std,
      {rs('avg(pow(x - m, 3)) / pow(avg((x - m) * (x - m)), 15e-1)')} AS residual_skewness,
      {rs('avg(pow(x - m, 4)) / pow(avg((x - m) * (x - m)), 2) - 3')} AS residual_kurtosis
    FROM (SELECT CATEGORY, actual - predicted AS x, avg(actual - predicted) OVER (PARTITION BY CATEGORY) AS m FROM fc) GROUP BY ALL""", "fc"))
def e7(spark: SparkSession, d: str) -> DataFrame:
    return _round_all(Sc.residual_statistics(forecast_frame(spark, d), [CATEGORY]))


@query("E8_percentile_errors", sql(f"""SELECT {rs(f'quantile_cont(abs{E_}, 9e-1)')} AS p90_abs_error,
    {rs(f'quantile_cont(abs{E_}, 95e-2)')} AS p95_abs_error FROM fcb""", "fcb"))
def e8(spark: SparkSession, d: str) -> DataFrame:
    """Over all brand rows."""
    return _round_all(Sc.percentile_errors(forecast_frame(spark, d, (CATEGORY, BRAND))))


@query("E8_exact_quantiles_of_lines", f"""SELECT {rs('quantile_cont(l_extendedprice, 1e-1)')} AS q10, {rs('quantile_cont(l_extendedprice, 5e-1)')} AS q50,
    {rs('quantile_cont(l_extendedprice, 999e-3)')} AS q999, {rs('quantile_cont(l_extendedprice, 0e0)')} AS q0, {rs('quantile_cont(l_extendedprice, 1e0)')} AS q100 FROM lineitem""")
def e8_lines(spark: SparkSession, d: str) -> DataFrame:
    """The quantile operator itself on a raw column."""
    q = quantiles.exact_quantiles(S.table(spark, d, "lineitem"), "l_extendedprice", [0.1, 0.5, 0.999, 0.0, 1.0])
    return q.select(*[r(F.element_at("quantiles", n + 1)).alias(c) for n, c in enumerate(["q10", "q50", "q999", "q0", "q100"])])


@query("E9_spike_classification", sql(f"""
    SELECT {rs('t')} AS spike_threshold, tp AS spike_tp, fp AS spike_fp, fn AS spike_fn, tn AS spike_tn, tp + fn AS spike_support,
      {rs('CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0e0 END')} AS spike_precision,
      {rs('CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0e0 END')} AS spike_recall,
      {rs('CASE WHEN tp > 0 THEN 2e0 * tp / (2 * tp + fp + fn) ELSE 0e0 END')} AS spike_f1_score
    FROM (SELECT max(t) AS t, count(*) FILTER (actual > t AND predicted > t) AS tp, count(*) FILTER (actual <= t AND predicted > t) AS fp,
        count(*) FILTER (actual > t AND predicted <= t) AS fn, count(*) FILTER (actual <= t AND predicted <= t) AS tn
      FROM fc, (SELECT quantile_cont(actual, 8e-1) AS t FROM fc))""", "fc"))
def e9(spark: SparkSession, d: str) -> DataFrame:
    return _round_all(Sc.spike_classification(forecast_frame(spark, d)))


@query("E10_per_horizon_errors", sql(f"""
    SELECT {i('t.rn - b.rn')} AS horizon_step, {rs(f'avg(abs(b.m - t.{V}))')} AS mae, {rs(f'sqrt(avg((b.m - t.{V}) * (b.m - t.{V})))')} AS rmse
    FROM (SELECT *, avg({V}) OVER (PARTITION BY CATEGORY ORDER BY ACTUALSHIPDATE ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS m FROM n) b
    JOIN n t ON t.CATEGORY = b.CATEGORY AND t.rn BETWEEN b.rn + 1 AND b.rn + 7 WHERE b.rn >= 14 AND b.rn <= b.n - 7 GROUP BY ALL""", "dense",
    extra={"n": "SELECT *, row_number() OVER (PARTITION BY CATEGORY ORDER BY ACTUALSHIPDATE) AS rn, count(*) OVER (PARTITION BY CATEGORY) AS n FROM dense"}))
def e10(spark: SparkSession, d: str) -> DataFrame:
    windows = sampling.sliding_windows(S.dense(spark, d), 14, 7, [CBM])
    mean = F.aggregate(F.flatten("x"), F.lit(0.0), lambda a, v: a + v) / 14
    return _round_all(Sc.per_horizon_errors(sampling.explode_windows(windows.withColumn("p", F.array_repeat(mean, 7)), "p")))


def brand_scores(group: str) -> str:
    return f"""SELECT {group}, count(*) AS num_predictions, count(actual) AS num_with_actuals, {rs(MAE)} AS mae, {rs(f'sqrt({MSE})')} AS rmse,
      {rs(f'avg(abs{E_} / abs(actual)) FILTER (actual <> 0) * 100')} AS mape, {rs('sum(predicted) FILTER (actual IS NOT NULL)')} AS total_predicted,
      {rs('sum(actual)')} AS total_actual, {rs(f'sum{E_}')} AS total_error,
      {rs(f'CASE WHEN sum(actual) <> 0 THEN (1 - abs(sum{E_}) / abs(sum(actual))) * 100 END')} AS accuracy_pct FROM x"""


@query("E11_brand_accuracy", sql(f"""{brand_scores('CATEGORY, BRAND')} GROUP BY CATEGORY, BRAND
    UNION ALL {brand_scores('CATEGORY, NULL AS BRAND')} GROUP BY CATEGORY""", "fcb",
    extra={"x": "SELECT date, CATEGORY, BRAND, predicted, CASE WHEN day(date) <> 13 THEN actual END AS actual FROM fcb"}))
def e11(spark: SparkSession, d: str) -> DataFrame:
    """Actuals of the 13th are missing."""
    rows = forecast_frame(spark, d, (CATEGORY, BRAND)).withColumn("actual", F.when(F.dayofmonth("date") != 13, F.col("actual")))
    return _round_all(Sc.brand_accuracy(rows))


BUCKET = f"""count(*) AS samples, {rs(MAE)} AS mae, {rs(f'sqrt({MSE})')} AS rmse, {rs(f'avg(abs{E_} / actual) FILTER (actual > 0) * 100')} AS mape,
    {rs('count(*) FILTER (predicted > actual) / count(*)::DOUBLE * 100')} AS over_pred_rate, {rs(f'avg{E_}')} AS avg_error, {rs('avg(actual)')} AS avg_actual,
    {rs('avg(predicted)')} AS avg_predicted"""
BUCKETS = " UNION ALL ".join(f"SELECT '{n}' AS bucket, {BUCKET} FROM fc WHERE day(date) BETWEEN {lo} AND {hi}" for n, lo, hi in Sc.DAY_BUCKETS)


@query("E12_day_of_month_buckets", sql(BUCKETS, "fc"))
def e12(spark: SparkSession, d: str) -> DataFrame:
    return _round_all(Sc.day_of_month_buckets(forecast_frame(spark, d)))


@query("E12_early_month_checks", sql("""
    SELECT max(mape) FILTER (bucket = 'days_1_10') < 30 AS early_mape_ok, max(over_pred_rate) FILTER (bucket = 'days_1_10') < 70 AS over_pred_ok,
      max(avg_error) FILTER (bucket = 'days_1_10') < 100 AS avg_error_ok, max(mae) FILTER (bucket = 'days_1_3') < 300 AS days_1_3_ok FROM x""",
    "fc", extra={"x": BUCKETS}))
def e12_checks(spark: SparkSession, d: str) -> DataFrame:
    return Sc.early_month_checks(Sc.day_of_month_buckets(forecast_frame(spark, d)))


@query("E13_weighted_losses", sql(f"""
    SELECT {rs('avg(w * e * e)', 4)} AS spike_mse, {rs('avg(w * sl)', 4)} AS spike_smooth_l1, {rs('avg(w * f * e * e)', 4)} AS asymmetric_mse,
      {rs('avg(w * f * e * e) + 1e-1 * pow(avg(e), 2)', 4)} AS balanced_mse, {rs('avg(w * f * sl) + 1e-1 * pow(avg(e), 2)', 4)} AS balanced_smooth_l1,
      {rs('avg(CASE WHEN e <= 0 THEN 9e-1 * -e ELSE 1e-1 * e END * CASE WHEN peak THEN 5e0 ELSE 1e0 END)', 4)} AS pinball,
      {rs('avg(CASE WHEN abs(e) <= 1 THEN 5e-1 * e * e ELSE abs(e) - 5e-1 END)', 4)} AS huber,
      {rs('avg(pow(abs(e) / (mx + 1e-8) + 1e-8, 2) * e * e)', 4)} AS focal
    FROM (SELECT *, CASE WHEN peak THEN 1e0 WHEN e > 0 THEN 2e0 ELSE 1e0 END AS f,
        CASE WHEN abs(e) < 1 THEN 5e-1 * e * e ELSE abs(e) - 5e-1 END AS sl FROM (
      SELECT predicted - actual AS e, max(abs(predicted - actual)) OVER () AS mx, actual > t OR month(date) = 8 AS peak,
        (CASE WHEN actual > t THEN 3e0 ELSE 1e0 END) * (CASE isodow(date) WHEN 1 THEN 3e0 ELSE 1e0 END)
        * (CASE WHEN day(date) <= 5 THEN 50e0 WHEN day(date) <= 10 THEN 50e0 * pow(50e0, -(day(date) - 5) / 5e0) ELSE 1e0 END) AS w
      FROM fc, (SELECT quantile_cont(actual, 8e-1) AS t FROM fc)))""", "fc"))
def e13(spark: SparkSession, d: str) -> DataFrame:
    rows = forecast_frame(spark, d)
    rows = rows.withColumn("t", quantiles.quantile_column(rows, "actual", 0.8))
    profile = WeightProfile(weekday={0: 3.0}, early_month_base=50.0)
    rows = rows.withColumns({"weight": sample_weight("actual", "date", "t", profile),
                             "is_peak": ((F.col("actual") > F.col("t")) | (F.month("date") == 8)).cast("int")})
    out = Sc.weighted_losses(rows, season="is_peak", season_weight=5.0)
    return rounded(out, *out.columns, digits=4)


def profile_sql(name: str, cond: str) -> str:
    return f"""SELECT '{name}' AS part, count(*) AS rows, {rs('avg(actual)')} AS mean, {rs('min(actual)')} AS min, {rs('max(actual)')} AS max,
      {rs('stddev_samp(actual)')} AS std, count(*) FILTER (actual = 0) AS zeros, count(*) FILTER (actual < 50) AS below_50,
      count(*) FILTER (actual < 100) AS below_100, {rs('avg(predicted) - avg(actual)')} AS bias,
      {rs(f'coalesce(sum(abs{E_}) FILTER (actual = 0), 0e0) / sum(abs{E_}) * 100')} AS zero_day_error_pct, {rs('median(actual)')} AS median
      FROM x WHERE {cond}"""


SCALED = "SELECT date, CATEGORY, predicted * 25 AS predicted, actual * 25 AS actual FROM fc"


def scaled_frame(spark: SparkSession, d: str) -> DataFrame:
    """Volumes times 25, so that all value ranges are used."""
    return forecast_frame(spark, d).withColumns({"predicted": F.col("predicted") * 25, "actual": F.col("actual") * 25})


@query("E14_actuals_profile", sql(" UNION ALL ".join([profile_sql("all", "true"), profile_sql("early", "day(date) <= 10"),
                                                      profile_sql("rest", "day(date) > 10")]), "fc", extra={"x": SCALED}))
def e14(spark: SparkSession, d: str) -> DataFrame:
    return _round_all(Sc.actuals_profile(scaled_frame(spark, d)))


@query("E15_mape_by_range", sql(f"""
    SELECT range, count(*) AS samples, {rs(f'avg(abs{E_} / (actual + 1e-8)) * 100', 2)} AS mape FROM (SELECT *, CASE WHEN actual >= 0 AND actual < 100 THEN '0-100'
      WHEN actual >= 100 AND actual < 300 THEN '100-300' WHEN actual >= 300 AND actual < 500 THEN '300-500' WHEN actual >= 500 AND actual < 700 THEN '500-700'
      WHEN actual >= 700 AND actual < 2000 THEN '700-2000' WHEN actual >= 2000 THEN '2000+' WHEN actual < 0 THEN 'below 0' END AS range FROM x) WHERE range IS NOT NULL GROUP BY ALL""", "fc", extra={"x": SCALED}))
def e15(spark: SparkSession, d: str) -> DataFrame:
    """Zero days belong to the first range and dominate it: their ratio divides by 1e-8."""
    return rounded(Sc.mape_by_range(scaled_frame(spark, d)), "mape", digits=2)


def run_frame(spark: SparkSession, d: str) -> DataFrame:
    """Each year is a run; two baselines are its modes."""
    run = F.year("date").cast("string").alias("run_id")
    mean = forecast_frame(spark, d).select(run, F.lit("recursive").alias("mode"), "predicted", "actual")
    naive = X.baseline_forecast(S.dense(spark, d), "seasonal_naive").select(
        run, F.lit("teacher_forcing").alias("mode"), "predicted", "actual")
    return mean.unionByName(naive)


RUNS = f"""SELECT run_id, mode, avg(abs(predicted - actual)) AS mae, avg((predicted - actual) * (predicted - actual)) AS mse,
    sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse FROM (
      SELECT CAST(year(date) AS VARCHAR) AS run_id, 'recursive' AS mode, predicted, actual FROM fc
      UNION ALL SELECT CAST(year(d) AS VARCHAR), 'teacher_forcing', p, a FROM (SELECT ACTUALSHIPDATE AS d, {V} AS a,
        lag({V}, 7) OVER (PARTITION BY CATEGORY ORDER BY ACTUALSHIPDATE) AS p FROM dense) WHERE p IS NOT NULL) GROUP BY ALL"""


@query("E17_compare_runs", sql(f"""
    SELECT o.run_id AS best_run, {rs('o.mae')} AS best_mae, {rs('o.rmse')} AS best_rmse, {rs('c.mae')} AS current_mae, {rs('c.rmse')} AS current_rmse,
      {rs('(o.mae - c.mae) / o.mae * 100')} AS mae_improvement_pct, {rs('(o.rmse - c.rmse) / o.rmse * 100')} AS rmse_improvement_pct
    FROM (SELECT * FROM x WHERE mode = 'teacher_forcing' AND run_id <> '2001' ORDER BY mae, run_id LIMIT 1) o,
      (SELECT * FROM x WHERE mode = 'teacher_forcing' AND run_id = '2001') c""", "fc", extra={"x": RUNS}))
def e17(spark: SparkSession, d: str) -> DataFrame:
    return _round_all(Sc.compare_runs(Sc.run_scores(run_frame(spark, d)), "2001"))


def delta(c: str) -> str:
    tail = "" if c == "mse" else f", {rs(f'CASE WHEN t.{c} <> 0 THEN (q.{c} / t.{c} - 1) * 100 END')} AS {c}_increase_pct"
    return f"{rs(f't.{c}')} AS teacher_forcing_{c}, {rs(f'q.{c}')} AS recursive_{c}, {rs(f'q.{c} - t.{c}')} AS {c}_difference{tail}"


@query("E18_mode_delta", sql(f"""SELECT run_id, {delta('mae')}, {delta('mse')}, {delta('rmse')}
    FROM (SELECT * FROM x WHERE mode = 'teacher_forcing') t JOIN (SELECT * FROM x WHERE mode = 'recursive') q USING (run_id)""", "fc", extra={"x": RUNS}))
def e18(spark: SparkSession, d: str) -> DataFrame:
    return _round_all(Sc.mode_delta(Sc.run_scores(run_frame(spark, d))))
