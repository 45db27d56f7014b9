"""Forecast scores as aggregates over `actual` and `predicted`.

Every score is a partial aggregation, so a hot key is combined on the map side. Quantile
thresholds of a whole frame use `exact_quantiles`. The error is `predicted - actual`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..columns import BRAND, CATEGORY
from ..functions import measures as M
from ..functions.cleaning import as_column
from ..session import cut_lineage
from .quantiles import exact_quantiles, grouped_quantiles, quantile_column

Keys = Sequence[str]


def _act() -> Column:
    return F.col("actual")


def _pred() -> Column:
    return F.col("predicted")


def _err() -> Column:
    return F.col("predicted") - F.col("actual")


def _grouped(df: DataFrame, by: Keys, aggs: Sequence[Column]) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def _when(condition: Column | None, value: Column) -> Column:
    return value if condition is None else F.when(condition, value)


def mae(condition: Column | None = None) -> Column:
    return F.avg(_when(condition, F.abs(_err())))


def mse(condition: Column | None = None) -> Column:
    return F.avg(_when(condition, _err() * _err()))


def rmse(condition: Column | None = None) -> Column:
    return F.sqrt(mse(condition))


def error_metrics(df: DataFrame, by: Keys = (), mask: Column | None = None) -> DataFrame:
    """E1. `mask` keeps the rows where it is true."""
    return _grouped(df, by, [mae(mask).alias("mae"), mse(mask).alias("mse"), rmse(mask).alias("rmse")])


def _accuracy(numerator: Column, denominator: Column) -> Column:
    return (F.when(denominator == 0, F.lit(None).cast("double"))
            .when(numerator > denominator, F.lit(0.0))
            .otherwise(F.lit(100.0) - numerator / denominator * F.lit(100.0)))


def accuracy_abs() -> Column:
    """E2. By the sum of absolute errors; rows with a null on either side are skipped."""
    both = _act().isNotNull() & _pred().isNotNull()
    return _accuracy(F.sum(F.when(both, F.abs(_err()))), F.sum(F.when(both, F.abs(_act()))))


def accuracy_net() -> Column:
    """E3. By the absolute value of the summed error."""
    both = _act().isNotNull() & _pred().isNotNull()
    return _accuracy(F.abs(F.sum(F.when(both, _err()))), F.sum(F.when(both, F.abs(_act()))))


def accuracy(df: DataFrame, by: Keys = ()) -> DataFrame:
    return _grouped(df, by, [accuracy_abs().alias("accuracy_abs"), accuracy_net().alias("accuracy_net")])


def totals_by_day(df: DataFrame) -> DataFrame:
    """A5."""
    return df.groupBy("date").agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"))


def totals_by_month(df: DataFrame) -> DataFrame:
    """A5."""
    month = F.trunc("date", "MM").alias("month")
    return df.groupBy(month).agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"))


def monthly_results(df: DataFrame, category: str = CATEGORY) -> DataFrame:
    """A6."""
    out = df.groupBy(F.year("date").alias("Year"), category, F.month("date").alias("Month")).agg(
        F.sum("predicted").alias("predicted"), F.sum("actual").alias("actual"))
    return out.withColumn("error", _err()).withColumn("abs_error", F.abs("error"))


def accuracy_by(df: DataFrame, category: str = CATEGORY) -> DataFrame:
    """E4. Overall from monthly totals, per month from daily totals, per category and month
    from daily rows. The totals are built from each other, not from the rows again."""
    days = totals_by_day(df)
    none, no_month = F.lit(None).cast("string"), F.lit(None).cast("date")
    sums = [F.sum(F.abs(_act())).alias("total_actual"), F.sum(F.abs(_pred())).alias("total_predicted")]
    scores = [accuracy_abs().alias("accuracy_abs"), accuracy_net().alias("accuracy_net"), *sums]
    overall = totals_by_month(days).agg(*scores).select(
        F.lit("overall").alias("level"), none.alias(category), no_month.alias("month"), "*")
    month = F.trunc("date", "MM").alias("month")
    per_month = days.groupBy(month).agg(*scores).select(F.lit("month").alias("level"), none.alias(category), "*")
    per_cat = df.groupBy(category, month).agg(*scores).select(F.lit("category_month").alias("level"), "*")
    return overall.unionByName(per_month).unionByName(per_cat)


def quantile_coverage(df: DataFrame, q: float = 0.9, by: Keys = (), mask: Column | None = None) -> DataFrame:
    """E5."""
    rows = df if mask is None else df.filter(mask)
    covered, total = F.count(F.when(_act() < _pred(), 1)), F.count(F.lit(1))
    rate = F.coalesce(F.try_divide(covered.cast("double"), total), F.lit(0.0))
    return _grouped(rows, by, [
        rate.alias("coverage_rate"), F.lit(q).alias("target_coverage"),
        (rate - F.lit(q)).alias("coverage_error"), F.count(F.when(_act() > _pred(), 1)).alias("under_coverage"),
        covered.alias("over_coverage"), total.alias("total_count"),
        F.coalesce(F.avg(F.when(_act() > _pred(), _act() - _pred())), F.lit(0.0)).alias("mean_excess")])


def segmented_metrics(df: DataFrame, q: float = 0.8, date: str = "date") -> DataFrame:
    """E6. One wide row: spikes and the rest, bias, and weekdays."""
    kept = cut_lineage(df.select(date, "actual", "predicted"), "scores")  # for the threshold and the scores
    rows = kept.withColumn("_t", quantile_column(kept, "actual", q)).withColumn("_dow", F.weekday(date))
    spike, dow = _act() > F.col("_t"), F.col("_dow")
    over, total = F.count(F.when(_err() > 0, 1)), F.count(F.lit(1))
    under = F.count(F.when(_err() <= 0, 1))
    aggs = [F.max("_t").alias("threshold"),
            F.count(F.when(spike, 1)).alias("spike_count"), F.count(F.when(~spike, 1)).alias("non_spike_count"),
            mae(spike).alias("spike_mae"), rmse(spike).alias("spike_rmse"),
            mae(~spike).alias("non_spike_mae"), rmse(~spike).alias("non_spike_rmse"),
            over.alias("over_pred_count"), under.alias("under_pred_count"),
            (F.try_divide(over, total) * 100).alias("over_pred_pct"), (F.try_divide(under, total) * 100).alias("under_pred_pct")]
    for name, days in (("monday", [0]), ("wednesday", [2]), ("friday", [4]), ("high_volume_days", [0, 2, 4])):
        on = dow.isin(*days)
        aggs += [mae(on).alias(f"{name}_mae"), rmse(on).alias(f"{name}_rmse"),
                 F.count(F.when(on, 1)).alias(f"{name}_count")]
    return rows.agg(*aggs)


def residual_statistics(df: DataFrame, by: Keys = ()) -> DataFrame:
    """E7. Moments of `actual - predicted`; the shape is null below two rows."""
    r = _act() - _pred()
    enough = F.count(F.lit(1)) >= 2
    return _grouped(df, by, [F.avg(r).alias("residual_mean"), F.stddev_pop(r).alias("residual_std"),
                             F.when(enough, F.skewness(r)).alias("residual_skewness"),
                             F.when(enough, F.kurtosis(r)).alias("residual_kurtosis")])


def percentile_errors(df: DataFrame, percentiles: Sequence[int] = (90, 95), mask: Column | None = None) -> DataFrame:
    """E8."""
    rows = (df if mask is None else df.filter(mask)).select(F.abs(_err()).alias("_e"))
    values = exact_quantiles(rows, "_e", [p / 100.0 for p in percentiles])
    return values.select(*[F.get("quantiles", i).alias(f"p{p}_abs_error")
                           for i, p in enumerate(percentiles)])


def spike_classification(df: DataFrame, threshold: float | None = None, q: float = 0.8,
                         mask: Column | None = None) -> DataFrame:
    """E9. Does the forecast exceed the threshold when the actual does?"""
    rows = (df if mask is None else df.filter(mask)).select("actual", "predicted")
    if threshold is None:
        rows = cut_lineage(rows, "scores")
    limit = F.lit(float(threshold)) if threshold is not None else quantile_column(rows, "actual", q)
    rows = rows.withColumn("_t", limit)
    a, p = _act() > F.col("_t"), _pred() > F.col("_t")

    def n(c: Column) -> Column:
        return F.count(F.when(c, 1))

    counts = rows.agg(F.max("_t").alias("spike_threshold"), n(a & p).alias("spike_tp"), n(~a & p).alias("spike_fp"),
                      n(a & ~p).alias("spike_fn"), n(~a & ~p).alias("spike_tn"), n(a).alias("spike_support"))
    tp, fp, fn = F.col("spike_tp"), F.col("spike_fp"), F.col("spike_fn")

    def share(num: Column, den: Column) -> Column:
        return F.when(den > 0, num / den).otherwise(F.lit(0.0))

    precision, recall = F.col("spike_precision"), F.col("spike_recall")
    return (counts.withColumns({"spike_precision": share(tp, tp + fp), "spike_recall": share(tp, tp + fn)})
            .withColumn("spike_f1_score", share(2 * precision * recall, precision + recall)))


def per_horizon_errors(df: DataFrame) -> DataFrame:
    """E10."""
    return df.groupBy("horizon_step").agg(mae().alias("mae"), rmse().alias("rmse"))


def brand_accuracy(df: DataFrame, category: str = CATEGORY, brand: str = BRAND) -> DataFrame:
    """E11. Per brand and, from the same aggregation, a total row per category with a null
    brand. Predicted totals count rows with an actual only; without any, all rows."""
    known = _act().isNotNull()
    n = F.count(F.when(known, 1))
    total_p = F.when(n > 0, F.sum(F.when(known, _pred()))).otherwise(F.sum(_pred()))
    scores = _brand_scores(known, n, total_p, F.sum(_act()), F.sum(F.when(known, _err())))
    return df.groupingSets([[F.col(category), F.col(brand)], [F.col(category)]], F.col(category), F.col(brand)).agg(*scores)


def _brand_scores(known: Column, n: Column, total_p: Column, total_a: Column, total_e: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("num_predictions"), n.alias("num_with_actuals"),
            mae(known).alias("mae"), rmse(known).alias("rmse"),
            (F.avg(F.when(_act() != 0, F.abs(_err()) / F.abs(_act()))) * 100).alias("mape"),
            total_p.alias("total_predicted"), total_a.alias("total_actual"), total_e.alias("total_error"),
            F.when(total_a != 0, (F.lit(1.0) - F.abs(total_e) / F.abs(total_a)) * 100).alias("accuracy_pct")]


# Overlapping day buckets and the four limits.
DAY_BUCKETS = (("days_1_3", 1, 3), ("days_4_10", 4, 10), ("days_1_10", 1, 10), ("days_11_31", 11, 31))
MAPE_LIMIT, OVER_LIMIT, BIAS_LIMIT, FIRST_DAYS_LIMIT = 30, 70, 100, 300


def day_of_month_buckets(df: DataFrame, date: str = "date") -> DataFrame:
    """E12. A row counts in each bucket that holds its day."""
    day = F.dayofmonth(date)
    names = F.array_compact(F.array(*[F.when(day.between(lo, hi), F.lit(n)) for n, lo, hi in DAY_BUCKETS]))
    return (df.select("actual", "predicted", F.explode(names).alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("samples"), mae().alias("mae"), rmse().alias("rmse"),
        (F.avg(F.when(_act() > 0, F.abs(_err()) / _act())) * 100).alias("mape"),
        (F.count(F.when(_pred() > _act(), 1)) / F.count(F.lit(1)) * 100).alias("over_pred_rate"),
        F.avg(_err()).alias("avg_error"), F.avg(_act()).alias("avg_actual"), F.avg(_pred()).alias("avg_predicted")))


def early_month_checks(buckets: DataFrame) -> DataFrame:
    """E12. The four pass/fail checks as one row."""
    def of(bucket: str, metric: str) -> Column:
        return F.max(F.when(F.col("bucket") == bucket, F.col(metric)))

    return buckets.agg((of("days_1_10", "mape") < MAPE_LIMIT).alias("early_mape_ok"),
                       (of("days_1_10", "over_pred_rate") < OVER_LIMIT).alias("over_pred_ok"),
                       (of("days_1_10", "avg_error") < BIAS_LIMIT).alias("avg_error_ok"),
                       (of("days_1_3", "mae") < FIRST_DAYS_LIMIT).alias("days_1_3_ok"))


def weighted_losses(df: DataFrame, weight: str = "weight", peak: str = "is_peak", q: float = 0.9,
                    over: float = 2.0, under: float = 1.0, mean_error_weight: float = 0.1,
                    beta: float = 1.0, delta: float = 1.0, alpha: float = 1.0, gamma: float = 2.0,
                    season: str | None = None, season_weight: float = 1.0) -> DataFrame:
    """E13. Spike-aware weighted squared and smooth-L1 loss with the asymmetric factor outside
    peaks and the mean-error term, pinball (optionally season-weighted), Huber and focal."""
    worst = df.agg(F.max(F.abs(_err()))).scalar()
    w = as_column(weight) * M.asymmetric_factor(_pred(), _act(), as_column(peak).cast("boolean"), over, under)
    bias = F.avg(_err())
    constraint = F.lit(mean_error_weight) * bias * bias
    in_season = F.lit(1.0) if season is None else F.when(as_column(season) > 0.5, season_weight).otherwise(1.0)
    return df.agg(
        F.avg(as_column(weight) * M.squared_error(_pred(), _act())).alias("spike_mse"),
        F.avg(as_column(weight) * M.smooth_l1(_pred(), _act(), beta)).alias("spike_smooth_l1"),
        F.avg(w * M.squared_error(_pred(), _act())).alias("asymmetric_mse"),
        (F.avg(w * M.squared_error(_pred(), _act())) + constraint).alias("balanced_mse"),
        (F.avg(w * M.smooth_l1(_pred(), _act(), beta)) + constraint).alias("balanced_smooth_l1"),
        F.avg(M.pinball(_pred(), _act(), q) * in_season).alias("pinball"),
        F.avg(M.huber(_pred(), _act(), delta)).alias("huber"),
        F.avg(M.focal(_pred(), _act(), worst, alpha, gamma)).alias("focal"))


def actuals_profile(df: DataFrame, date: str = "date") -> DataFrame:
    """E14. Distribution of the actuals by part of the month (all, early, rest) with the bias
    and the error share of zero days. Medians are exact; the rows are stored once for both passes."""
    day = F.dayofmonth(date)
    parts = {"all": F.lit(True), "early": day <= 10, "rest": day > 10}
    named = cut_lineage(df.select(F.explode(F.array_compact(F.array(
        *[F.when(c, F.lit(n)) for n, c in parts.items()]))).alias("part"), "actual", "predicted"), "profile")
    median = grouped_quantiles(named, ["part"], "actual", [0.5]).select("part", F.get("quantiles", F.lit(0)).alias("median"))
    zero = _act() == 0
    stats = named.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(_act()).alias("mean"), F.min(_act()).alias("min"), F.max(_act()).alias("max"),
        F.stddev_samp(_act()).alias("std"), F.count(F.when(zero, 1)).alias("zeros"),
        F.count(F.when(_act() < 50, 1)).alias("below_50"), F.count(F.when(_act() < 100, 1)).alias("below_100"),
        (F.avg(_pred()) - F.avg(_act())).alias("bias"),
        (F.try_divide(F.sum(F.when(zero, F.abs(_err())).otherwise(0.0)), F.sum(F.abs(_err()))) * 100).alias("zero_day_error_pct"))
    return stats.join(median, "part", "left")


# Ranges of the actual, upper bound exclusive.
VALUE_RANGES = ((0, 100), (100, 300), (300, 500), (500, 700), (700, 2000))


def mape_by_range(df: DataFrame, ranges: Sequence[tuple[float, float]] = VALUE_RANGES) -> DataFrame:
    """E15. Actuals below the first range or from the end of the last one on have a row of their own."""
    name = F.when(_act() < ranges[0][0], F.lit(f"below {ranges[0][0]}")).when(_act() >= ranges[-1][1], F.lit(f"{ranges[-1][1]}+"))
    for lo, hi in ranges:
        name = F.when((_act() >= lo) & (_act() < hi), F.lit(f"{lo}-{hi}")).otherwise(name)
    return (df.withColumn("range", name).filter(F.col("range").isNotNull()).groupBy("range")
            .agg(F.count(F.lit(1)).alias("samples"),
                 (F.avg(F.abs(_err()) / (_act() + F.lit(1e-8))) * 100).alias("mape")))


def run_scores(rows: DataFrame, run: str = "run_id", mode: str = "mode") -> DataFrame:
    """S12. Scores per run and mode from stored rows; rows without an actual are skipped."""
    return rows.filter(_act().isNotNull()).groupBy(run, mode).agg(
        mae().alias("mae"), mse().alias("mse"), rmse().alias("rmse"))


def compare_runs(scores: DataFrame, current: str, run: str = "run_id", mode: str = "teacher_forcing") -> DataFrame:
    """E17. The current run against the earlier run with the lowest teacher-forcing MAE."""
    tf = scores.filter((F.col("mode") == mode) & F.col("mae").isNotNull())
    is_current = F.col(run) == current

    def best(c: str) -> Column:
        return F.min_by(F.when(~is_current, F.col(c)), F.when(~is_current, F.struct("mae", run)))

    def mine(c: str) -> Column:
        return F.max(F.when(is_current, F.col(c)))

    def gain(c: str) -> Column:
        return F.try_divide(F.col(f"best_{c}") - F.col(f"current_{c}"), F.col(f"best_{c}")) * 100

    row = tf.agg(best(run).alias("best_run"), *[best(c).alias(f"best_{c}") for c in ("mae", "rmse")],
                 *[mine(c).alias(f"current_{c}") for c in ("mae", "rmse")])
    return row.withColumns({"mae_improvement_pct": gain("mae"), "rmse_improvement_pct": gain("rmse")})


def mode_delta(scores: DataFrame, run: str = "run_id") -> DataFrame:
    """E18. Recursive against teacher forcing per run."""
    def of(mode: str, c: str) -> Column:
        return F.max(F.when(F.col("mode") == mode, F.col(c))).alias(f"{mode}_{c}")

    wide = scores.groupBy(run).agg(*[of(m, c) for m in ("teacher_forcing", "recursive")
                                     for c in ("mae", "mse", "rmse")])
    out = wide
    for c in ("mae", "mse", "rmse"):
        rec, tf = F.col(f"recursive_{c}"), F.col(f"teacher_forcing_{c}")
        out = out.withColumn(f"{c}_difference", rec - tf)
        if c != "mse":
            out = out.withColumn(f"{c}_increase_pct", F.when(tf != 0, (rec / tf - 1) * 100))
    return out
