import numpy as np
import pytest
from pyspark.sql import functions as F

from cargotide.functions.measures import WeightProfile, sample_weight
from cargotide.operators import scoring as S
from conftest import days


def frame(spark, actual, predicted, start="2025-01-01"):
    return spark.createDataFrame([(d, None if a is None else float(a), float(p)) for d, a, p in zip(days(start, len(actual)), actual, predicted)],
                                 "date date, actual double, predicted double")


RNG = np.random.default_rng(7)
ACTUAL = RNG.gamma(2.0, 50.0, 400).round(3)
PREDICTED = (ACTUAL + RNG.normal(5, 20, 400)).round(3)


def test_basic_scores_against_numpy(spark):
    df = frame(spark, ACTUAL, PREDICTED)
    e = PREDICTED - ACTUAL
    r = S.error_metrics(df).first()
    assert (r.mae, r.mse, r.rmse) == pytest.approx((abs(e).mean(), (e ** 2).mean(), np.sqrt((e ** 2).mean())))
    r = S.accuracy(df).first()
    assert r.accuracy_abs == pytest.approx(100 - abs(e).sum() / ACTUAL.sum() * 100)
    assert r.accuracy_net == pytest.approx(100 - abs(e.sum()) / ACTUAL.sum() * 100)
    r = S.percentile_errors(df).first()
    assert (r.p90_abs_error, r.p95_abs_error) == pytest.approx(tuple(np.percentile(abs(e), [90, 95])))
    r = S.residual_statistics(df).first()
    x = -e - (-e).mean()
    assert r.residual_skewness == pytest.approx((x ** 3).mean() / (x ** 2).mean() ** 1.5)
    assert r.residual_kurtosis == pytest.approx((x ** 4).mean() / (x ** 2).mean() ** 2 - 3)
    t = np.quantile(ACTUAL, 0.8)
    r = S.segmented_metrics(df).first()
    assert r.threshold == pytest.approx(t) and r.spike_count == (ACTUAL > t).sum()
    assert r.spike_mae == pytest.approx(abs(e[ACTUAL > t]).mean())


def test_accuracy_edges(spark):
    assert S.accuracy(frame(spark, [0.0, 0.0], [1.0, 2.0])).first().accuracy_abs is None
    assert S.accuracy(frame(spark, [1.0, 1.0], [9.0, 9.0])).first().accuracy_abs == 0.0
    assert S.accuracy(frame(spark, [10.0, None], [9.0, 99.0])).first().accuracy_abs == pytest.approx(90.0)


def test_spike_classification_without_any_hit(spark):
    r = S.spike_classification(frame(spark, [1, 1, 1, 9], [0, 0, 0, 0]), threshold=5).first()
    assert (r.spike_tp, r.spike_fn, r.spike_precision, r.spike_recall, r.spike_f1_score) == (0, 1, 0.0, 0.0, 0.0)


def test_empty_frame(spark):
    r = S.quantile_coverage(frame(spark, [1.0], [2.0]).filter("false")).first()
    assert (r.coverage_rate, r.total_count, r.mean_excess) == (0.0, 0, 0.0)


def test_brand_scores_with_missing_actuals(spark):
    df = frame(spark, [None, 10.0, 0.0], [5.0, 8.0, 1.0]).withColumns({"CATEGORY": F.lit("DRY"), "BRAND": F.lit("B")})
    rows = {r.BRAND: r for r in S.brand_accuracy(df).collect()}
    assert set(rows) == {"B", None}
    r = rows["B"]
    assert (r.num_predictions, r.num_with_actuals, r.total_predicted, r.total_actual) == (3, 2, 9.0, 10.0)
    assert r.mape == pytest.approx(20.0) and r.accuracy_pct == pytest.approx(90.0)


def losses(spark, actual, predicted, **kw):
    df = frame(spark, actual, predicted).withColumns({"weight": F.lit(1.0), "is_peak": F.lit(0)})
    return S.weighted_losses(df, **kw).first()


def test_over_prediction_costs_more_outside_peaks(spark):
    actual = [40 + i % 20 for i in range(70)] + [70 + i % 20 for i in range(30)]
    over, under = losses(spark, actual, [a + 20 for a in actual]), losses(spark, actual, [a - 20 for a in actual])
    assert over.asymmetric_mse == pytest.approx(2 * under.asymmetric_mse)
    assert over.spike_mse == pytest.approx(under.spike_mse)
    assert under.pinball == pytest.approx(9 * over.pinball)


def test_mean_error_term_punishes_a_bias(spark):
    actual = [60.0] * 40
    noise = [15.0 if n % 2 else -15.0 for n in range(40)]
    fair, biased = losses(spark, actual, [60 + e for e in noise], over=1.0), losses(spark, actual, [75.0] * 40, over=1.0)
    assert fair.balanced_mse == pytest.approx(fair.asymmetric_mse)
    assert biased.balanced_mse == pytest.approx(biased.asymmetric_mse + 0.1 * 15 ** 2)


def test_spikes_weigh_three_times(spark):
    df = frame(spark, [50.0] * 80 + [200.0] * 20, [0.0] * 100).withColumn("CATEGORY", F.lit("DRY"))
    rows = df.withColumn("w", sample_weight("actual", "date", F.lit(100.0), WeightProfile(weekday={0: 2.0}))).collect()
    assert {(r.actual, r.date.weekday() == 0): r.w for r in rows} == {
        (50.0, False): 1.0, (50.0, True): 2.0, (200.0, False): 3.0, (200.0, True): 6.0}


def test_huber_and_smooth_l1_agree_at_one(spark):
    r = losses(spark, [0.0, 0.0], [0.5, 3.0])
    assert r.huber == pytest.approx((0.125 + 2.5) / 2) == pytest.approx(r.spike_smooth_l1)
    assert losses(spark, [0.0, 0.0], [0.0, 0.0]).focal == 0.0
