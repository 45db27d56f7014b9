"""The three batch jobs, from raw lines to a scored forecast. Each is one DataFrame plan per
written result; the operators stay usable on their own."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..columns import BRAND, CATEGORY, CBM, DATE, PANEL_KEYS, QTY, SERIES_KEYS
from ..functions import calendar as K, lunar as L
from ..functions.cleaning import UNIT_RULES, UnitRule
from ..operators import events, feature_forecast, history, panel, rejects as reject, rules, sampling, scoring, series, stats
from ..operators.feature_forecast import FeatureSet
from ..operators.regression import Reweight
from ..sources import writers
from ..session import cut_lineage
from ..sources.calendars import holiday_dates

Keys = Sequence[str]


def panel_job(lines: DataFrame, master: DataFrame, path: str, scope: str = "year",
              unit_rules: Sequence[UnitRule] = UNIT_RULES, fmt: str = "parquet", rejects: Observation | None = None,
              unreadable: str | None = None) -> DataFrame:
    """Raw lines to the gap-free daily panel, written by year; returns the written table, so
    summaries and features do not read the lines again. `rejects` is filled with the number of lines per
    reject reason, counted in the pass that aggregates them."""
    known = panel.load_sku_master(master)
    if rejects is None:
        daily = panel.daily_panel(lines, known, unit_rules)
    else:
        marked = reject.observed(reject.mark_lines(lines, known, unreadable=unreadable), rejects)
        daily = cut_lineage(panel.panel_of(reject.good_lines(marked), unit_rules), "daily")
    writers.write_panel(panel.densify_calendar(daily, PANEL_KEYS, scope), path, fmt)
    return lines.sparkSession.read.format(fmt).load(path)


def calendar_features(df: DataFrame, calendar: DataFrame, anchors: L.Anchors = L.MID_AUTUMN_ANCHORS,
                      date: str = DATE, category: str = CATEGORY, season_rule: str = "lunar_gregorian",
                      golden_rule: str = "gregorian_august", lookback_days: int | None = None,
                      lookahead_days: int | None = None) -> DataFrame:
    """C1-C10, C12, C13, C16-C21 on any daily frame. Expressions of the date stay inside code
    generation; event lookups are broadcast joins with day tables of the calendar's length."""
    out = df.withColumns({**K.temporal_cyclic(date), **K.weekend(date), **K.dow_cyclic(date), **K.is_monday(date),
                          **K.by_category(category, lambda p: K.weekday_tier(date, p)), **K.end_of_month(date),
                          **K.by_category(category, lambda p: K.mid_month_peak(date, p)),
                          **K.is_august(date), **L.lunar_date(date, anchors)})
    out = out.withColumns({**K.early_month(date, F.col("is_high_volume_weekday")), **L.lunar_cyclic(),
                           **K.high_volume_month(date), **L.days_until_lunar_0801()})
    out = events.holiday_features(out, holiday_dates(calendar, "model"), date, lookback_days, lookahead_days)
    out = events.days_to_mid_autumn(events.days_to_tet(out, calendar, date), calendar, date)
    out = events.pre_holiday_surge(out, calendar, date, pattern=None, category=category)
    return out.withColumns(L.season_window(date, category, rule=season_rule, golden_rule=golden_rule, anchors=anchors))


def feature_frame(daily: DataFrame, calendar: DataFrame, anchors: L.Anchors = L.MID_AUTUMN_ANCHORS,
                  keys: Keys = SERIES_KEYS, lunar_yoy: bool = True) -> DataFrame:
    """A gap-free daily frame (date, keys, quantity, volume) to the training frame: status,
    carry-over, density, year-over-year, rolling features, then the calendar features last,
    so joins and windows move narrow rows. Density medians and the lunar lookup read the
    series several times, so it is checkpointed once at that point."""
    out = events.operational_status(daily, calendar, CBM)
    out = cut_lineage(series.carryover_train(out, keys))
    out = series.prior_year_density(out, keys)
    if lunar_yoy:
        out = history.lunar_yoy_volume(out, keys=keys, anchors=anchors)
    else:
        out = series.yoy_volume(out, keys=keys)
    out = series.momentum(series.rolling_means(out, keys=keys), keys=keys)
    out = series.residual_target(series.trend_vs_yoy(out, keys=keys), keys=keys)
    return calendar_features(out, calendar, anchors)


@dataclass(frozen=True)
class TrainingSet:
    """Everything a fit needs, per split."""

    rows: DataFrame
    scaler: DataFrame
    ids: DataFrame
    windows: DataFrame


def training_job(features: DataFrame, inputs: int = 28, horizon: int = 30, keys: Keys = SERIES_KEYS,
                 feature_columns: Keys = (CBM,), train: float = 0.7, val: float = 0.1, test: float = 0.2) -> TrainingSet:
    """Split by time, fit the scaler on the training part, build windows inside each split."""
    rows = sampling.temporal_split(features, train, val, test, keys)
    scaler = stats.fit_scaler(rows.filter(F.col("split") == "train"), keys)
    windows = sampling.sliding_windows(rows, inputs, horizon, feature_columns, CBM, [*keys, "split"])
    return TrainingSet(rows, scaler, stats.encode_categories(features), windows)


# Calendar columns of the label day that the model uses, by name.
MODEL_COLUMNS = (
    "month_sin", "month_cos", "dayofmonth_sin", "dayofmonth_cos", "day_of_week_sin", "day_of_week_cos", "is_weekend", "Is_Monday",
    "weekday_volume_tier", "is_high_volume_weekday", "is_EOM", "days_until_month_end", "is_mid_month_peak", "is_first_5_days", "post_peak_signal",
    "is_high_vol_weekday_AND_early_month", "lunar_month_sin", "lunar_month_cos", "lunar_day_sin", "lunar_day_cos", "holiday_indicator",
    "days_until_next_holiday", "days_since_holiday", "days_to_tet", "days_to_mid_autumn", "is_pre_holiday_surge", "is_active_season",
    "is_golden_window", "is_peak_loss_window")


def model_features(calendar: DataFrame, anchors: L.Anchors = L.MID_AUTUMN_ANCHORS, columns: Sequence[str] = MODEL_COLUMNS, **options) -> FeatureSet:
    """The training frame's features for a fit: rolling means, momentum, last values and last year of the series, and
    the calendar columns of the day that is forecast."""
    return FeatureSet(calendar=tuple(columns), known=lambda df, date: calendar_features(df, calendar, anchors, date), **options)


def forecast_job(spark: SparkSession, train: DataFrame, actuals: DataFrame, calendar: DataFrame, start: str, end: str,
                 path: str | None = None, keys: Keys = SERIES_KEYS, anchors: L.Anchors = L.MID_AUTUMN_ANCHORS,
                 overrides: Sequence[rules.DayOverride] = (), missing: str = "zero", features: FeatureSet | None = None,
                 weight: Column | None = None, loss: Reweight | None = None, shrink: float = 50.0, stride: int = 7,
                 least_rows: int = 100, wanted: DataFrame | None = None, smoothing: float = 1.0) -> DataFrame:
    """Fit per key on the features, forecast month by month, apply the business rules in original units, attach the
    actuals and write. Brand series use the brand rules, others the category rules. With `wanted` (the keys to
    forecast, the last column being the part of the others), a key with fewer than `least_rows` training rows gets
    its share of the forecast of its whole, so no wanted key is lost."""
    used = features or model_features(calendar, anchors)
    train = cut_lineage(train.select(*keys, DATE, F.col(f"`{CBM}`")), "train")
    fit = dict(features=used, weight=weight, loss=loss, shrink=shrink, stride=stride)
    model = feature_forecast.fit_features(train, keys=keys, least_rows=least_rows, **fit)
    raw = feature_forecast.forecast_features(model, train, start, end, warm=anchors)
    if wanted is not None:
        whole = train.groupBy(*keys[:-1], DATE).agg(F.sum(F.col(f"`{CBM}`")).alias(CBM))
        whole = cut_lineage(whole, "wholes")
        parents = feature_forecast.forecast_features(feature_forecast.fit_features(whole, keys=keys[:-1], **fit), whole, start, end)
        raw = feature_forecast.complete_forecast(raw, parents, wanted, train, keys[:-1], keys[-1:], smoothing=smoothing)
    raw = raw.drop("model")
    if BRAND in keys:
        ruled = rules.postprocess_brand(raw, calendar, overrides, keys)
    else:
        ruled = rules.postprocess_category(raw, calendar, anchors, keys)
    scored = history.attach_actuals(ruled, actuals, keys, missing)
    if path is None:
        return cut_lineage(scored, "forecasts")
    stored = scored if BRAND in keys else scored.withColumn(BRAND, F.lit("ALL"))
    writers.write_forecasts(stored, path)
    return writers.combined_forecasts(spark, path)


def score_job(forecasts: DataFrame) -> dict[str, DataFrame]:
    """The score tables of a forecast."""
    return {"metrics": scoring.error_metrics(forecasts, [CATEGORY]), "accuracy": scoring.accuracy_by(forecasts),
            "monthly": scoring.monthly_results(forecasts), "segments": scoring.segmented_metrics(forecasts),
            "percentiles": scoring.percentile_errors(forecasts), "residuals": scoring.residual_statistics(forecasts),
            "spikes": scoring.spike_classification(forecasts),
            "days_of_month": scoring.day_of_month_buckets(forecasts)}


__all__ = ["MODEL_COLUMNS", "QTY", "TrainingSet", "calendar_features", "feature_frame", "forecast_job", "model_features", "panel_job",
           "score_job", "training_job"]
