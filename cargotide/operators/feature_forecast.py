"""Forecasts that use the feature columns.

A training row is a key, an origin day and a step: features known at the origin (rolling means, momentum,
last values), features of the label day known in advance (calendar columns, the same day of earlier
years) and, optionally, a residual target over a baseline of the origin. All windows of a row share one
shuffle by key. A forecast advances a small state per key month by month: the last values as one array, from
which every feature is computed again after each month, so rolling means, momentum and years back see the
forecasts of the months before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..columns import BRAND, CATEGORY, CBM, DATE, SERIES_KEYS
from ..functions.cleaning import as_column
from ..functions.lunar import Anchors
from ..functions.measures import scale, unscale
from ..session import cut_lineage
from .forecast import month_chunks
from .history import warm_up
from .regression import GroupedModel, Reweight, fit_grouped, fit_reweighted, predict_grouped
from .series import ordered, same_day_earlier, trailing_mean
from .stats import fit_scaler

Keys = Sequence[str]


@dataclass(frozen=True)
class FeatureSet:
    """What a row of the model holds, in this order.

    `known` adds the `calendar` columns to any frame with the keys and a date column of the given name.
    `baseline` n makes the target the value minus the mean of the n days up to the origin.
    """

    rolling: tuple[int, ...] = (7, 30)
    momentum: tuple[int, int] | None = (3, 14)
    lags: tuple[int, ...] = (1, 7)
    years: tuple[int, ...] = (1,)
    calendar: tuple[str, ...] = ()
    known: Callable[[DataFrame, str], DataFrame] | None = None
    step: bool = True
    baseline: int | None = None

    @property
    def names(self) -> list[str]:
        pair = [f"momentum_{self.momentum[0]}d_vs_{self.momentum[1]}d"] if self.momentum else []
        return [*[f"rolling_mean_{n}d" for n in self.rolling], *pair, *[f"lag_{n}d" for n in self.lags],
                *[f"years_back_{n}" for n in self.years], *self.calendar, *(["step"] if self.step else [])]

    @property
    def reach(self) -> int:
        """Days of history that a feature can look at."""
        return max(366 * max(self.years, default=0) + 1, *self.rolling, *(self.momentum or ()), *self.lags, self.baseline or 1)

    def with_calendar(self, df: DataFrame, date: str) -> DataFrame:
        return df if self.known is None else self.known(df, date)


@dataclass(frozen=True)
class FeatureModel:
    features: FeatureSet
    model: GroupedModel
    horizon: int
    keys: tuple[str, ...]
    scaler: DataFrame | None = field(default=None)
    least_rows: int = 0


def _prepared(df: DataFrame, keys: Keys, value: str, date: str, scaler: DataFrame | None) -> DataFrame:
    """(keys, date, value), in units of the key's own mean and deviation where a scaler is given."""
    rows = df.select(*keys, F.col(date).alias("date"), as_column(value).cast("double").alias("value"))
    if scaler is None:
        return rows
    return rows.join(scaler, list(keys)).withColumn("value", scale("value", "mean", "std")).drop("mean", "std")


def _rows(series: DataFrame, features: FeatureSet, horizon: int, keys: Keys, stride: int) -> DataFrame:
    """Keys, origin, horizon_step, date, features, baseline, actual over a prepared gap-free series."""
    v, w = F.col("value"), ordered(keys, "date")
    at_origin = [trailing_mean("value", n, keys, "date") for n in features.rolling]
    if features.momentum:
        short, long = features.momentum
        at_origin.append(trailing_mean("value", short, keys, "date") - trailing_mean("value", long, keys, "date"))
    at_origin += [F.coalesce(F.lag(v, n - 1).over(w), F.first(v).over(w)) for n in features.lags]
    at_label = [F.coalesce(same_day_earlier("value", n, keys, "date"), F.lit(0.0)) for n in features.years]
    at_label += [F.col(c).cast("double") for c in features.calendar]
    base = F.lit(0.0) if features.baseline is None else trailing_mean("value", features.baseline, keys, "date")
    none = F.array().cast("array<double>")
    # the steps are made in the tasks of the windows: a fixed number of tasks, since the narrow series alone would be
    # merged into few
    tasks = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    days = features.with_calendar(series, "date").repartition(tasks, *keys).select(
        *keys, "date", "value", base.alias("baseline"), (F.array(*at_origin) if at_origin else none).alias("_origin"),
        (F.array(*at_label) if at_label else none).alias("_label"))
    ahead = F.collect_list(F.struct("date", "value", "_label")).over(w.rowsBetween(1, horizon))
    origins = days.withColumn("_ahead", ahead).filter(F.pmod(F.unix_date("date"), F.lit(stride)) == 0)
    each = origins.select(*keys, F.col("date").alias("origin"), "baseline", "_origin", F.posexplode("_ahead").alias("_p", "_s"))
    step = [(F.col("_p") + 1) / F.lit(float(horizon))] if features.step else []
    vector = F.concat("_origin", F.col("_s._label"), F.array(*step) if step else none)
    return each.select(*keys, "origin", (F.col("_p") + 1).alias("horizon_step"), F.col("_s.date").alias("date"), vector.alias("features"),
                       "baseline", F.col("_s.value").alias("actual"))


def fit_features(train: DataFrame, features: FeatureSet, horizon: int = 31, keys: Keys = SERIES_KEYS, value: str = CBM, date: str = DATE,
                 weight: Column | None = None, loss: Reweight | None = None, shrink: float = 0.0, stride: int = 1,
                 scaled: bool = True, least_rows: int = 0) -> FeatureModel:
    """F2. One model per key over all steps, `shrink` rows' weight near the pooled one. `weight` is an
    expression over the keys, `date` and `actual` (F1); `loss` refits with weights that depend on the
    prediction (F1, E13). `stride` uses every n-th origin day. Keys with fewer than `least_rows` training rows are forecast by
    the pooled model."""
    scaler = None
    if scaled:  # both the scaler and the rows read the series
        train = cut_lineage(train.select(*keys, date, as_column(value).alias(value)), "series")
        scaler = cut_lineage(fit_scaler(train, keys, value), "scaler")
    rows = _rows(_prepared(train, keys, value, date, scaler), features, horizon, keys, stride)
    rows = rows.withColumn("label", F.col("actual") - F.col("baseline")).withColumn("weight", F.lit(1.0) if weight is None else weight)
    size = len(features.names)
    if loss is None:
        model = fit_grouped(rows, keys, size, weight="weight", shrink=shrink)
    else:
        model = fit_reweighted(rows, keys, size, loss, weight="weight", shrink=shrink)
    return FeatureModel(features, model, horizon, tuple(keys), scaler, least_rows)


def _scored(model: FeatureModel, rows: DataFrame, floor: float | None) -> DataFrame:
    """Adds predicted and model: the baseline is added back and the scale undone. `_raw` stays scaled."""
    out = predict_grouped(model.model, rows, least_rows=model.least_rows).withColumn("_raw", F.col("predicted") + F.col("baseline")).drop("predicted")
    if model.scaler is None:
        out = out.withColumns({"mean": F.lit(0.0), "std": F.lit(1.0)})
    else:
        out = out.join(model.scaler, list(model.keys))
    if floor is not None:
        out = out.withColumn("_raw", F.greatest("_raw", scale(F.lit(float(floor)), "mean", "std")))
    return out.withColumn("predicted", unscale("_raw", "mean", "std"))


def evaluate_features(model: FeatureModel, df: DataFrame, value: str = CBM, date: str = DATE, first: str | None = None, stride: int = 1,
                      floor: float | None = None) -> DataFrame:
    """F7. Teacher forcing: a forecast of all steps from every origin of actual data, in original units. Origins
    before `first` only serve as history."""
    keys = list(model.keys)
    rows = _rows(_prepared(df, keys, value, date, model.scaler), model.features, model.horizon, keys, stride)
    if first is not None:
        rows = rows.filter(F.col("origin") >= F.lit(first).cast("date"))
    out = _scored(model, rows, floor).withColumn("actual", unscale("actual", "mean", "std"))
    return out.select(*keys, "origin", "horizon_step", "date", "actual", "predicted", "model",
                      (F.col("predicted") - F.col("actual")).alias("error"))


# ---------------------------------------------------------------- state

def feature_state(history: DataFrame, features: FeatureSet, keys: Keys, before: str, value: str = "value", date: str = "date") -> DataFrame:
    """One row per key with history: `values` of the days up to the day before `before`, oldest first and at most
    `reach` of them; days without a row count 0."""
    stop = F.lit(before).cast("date")
    recent = history.filter((F.col(date) < stop) & (F.col(date) >= F.date_sub(stop, features.reach)))
    packed = recent.groupBy(*keys).agg(F.min(date).alias("_first"), F.map_from_entries(F.collect_list(F.struct(F.col(date), as_column(value)))).alias("_m"))
    filled = F.transform(F.sequence("_first", F.date_sub(stop, 1)), lambda d: F.coalesce(F.element_at("_m", d), F.lit(0.0)))
    return packed.select(*keys, filled.alias("values"))


def _mean_of_last(n: int) -> Column:
    last = F.slice("values", -F.least(F.lit(n), F.size("values")), F.lit(n))
    return F.aggregate(last, F.lit(0.0), lambda a, v: a + v) / F.least(F.lit(n), F.size("values"))


def _last(n: int) -> Column:
    return F.element_at("values", -F.least(F.lit(n), F.size("values")))


def _years_back(n: int, start: Column) -> Column:
    """Value of the label's calendar day n years earlier out of the state; 0 where there is none."""
    earlier = F.add_months("date", -12 * n)
    back = F.date_diff(start, earlier)  # 1 is the last value
    there = (F.dayofmonth(earlier) == F.dayofmonth("date")) & (back >= 1) & (back <= F.size("values"))
    return F.coalesce(F.when(there, F.get("values", F.size("values") - back)), F.lit(0.0))


def state_rows(state: DataFrame, features: FeatureSet, keys: Keys, first: str, last: str, horizon: int) -> DataFrame:
    """The rows of the days [first, last] for every key, with features from the state only."""
    start = F.lit(first).cast("date")
    days = state.select(*keys, "values", F.posexplode(F.sequence(start, F.lit(last).cast("date"))).alias("_p", "date"))
    rows = features.with_calendar(days, "date")
    vector = [_mean_of_last(n) for n in features.rolling]
    if features.momentum:
        vector.append(_mean_of_last(features.momentum[0]) - _mean_of_last(features.momentum[1]))
    vector += [_last(n) for n in features.lags] + [_years_back(n, start) for n in features.years]
    vector += [F.col(c).cast("double") for c in features.calendar]
    if features.step:
        vector.append((F.col("_p") + 1) / F.lit(float(horizon)))
    base = F.lit(0.0) if features.baseline is None else _mean_of_last(features.baseline)
    return rows.select(*keys, "date", (F.col("_p") + 1).alias("horizon_step"), F.array(*vector).cast("array<double>").alias("features"),
                       base.alias("baseline"), F.when(F.col("_p") == 0, F.col("values")).alias("values"))


def forecast_features(model: FeatureModel, history: DataFrame, start: str, end: str, value: str = CBM, date: str = DATE,
                      floor: float | None = 0.0, warm: Anchors | None = None) -> DataFrame:
    """F4 / F5. One row per key with history and day of [start, end]: date, keys, predicted, model. Ranges longer than the
    model's steps go month by month; each month is written, its forecasts (not below `floor`) join the state and all
    features are computed again. `warm` applies the start-up rule F6 to the days before `start`."""
    keys, features = list(model.keys), model.features
    known = _prepared(history, keys, value, date, None)
    if warm is not None:
        stop = F.lit(start).cast("date")
        known = cut_lineage(known, "history")
        window = known.filter((F.col("date") < stop) & (F.col("date") >= F.date_sub(stop, 28)))
        warmed = warm_up(window, known, keys, "value", "date", anchors=warm).select(*known.columns)
        known = known.filter(F.col("date") < F.date_sub(stop, 28)).unionByName(warmed)
    if model.scaler is not None:
        known = _prepared(known, keys, "value", "date", model.scaler)
    state = cut_lineage(feature_state(known, features, keys, start), "state")
    result = None
    for first, last in month_chunks(start, end, model.horizon):
        rows = _scored(model, state_rows(state, features, keys, first, last, model.horizon), floor)
        chunk = cut_lineage(rows.select(*keys, "date", "predicted", "model", "_raw", "values"), "forecast")
        after = F.concat(F.max("values"), F.transform(F.array_sort(F.collect_list(F.struct("date", "_raw"))), lambda s: s["_raw"]))
        grown = chunk.groupBy(*keys).agg(after.alias("values"))
        state = cut_lineage(grown.withColumn("values", F.slice("values", -F.least(F.lit(features.reach), F.size("values")), F.lit(features.reach))), "state")
        part = chunk.select("date", *keys, "predicted", "model")
        result = part if result is None else result.unionByName(part)
    return result


# ---------------------------------------------------------------- keys without a model

def smoothed_shares(wanted: DataFrame, history: DataFrame, parent: Keys = (CATEGORY,), child: Keys = (BRAND,), value: str = CBM,
                    smoothing: float = 1.0) -> DataFrame:
    """Share of each wanted key in its parent: (volume + smoothing) / (sum of volumes + smoothing * keys), so a
    key without history has a small share and shares of a parent sum to 1."""
    keys = [*parent, *child]
    volume = history.groupBy(*keys).agg(F.sum(as_column(value)).alias("_v"))
    rows = wanted.select(*keys).distinct().join(volume, keys, "left").withColumn("_v", F.coalesce("_v", F.lit(0.0)) + F.lit(float(smoothing)))
    totals = rows.groupBy(*parent).agg(F.sum("_v").alias("_all"))
    return rows.join(totals, list(parent)).select(*keys, (F.col("_v") / F.col("_all")).alias("share"))


def complete_forecast(own: DataFrame, parents: DataFrame, wanted: DataFrame, history: DataFrame, parent: Keys = (CATEGORY,),
                      child: Keys = (BRAND,), value: str = CBM, smoothing: float = 1.0) -> DataFrame:
    """F4, cold start. One row per wanted key and day of the parents' forecast. Keys that have a model of their own keep
    its forecast; all others get their parent's forecast times their smoothed share. `model` is `own` or `allocated`."""
    keys = [*parent, *child]
    kept = own.filter(F.col("model") == "own").select("date", *keys, "predicted", "model")
    cold = wanted.select(*keys).distinct().join(kept.select(*keys).distinct(), keys, "left_anti")
    share = smoothed_shares(wanted, history, parent, child, value, smoothing)
    given = (share.join(cold, keys).join(parents.select("date", *parent, F.col("predicted").alias("_whole")), list(parent))
             .select("date", *keys, (F.col("_whole") * F.col("share")).alias("predicted"), F.lit("allocated").alias("model")))
    return kept.unionByName(given)


__all__ = ["FeatureModel", "FeatureSet", "complete_forecast", "evaluate_features", "feature_state", "fit_features", "forecast_features",
           "smoothed_shares", "state_rows"]
