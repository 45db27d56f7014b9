"""Forecast jobs: plain baselines and one pooled multi-step regression.

The regression sees a series in units of its own mean and deviation, so one model serves
every key and the number of keys only adds rows. Training and scoring are DataFrame jobs:
windows by key, one row per window and step, MLlib for the fit.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..columns import CBM, DATE, SERIES_KEYS
from ..functions.calendar import cycle, flag
from ..functions.cleaning import as_column
from ..functions.measures import scale, unscale
from ..session import cut_lineage
from .history import merge_history
from .sampling import explode_windows, sliding_windows
from .series import ordered, trailing_mean, yoy_volume
from .stats import fit_scaler

Keys = Sequence[str]
BASELINES = ("seasonal_naive", "moving_average", "last_year")


def baseline_forecast(df: DataFrame, kind: str = "moving_average", keys: Keys = SERIES_KEYS, value: str = CBM,
                      date: str = DATE, window: int = 7) -> DataFrame:
    """F3. One row per key and day of a gap-free series: the value `window` days ago, the mean
    of the `window` days before, or the same day last year. Days without a base are left out."""
    v = as_column(value)
    if kind == "seasonal_naive":
        rows = df.withColumn("predicted", F.lag(v, window).over(ordered(keys, date)))
    elif kind == "moving_average":
        rows = df.withColumn("predicted", trailing_mean(v, window, keys, date, lag=1))
    elif kind == "last_year":
        rows = yoy_volume(df, (1,), keys, value, date, {1: "predicted"})
    else:
        raise ValueError(f"unknown baseline {kind!r}; expected one of {BASELINES}")
    return (rows.select(F.col(date).alias("date"), *keys, "predicted", v.alias("actual"))
            .filter(F.col("predicted").isNotNull()))


@dataclass(frozen=True)
class DirectModel:
    """A fitted forecaster with everything needed to apply it."""

    model: object
    scaler: DataFrame
    inputs: int
    horizon: int
    keys: tuple[str, ...]


def _label_features(date: Column, step: Column, horizon: int) -> list[Column]:
    dow = F.weekday(date)
    waves = [*cycle(F.month(date) - 1, 12, "m").values(), *cycle(F.dayofmonth(date) - 1, 31, "d").values()]
    return [(step / F.lit(float(horizon))), *[flag(dow == n).cast("double") for n in range(6)], *waves,
            flag(F.dayofmonth(date) <= 5).cast("double"),
            flag(F.dayofmonth(F.last_day(date)) - F.dayofmonth(date) < 3).cast("double")]


def _with_vector(rows: DataFrame, horizon: int) -> DataFrame:
    """`x` (recent values), `date`, `horizon_step` to one feature vector."""
    label = F.array(*_label_features(F.col("date"), F.col("horizon_step"), horizon))
    mean7 = F.aggregate(F.slice("x", -7, 7), F.lit(0.0), lambda a, b: a + b) / 7.0
    return rows.withColumn("features", array_to_vector(F.concat("x", F.array(mean7), label)))


def scaled_series(df: DataFrame, scaler: DataFrame, keys: Keys, value: str, date: str) -> DataFrame:
    """C24. Only the target is scaled."""
    return (df.join(scaler, list(keys))
            .select(*keys, F.col(date).alias("date"), scale(value, "mean", "std").alias("value")))


def _spread(df: DataFrame, by: Keys) -> DataFrame:
    """Windows leave the tasks of their key: long series and few keys would otherwise keep
    most of the cluster idle during the fit. The compact windows are moved, not their steps."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *by)


def fit_direct(train: DataFrame, inputs: int = 28, horizon: int = 31, keys: Keys = SERIES_KEYS, value: str = CBM,
               date: str = DATE, weight: Column | None = None, reg: float = 0.01) -> DirectModel:
    """F2. All steps at once: a row per window and step, features of the last `inputs` days and
    of the label date. `weight` is an expression over `date`, `label` and the keys. The fit
    passes over its rows more than once, so the windows are kept (spilling to disk) and their
    steps are rebuilt in each pass: a step row repeats its inputs, a window holds them once. The
    series and its scaler are stored, so that neither the fit nor a forecast computes them again."""
    series = cut_lineage(train.select(*keys, date, as_column(value).alias(value)), "series")
    scaler = cut_lineage(fit_scaler(series, keys, value), "scaler")
    windows = sliding_windows(scaled_series(series, scaler, keys, value, date), inputs, horizon, ["value"],
                              "value", keys, "date").withColumn("x", F.flatten("x"))
    windows = _spread(windows, [*keys, "window_id"]).persist(StorageLevel.MEMORY_AND_DISK)
    steps = windows.select(*keys, "x", F.posexplode(F.arrays_zip("y_dates", "y")).alias("_p", "_s")).select(
        *keys, "x", (F.col("_p") + 1).alias("horizon_step"), F.col("_s.y_dates").alias("date"),
        F.col("_s.y").alias("label"))
    rows = _with_vector(steps, horizon).withColumn("weight", F.lit(1.0) if weight is None else weight)
    try:
        fitted = LinearRegression(featuresCol="features", labelCol="label", weightCol="weight", regParam=reg,
                                  solver="normal", predictionCol="scaled").fit(rows.select("features", "label", "weight"))
    finally:
        windows.unpersist()
    return DirectModel(fitted, scaler, inputs, horizon, tuple(keys))


def _unscaled(model: DirectModel, rows: DataFrame) -> DataFrame:
    scored = model.model.transform(_with_vector(rows, model.horizon)).drop("features")
    return (scored.join(model.scaler, list(model.keys))
            .withColumn("predicted", unscale("scaled", "mean", "std")).drop("scaled", "mean", "std"))


def last_inputs(history: DataFrame, model: DirectModel, before: str, value: str, date: str) -> DataFrame:
    """The last `inputs` rows of each key before a day as one array; a shorter history repeats
    its last value."""
    back = F.row_number().over(Window.partitionBy(*model.keys).orderBy(F.desc("date")))
    rows = scaled_series(history.filter(F.col(date) < F.lit(before).cast("date")), model.scaler, model.keys,
                         value, date).withColumn("_b", back).filter(F.col("_b") <= model.inputs)
    packed = rows.groupBy(*model.keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("date", "value"))), lambda s: s["value"]).alias("x"))
    return packed.withColumn("x", F.concat("x", F.array_repeat(F.element_at("x", -1),
                                                               F.lit(model.inputs) - F.size("x"))))


def forecast_direct(model: DirectModel, history: DataFrame, start: str, end: str, value: str = CBM,
                    date: str = DATE) -> DataFrame:
    """F4. One row per key and day of exactly [start, end], which the model's steps must cover; longer
    ranges go through `forecast_rolling_monthly`."""
    wanted = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1
    if wanted > model.horizon:
        raise ValueError(f"{wanted} days wanted, the model has {model.horizon} steps")
    spine = F.posexplode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
    rows = (last_inputs(history, model, start, value, date)
            .select(*model.keys, "x", spine.alias("_p", "date"))
            .withColumn("horizon_step", F.col("_p") + 1).drop("_p"))
    return _unscaled(model, rows).select("date", *model.keys, "predicted")


def month_chunks(start: str, end: str, longest: int = 31) -> list[tuple[str, str]]:
    """Calendar-month pieces of an inclusive range, cut again where a month has over `longest` days."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    out = []
    while first <= last:
        following = min((first.replace(day=1) + dt.timedelta(days=32)).replace(day=1), first + dt.timedelta(days=longest))
        out.append((first.isoformat(), min(following - dt.timedelta(days=1), last).isoformat()))
        first = following
    return out


def forecast_rolling_monthly(model: DirectModel, history: DataFrame, start: str, end: str, value: str = CBM,
                             date: str = DATE) -> DataFrame:
    """F5. Month by month: each month's forecast joins the history of the next. Only the days a
    month can look at are carried along, and every month is checkpointed to the shared folder,
    so plans stay short and a lost executor costs one month."""
    reach = f"INTERVAL {model.inputs + 31} DAYS"
    floor = F.lit(start).cast("date") - F.expr(reach)
    recent = cut_lineage(history.select(*model.keys, date, as_column(value).alias(value))
                         .filter((F.col(date) >= floor) & (F.col(date) < F.lit(start).cast("date"))))
    result = None
    for first, last in month_chunks(start, end, model.horizon):
        chunk = cut_lineage(forecast_direct(model, recent, first, last, value, date))
        result = chunk if result is None else result.unionByName(chunk)
        as_history = chunk.select(*model.keys, F.col("date").alias(date), F.col("predicted").alias(value))
        recent = cut_lineage(merge_history(recent, as_history, model.keys, date)
                             .filter(F.col(date) >= F.lit(first).cast("date") - F.expr(reach)))
    return result


def teacher_forcing_eval(model: DirectModel, df: DataFrame, value: str = CBM, date: str = DATE) -> DataFrame:
    """F7. Every window of actual data gets one forecast of all steps, compared in original
    units; the layout is that of `explode_windows`."""
    keys = list(model.keys)
    raw = df.select(*keys, F.col(date).alias("date"), as_column(value).alias("value"))
    windows = sliding_windows(raw, model.inputs, model.horizon, ["value"], "value", keys, "date")
    scaled = windows.join(model.scaler, keys).withColumn(
        "x", F.transform(F.flatten("x"), lambda v: (v - F.col("mean")) / F.col("std"))).drop("mean", "std")
    rows = _spread(scaled, [*keys, "window_id"]).select(
        *keys, "window_id", "x", F.posexplode(F.arrays_zip("y_dates", "y")).alias("_p", "_s")).select(
        *keys, "window_id", "x", (F.col("_p") + 1).alias("horizon_step"), F.col("_s.y_dates").alias("date"),
        F.col("_s.y").alias("actual"))
    out = _unscaled(model, rows).drop("x")
    return out.withColumn("day_of_month", F.dayofmonth("date")).withColumn(
        "error", F.col("predicted") - F.col("actual")).withColumn("abs_error", F.abs("error"))


__all__ = ["BASELINES", "DirectModel", "baseline_forecast", "explode_windows", "fit_direct", "forecast_direct",
           "forecast_rolling_monthly", "month_chunks", "teacher_forcing_eval"]
