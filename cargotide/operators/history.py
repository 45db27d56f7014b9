"""Joins between forecasts, actuals, history and other runs
(SURVEY J3, J6, J11-J14, C25, F6, S10, S11, L3-L6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..columns import CBM, DATE, SERIES_KEYS
from ..functions.cleaning import as_column
from ..functions.lunar import MID_AUTUMN_ANCHORS, Anchors, lunar_aligned_date, lunar_position
from .series import ordered

Keys = Sequence[str]


def attach_actuals(forecast: DataFrame, actuals: DataFrame, keys: Keys = SERIES_KEYS, missing: str = "zero",
                   value: str = CBM, actual_date: str = DATE) -> DataFrame:
    """J3. Actual volume per (date, key) and `error = predicted - actual`. Actuals are summed
    to one row per key first, so the join cannot multiply forecast rows."""
    if missing not in ("zero", "null"):
        raise ValueError("missing must be 'zero' or 'null'")
    known = (actuals.groupBy(F.col(actual_date).alias("date"), *keys)
             .agg(F.sum(as_column(value)).alias("actual")))
    out = forecast.join(known, ["date", *keys], "left")
    if missing == "zero":
        out = out.withColumn("actual", F.coalesce("actual", F.lit(0.0)))
    return out.withColumn("error", F.col("predicted") - F.col("actual")).withColumn(
        "abs_error", F.abs("error"))


def reachable_history(history: DataFrame, keys: Keys, value: str, tolerance: int, date: str) -> DataFrame:
    """History with gaps bridged: (key, day, value, matched day) for every day that has a
    history row within `tolerance` days, the nearest one, the earlier of two equally near.

    Each row covers the half-gap on either side, found with lag and lead. A lookup with
    tolerance is then one equi-join, with no candidate offsets to try per row.
    """
    w = ordered(keys, date)
    d = F.col(date)
    to_prev, to_next = F.date_diff(d, F.lag(date).over(w)), F.date_diff(F.lead(date).over(w), d)
    tol = F.lit(tolerance)
    before = F.coalesce(F.least(tol, (F.ceil(to_prev / 2) - 1).cast("int")), tol)
    after = F.coalesce(F.least(tol, F.floor(to_next / 2).cast("int")), tol)
    rows = history.select(*keys, d.alias("_matched"), as_column(value).alias("_value"),
                          before.alias("_b"), after.alias("_a"))
    return rows.select(*keys, "_matched", "_value", F.explode(F.sequence(
        F.date_sub("_matched", F.col("_b")), F.date_add("_matched", F.col("_a")))).alias("_day"))


def lunar_yoy_volume(df: DataFrame, years: Sequence[int] = (1, 2), keys: Keys = SERIES_KEYS, value: str = CBM,
                     date: str = DATE, tolerance: int = 3, anchors: Anchors = MID_AUTUMN_ANCHORS,
                     history: DataFrame | None = None, names: dict[int, str] | None = None,
                     audit: bool = False) -> DataFrame:
    """J6. Volume on the same lunar date of earlier years, 0 if none is within reach. With
    `audit` (C25) the aligned and the matched date, their difference and whether the lunar
    dates agree are added."""
    names = names or {1: "cbm_last_year", 2: "cbm_2_years_ago"}
    lookup = reachable_history(df if history is None else history, keys, value, tolerance, date)
    out = df
    for n in years:
        side = lookup.select(*keys, F.col("_day").alias(f"_aligned{n}"), F.col("_value").alias(f"_v{n}"),
                             F.col("_matched").alias(f"_m{n}"))
        out = (out.withColumn(f"_aligned{n}", lunar_aligned_date(date, n, anchors))
               .join(side, [*keys, f"_aligned{n}"], "left")
               .withColumn(names[n], F.coalesce(f"_v{n}", F.lit(0.0))))
        if audit:
            out = out.withColumns({
                f"aligned_date_{n}": F.col(f"_aligned{n}"),
                f"matched_date_{n}": F.col(f"_m{n}"),
                f"days_back_{n}": F.date_diff(date, F.col(f"_m{n}")),
                f"same_lunar_date_{n}": lunar_position(date, anchors)
                                        == lunar_position(F.col(f"_m{n}"), anchors)})
        out = out.drop(f"_aligned{n}", f"_v{n}", f"_m{n}")
    return out


def yoy_for_forecast(history: DataFrame, future: DataFrame, keys: Keys = SERIES_KEYS, value: str = CBM,
                     date: str = DATE, **options) -> DataFrame:
    """J14. Lunar year-over-year values for future rows from history and future together."""
    both = history.select(*keys, date, as_column(value)).unionByName(
        future.select(*keys, date, as_column(value)))
    return lunar_yoy_volume(future, keys=keys, value=value, date=date, history=both, **options)


def warm_up(window: DataFrame, history: DataFrame, keys: Keys = SERIES_KEYS, value: str = CBM, date: str = DATE,
            limit: float = 1.0, **options) -> DataFrame:
    """F6. Where the whole window of a key is (nearly) zero, each day takes last year's value
    of the same lunar date when that is positive."""
    total = (window.groupBy(*keys).agg(F.sum(F.abs(as_column(value))).alias("_total")))
    looked = lunar_yoy_volume(window, (1,), keys, value, date, history=history, names={1: "_last"}, **options)
    fresh = (F.col("_total") <= limit) & (F.col("_last") > 0)
    return (looked.join(total, list(keys), "left")
            .withColumn(value, F.when(fresh, F.col("_last")).otherwise(as_column(value)))
            .drop("_last", "_total"))


def attach_spike_reason(forecast: DataFrame, reasons: DataFrame, keys: Keys = (), date: str = "date") -> DataFrame:
    """J11. Reason of the day, kept for spikes only."""
    return (forecast.join(reasons, [*keys, date], "left")
            .withColumn("spike_reason", F.when(F.col("is_spike"), F.col("spike_reason"))))


def split_by_presence(keys_df: DataFrame, artefacts: DataFrame, on: Keys) -> tuple[DataFrame, DataFrame]:
    """J12. Keys with and without an artefact."""
    present = artefacts.select(*on)
    return keys_df.join(present, list(on), "left_semi"), keys_df.join(present, list(on), "left_anti")


def merge_history(history: DataFrame, recent: DataFrame, keys: Keys = SERIES_KEYS, date: str = DATE) -> DataFrame:
    """J13. Union on the common columns, one row per key and day; the recent row wins.
    `max_by` keeps one candidate per group on the map side."""
    columns = [c for c in history.columns if c in recent.columns]
    rest = [c for c in columns if c not in (*keys, date)]
    both = (history.select(*map(as_column, columns)).withColumn("_source", F.lit(0))
            .unionByName(recent.select(*map(as_column, columns)).withColumn("_source", F.lit(1))))
    best = F.max_by(F.struct(*map(as_column, rest)), "_source").alias("_r")
    return both.groupBy(*keys, date).agg(best).select(*keys, date, *[F.col("_r")[c].alias(c) for c in rest])


def keep_one(df: DataFrame, keys: Keys, order: Keys, last: bool = False) -> DataFrame:
    """L4. One row per key: the first (or last) by `order`, as a mergeable aggregate."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    best = pick(F.struct(*map(as_column, rest)), F.struct(*map(as_column, order))).alias("_r")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def upsert(existing: DataFrame, new: DataFrame, keys: Keys, required: str | None = None) -> DataFrame:
    """S10. Cell-wise merge: a new value wins unless it is null. Existing rows without the
    required key are dropped. Columns: keys, new ones, then those only in existing."""
    if required is not None:
        e = F.col(required)
        existing = existing.filter(e.isNotNull() & (e.cast("string") != ""))
    new_columns = [c for c in new.columns if c not in keys]
    old_columns = [c for c in existing.columns if c not in keys]
    left = new.select(*keys, *[as_column(c).alias(f"n_{c}") for c in new_columns])
    right = existing.select(*keys, *[as_column(c).alias(f"e_{c}") for c in old_columns])

    def merged(c: str) -> Column:
        sides = [F.col(f"`{p}_{c}`") for p, has in (("n", new_columns), ("e", old_columns)) if c in has]
        return F.coalesce(*sides).alias(c)

    order = new_columns + [c for c in old_columns if c not in new_columns]
    return left.join(right, list(keys), "full_outer").select(*keys, *[merged(c) for c in order])


def append_history(existing: DataFrame, new: DataFrame) -> DataFrame:
    """S11. Append; missing columns become null, existing columns come first."""
    return existing.unionByName(new, allowMissingColumns=True)


def feature_changes(features: DataFrame, old_run: str, new_run: str) -> DataFrame:
    """L5. Features added or removed between two runs of a (run, feature) table, as often as one run has more of
    them than the other; both runs are counted in one read."""
    def of(run: str) -> Column:
        return F.count(F.when(F.col("run") == run, 1))

    more = (features.filter(F.col("run").isin(old_run, new_run)).groupBy("feature").agg((of(new_run) - of(old_run)).alias("_more"))
            .filter(F.col("_more") != 0))
    change = F.when(F.col("_more") > 0, F.lit("added")).otherwise(F.lit("removed"))
    return more.select("feature", F.explode(F.array_repeat(change, F.abs("_more").cast("int"))).alias("change"))


def available(requested: DataFrame, present: DataFrame, on: str) -> DataFrame:
    """L6."""
    return requested.select(on).intersect(present.select(on))
