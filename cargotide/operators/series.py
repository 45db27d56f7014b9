"""Windows over one daily series per key
(SURVEY J4, J5, W1-W7, W13-W17, C22; the date-only features live in `functions`).

A series has at most one row per day, so a window partition is bounded by the length of
the calendar whatever the volume of a key; keys spread over the cluster. All operators
partition by the same key, so one shuffle serves a whole chain of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..columns import CBM, DATE, QTY, SERIES_KEYS
from ..functions.cleaning import as_column
from ..functions.measures import density
from .quantiles import quantile_column

Keys = Sequence[str]


def ordered(keys: Keys, date: str = DATE) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(date)


def trailing_mean(value: str | Column, n: int, keys: Keys, date: str = DATE, lag: int = 0) -> Column:
    """Mean of the last n rows, ending `lag` rows before the current one."""
    return F.avg(as_column(value)).over(ordered(keys, date).rowsBetween(-(n - 1) - lag, -lag))


def fill_gaps(value: str | Column, keys: Keys, date: str = DATE) -> Column:
    """W13. Last known value, else next known value, else 0, inside the key."""
    c = as_column(value)
    back = F.last(c, ignorenulls=True).over(ordered(keys, date).rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(c, ignorenulls=True).over(ordered(keys, date).rowsBetween(0, Window.unboundedFollowing))
    return F.coalesce(back, ahead, F.lit(0.0))


def rolling_means(df: DataFrame, windows: Sequence[int] = (7, 30), keys: Keys = SERIES_KEYS,
                  value: str = CBM, date: str = DATE, lag: int = 0) -> DataFrame:
    """W1. Trailing row means including the current row; `lag=1` leaves it out."""
    return df.withColumns({f"rolling_mean_{n}d": trailing_mean(value, n, keys, date, lag) for n in windows})


def momentum(df: DataFrame, short: int = 3, long: int = 14, keys: Keys = SERIES_KEYS,
             value: str = CBM, date: str = DATE, lag: int = 0) -> DataFrame:
    """W2."""
    return df.withColumn(f"momentum_{short}d_vs_{long}d",
                         trailing_mean(value, short, keys, date, lag)
                         - trailing_mean(value, long, keys, date, lag))


def trend_vs_yoy(df: DataFrame, n: int = 21, keys: Keys = SERIES_KEYS, value: str = CBM,
                 last_year: str = "cbm_last_year", date: str = DATE) -> DataFrame:
    """W3. Recent mean against last year; ratio 1 where last year is missing or 0."""
    mean, base = trailing_mean(value, n, keys, date), as_column(last_year)
    return df.withColumn(f"rolling_mean_{n}d", mean).withColumns({
        "trend_vs_yoy_ratio": F.when(base > 0, F.col(f"rolling_mean_{n}d") / base).otherwise(F.lit(1.0)),
        "trend_vs_yoy_diff": F.col(f"rolling_mean_{n}d") - base})


def residual_target(df: DataFrame, source: str = "rolling_mean_30d", keys: Keys = SERIES_KEYS,
                    value: str = CBM, date: str = DATE) -> DataFrame:
    """W4. Baseline known the day before; the first row of a key uses its own value."""
    base = F.coalesce(F.lag(as_column(source)).over(ordered(keys, date)), as_column(source))
    return df.withColumn("baseline_for_target", base).withColumn(
        "target_residual", as_column(value) - F.col("baseline_for_target"))


def carryover_train(df: DataFrame, keys: Keys = SERIES_KEYS, value: str = CBM, date: str = DATE) -> DataFrame:
    """W5. A Monday also gets the latest earlier Sunday row of its key, however far back."""
    dow = F.weekday(date)
    before = ordered(keys, date).rowsBetween(Window.unboundedPreceding, -1)
    sunday_day = F.last(F.when(dow == 6, F.col(date)), ignorenulls=True).over(before)
    sunday = F.max_by(as_column(value), F.when(dow == 6, F.col(date))).over(before)
    carried = F.when((dow == 0) & sunday_day.isNotNull() & sunday.isNotNull(),
                     as_column(value) + sunday).otherwise(as_column(value))
    return df.withColumn(value, carried)


def carryover_forecast(df: DataFrame, keys: Keys = SERIES_KEYS, value: str = "predicted",
                       date: str = "date") -> DataFrame:
    """W6. Sunday moves to an adjacent Monday and becomes 0."""
    w = ordered(keys, date)
    dow = F.weekday(date)
    from_yesterday = (F.weekday(F.lag(date).over(w)) == 6) & (F.date_diff(date, F.lag(date).over(w)) == 1)
    v = as_column(value)
    moved = (F.when(dow == 6, F.lit(0.0))
             .when((dow == 0) & from_yesterday, v + F.lag(v).over(w)).otherwise(v))
    return df.withColumn(value, moved)


def moving_average_baseline(df: DataFrame, window: int = 7, keys: Keys = SERIES_KEYS, value: str = CBM,
                            date: str = DATE, anomaly: str | None = "is_operational_anomaly",
                            lag: int = 0) -> DataFrame:
    """W7. Trailing mean that skips flagged days; null if none is left."""
    v = as_column(value)
    if anomaly is not None and anomaly in df.columns:
        v = F.when(as_column(anomaly) != 1, v)
    return df.withColumn(f"{value}_MA{window}", trailing_mean(v, window, keys, date, lag))


# ---------------------------------------------------------------- last year

def same_day_earlier(value: str | Column, years: int, keys: Keys, date: str = DATE) -> Column:
    """Value of the same calendar day `years` earlier, null if the key has no row there or the
    day is 29 February. The day lies one of a few whole numbers of days back, so it is read
    with range frames of one day each: no join, and the shuffle by key that other windows use."""
    d = F.col(date)
    earlier = F.add_months(d, -12 * years)
    gap = F.when(F.dayofmonth(earlier) == F.dayofmonth(d), F.date_diff(d, earlier))
    usual = 365 * years + years // 4
    by_day = Window.partitionBy(*keys).orderBy(F.unix_date(d))
    picks = [F.when(gap == n, F.max(as_column(value)).over(by_day.rangeBetween(-n, -n)))
             for n in range(usual - 1, usual + 2)]
    return F.coalesce(*picks)


def yoy_volume(df: DataFrame, years: Sequence[int] = (1, 2), keys: Keys = SERIES_KEYS, value: str = CBM,
               date: str = DATE, names: dict[int, str] | None = None) -> DataFrame:
    """J5. Same calendar day of earlier years, 0 if there is none."""
    names = names or {1: "cbm_last_year", 2: "cbm_2_years_ago"}
    return df.withColumns({names[n]: F.coalesce(same_day_earlier(value, n, keys, date), F.lit(0.0))
                           for n in years})


def prior_year_density(df: DataFrame, keys: Keys = SERIES_KEYS, date: str = DATE,
                       cbm: str = CBM, qty: str = QTY) -> DataFrame:
    """C22 + J4. Density of the day and of the same day last year; where that is missing the
    key's median, then the overall median (W17)."""
    now = df.withColumn("cbm_per_qty", density(cbm, qty))
    both = now.withColumn("cbm_per_qty_last_year", same_day_earlier("cbm_per_qty", 1, keys, date))
    return median_fill(both, "cbm_per_qty_last_year", keys, source="cbm_per_qty")


def median_fill(df: DataFrame, value: str, keys: Keys = SERIES_KEYS, source: str | None = None) -> DataFrame:
    """W17. Missing values get the median of `source` in the key (a series is bounded by the
    calendar), then the exact overall median."""
    src = source or value
    key_median = F.percentile(as_column(src), F.lit(0.5)).over(Window.partitionBy(*keys))
    overall = quantile_column(df, src, 0.5)
    return df.withColumn(value, F.coalesce(as_column(value), key_median, overall))


# ---------------------------------------------------------------- history windows

def history_window(df: DataFrame, end: str, n: int, keys: Keys = (), date: str = DATE) -> DataFrame:
    """W14. Rows on the last n distinct days up to `end`, of the frame or of each key. Only the
    distinct days are ranked, so many rows on one day do not meet in one task."""
    seen = df.filter(F.col(date) <= F.lit(end).cast("date"))
    days = seen.select(*keys, date).distinct()
    if keys:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(date)))
        last = days.withColumn("_r", rank).filter(F.col("_r") <= n).drop("_r")
        return seen.join(last, [*keys, date], "left_semi")
    last = days.orderBy(F.desc(date)).limit(n)
    return seen.join(F.broadcast(last), date, "left_semi")


def full_month_window(df: DataFrame, end: str, date: str = DATE) -> DataFrame:
    """W15. From the first day of the previous month to `end`."""
    stop = F.lit(end).cast("date")
    return df.filter((F.col(date) >= F.trunc(F.add_months(stop, -1), "MM")) & (F.col(date) <= stop))


def pad_short_history(df: DataFrame, n: int, keys: Keys = SERIES_KEYS, date: str = DATE) -> DataFrame:
    """W16. A key with fewer than n rows repeats its last row up to n. `pad` is 0 on the
    original rows and counts the copies."""
    columns = df.columns
    last = df.groupBy(*keys).agg(F.count("*").alias("_n"),
                                 F.max_by(F.struct(*[as_column(c) for c in columns]), date).alias("_last"))
    copies = (last.filter(F.col("_n") < n)
              .select("_last", F.explode(F.sequence(F.lit(1), (F.lit(n) - F.col("_n")).cast("int"))).alias("pad"))
              .select("_last.*", "pad"))
    return df.withColumn("pad", F.lit(0)).unionByName(copies)
