"""As-of lookups against a table of event dates.

An event table is expanded once into a day table: between two neighbouring events every
day knows the one before and the one after. The lookup is then an equi-join on the date.
The day table has one row per day between the first and last event, which bounds the
broadcast by the length of the calendar and not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..columns import DATE
from ..functions.calendar import FRESH_CATEGORIES, flag
from ..functions.cleaning import as_column
from ..functions.lunar import FAR_AWAY, mid_autumn_countdown
from ..sources.calendars import event_starts, holiday_dates, major_events


def _clip(df: DataFrame, events: DataFrame, date: str,
          lookback_days: int | None, lookahead_days: int | None) -> DataFrame:
    """Keep the events an observer of this frame knows about."""
    if lookback_days is not None:
        first = df.agg(F.min(date)).scalar()
        events = events.filter(F.col("date") >= F.date_sub(first, lookback_days))
    if lookahead_days is not None:
        last = df.agg(F.max(date)).scalar()
        events = events.filter(F.col("date") <= F.date_add(last, lookahead_days))
    return events


def _days(start: Column, end: Column) -> Column:
    """Days from start to end; no day when the range is empty."""
    return F.explode(F.when(start <= end, F.sequence(start, end)).otherwise(
        F.array().cast("array<date>")))


def with_neighbours(df: DataFrame, events: DataFrame, date: str = DATE) -> DataFrame:
    """Add `_prev` (last event on or before the day) and `_next` (first event after it). The
    window runs over the event table alone."""
    by_date = Window.orderBy("date")
    listed = events.select("date").distinct()
    spans = listed.select("date", F.lead("date").over(by_date).alias("_next_event"))
    table = spans.select(
        _days(F.col("date"), F.coalesce(F.date_sub("_next_event", 1), F.col("date"))).alias("_day"),
        F.col("date").alias("_prev_event"), "_next_event")
    ends = listed.agg(F.struct(F.min("date").alias("first"), F.max("date").alias("last"))).scalar()
    d = F.col(date)
    return (df.join(F.broadcast(table), d == F.col("_day"), "left")
            .withColumns({"_prev": F.coalesce("_prev_event", F.when(d >= ends["last"], ends["last"])),
                          "_next": F.coalesce("_next_event", F.when(d < ends["first"], ends["first"]))})
            .drop("_day", "_prev_event", "_next_event"))


def _days_until(date: str, strict: bool, default: int | None) -> Column:
    ahead = F.date_diff("_next", date)
    if not strict:
        ahead = F.when(F.col("_prev") == F.col(date), 0).otherwise(ahead)
    return F.coalesce(ahead, F.lit(default).cast("int"))


def _days_since(date: str, default: int | None) -> Column:
    return F.coalesce(F.date_diff(date, "_prev"), F.lit(default).cast("int"))


def next_event(df: DataFrame, events: DataFrame, out: str, date: str = DATE, strict: bool = True,
               default: int | None = FAR_AWAY, lookahead_days: int | None = None) -> DataFrame:
    """J7. Days until the next event, `default` if there is none. With `strict` an event on
    the day itself does not count."""
    known = _clip(df, events, date, None, lookahead_days)
    return (with_neighbours(df, known, date).withColumn(out, _days_until(date, strict, default))
            .drop("_prev", "_next"))


def last_event(df: DataFrame, events: DataFrame, out: str, date: str = DATE,
               default: int | None = FAR_AWAY, lookback_days: int | None = None,
               lookahead_days: int | None = None) -> DataFrame:
    """J8. Days since the last event on or before the day, `default` if there is none.
    `lookback_days` hides events more than so many days before the frame's first day."""
    known = _clip(df, events, date, lookback_days, lookahead_days)
    return (with_neighbours(df, known, date).withColumn(out, _days_since(date, default))
            .drop("_prev", "_next"))


def nearest_event(df: DataFrame, events: DataFrame, out: str, date: str = DATE,
                  order: str = "event_order") -> DataFrame:
    """J9. Signed days to the nearest event (positive: still ahead). Of two equally near
    events the one listed first wins."""
    by_date = Window.orderBy("date")
    listed = events.groupBy("date").agg(F.min(order).alias("_rank"))
    pairs = (listed.select("date", "_rank", F.lead("date").over(by_date).alias("_next"),
                           F.lead("_rank").over(by_date).alias("_next_rank"))
             .filter(F.col("_next").isNotNull()))
    day = F.col("_day")
    back, ahead = F.date_diff(day, F.col("date")), F.date_diff(F.col("_next"), day)
    take_next = (ahead < back) | ((ahead == back) & (F.col("_next_rank") < F.col("_rank")))
    table = (pairs.select("*", _days(F.col("date"), F.date_sub("_next", 1)).alias("_day"))
             .select("_day", F.when(take_next, F.col("_next")).otherwise(F.col("date")).alias("_event")))
    bounds = listed.agg(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    d = F.col(date)
    event = F.coalesce(F.col("_event"), F.when(d < bounds["lo"], bounds["lo"]).otherwise(bounds["hi"]))
    return (df.join(F.broadcast(table), F.col(date) == F.col("_day"), "left")
            .withColumn(out, F.date_diff(event, d)).drop("_day", "_event"))


def flag_membership(df: DataFrame, dates: DataFrame, out: str, date: str = DATE) -> DataFrame:
    """J10. 1 if the day is in the calendar."""
    days = dates.select(F.col("date").alias("_day")).distinct()
    return (df.join(F.broadcast(days), F.col(date) == F.col("_day"), "left")
            .withColumn(out, flag(F.col("_day").isNotNull())).drop("_day"))


def holiday_features(df: DataFrame, holidays: DataFrame, date: str = DATE,
                     lookback_days: int | None = None, lookahead_days: int | None = None) -> DataFrame:
    """C13. Holiday flag, days until the next and since the last holiday, from one join. A
    holiday hidden by `lookback_days` lies before the frame, so it is nobody's next one."""
    known = _clip(df, holidays, date, lookback_days, lookahead_days)
    return (with_neighbours(df, known, date)
            .withColumns({"holiday_indicator": flag(F.col("_prev") == F.col(date)),
                          "days_until_next_holiday": _days_until(date, True, FAR_AWAY),
                          "days_since_holiday": _days_since(date, FAR_AWAY)})
            .drop("_prev", "_next"))


def days_to_tet(df: DataFrame, calendar: DataFrame, date: str = DATE) -> DataFrame:
    """C16. Days to the next Tet start, 0 on the day, 365 after the last listed one."""
    return next_event(df, event_starts(calendar, "tet"), "days_to_tet", date, strict=False)


def days_to_mid_autumn(df: DataFrame, calendar: DataFrame, date: str = DATE,
                       lunar_month: str = "lunar_month", lunar_day: str = "lunar_day") -> DataFrame:
    """C17. Needs the lunar columns."""
    out = next_event(df, event_starts(calendar, "mid_autumn"), "_to_next", date, default=None)
    return (out.withColumn("days_to_mid_autumn",
                           mid_autumn_countdown(lunar_month, lunar_day, "_to_next"))
            .drop("_to_next"))


# Tier by distance to a major event; the second bound is inclusive.
SURGE_STEPS = ((1, 3, 3), (4, 7, 2), (8, 10, 1))


def surge_tier(distance: str | Column, pattern: str) -> Column:
    """C18. Before an event demand rises (default) or falls and rises after it (fresh)."""
    days = as_column(distance)
    tier = F.lit(0)
    for low, high, size in SURGE_STEPS:
        tier = F.when(days.between(low, high), -size if pattern == "fresh" else size).otherwise(tier)
        if pattern == "fresh":
            tier = F.when(days.between(-high, -low), size).otherwise(tier)
    return tier


def pre_holiday_surge(df: DataFrame, calendar: DataFrame, date: str = DATE,
                      pattern: str | None = "default", category: str = "CATEGORY") -> DataFrame:
    """C18. `pattern=None` picks the profile from the category column."""
    out = nearest_event(df, major_events(calendar), "_distance", date)
    if pattern is None:
        tier = F.when(F.col(category).isin(*FRESH_CATEGORIES), surge_tier("_distance", "fresh")
                      ).otherwise(surge_tier("_distance", "default"))
    else:
        tier = surge_tier("_distance", pattern)
    return (out.withColumn("pre_holiday_surge_tier", tier)
            .withColumn("is_pre_holiday_surge", flag(F.col("pre_holiday_surge_tier") != 0))
            .drop("_distance"))


# The four day labels.
HOLIDAY_OFF = "Holiday_OFF"
WEEKEND_DOWNTIME = "Weekend_Downtime"
OPERATIONAL_ANOMALY = "Operational_Anomaly"
BUSINESS_DAY = "Business_Day_Normal"


def operational_status(df: DataFrame, calendar: DataFrame, value: str, date: str = DATE,
                       kind: str = "business") -> DataFrame:
    """C23. Day label; a missing volume becomes 0."""
    out = flag_membership(df, holiday_dates(calendar, kind), "_holiday", date)
    volume = F.coalesce(as_column(value).try_cast("double"), F.lit(0.0))
    status = (F.when(F.col("_holiday") == 1, HOLIDAY_OFF)
              .when(F.weekday(date) == 6, WEEKEND_DOWNTIME)
              .when(volume == 0, OPERATIONAL_ANOMALY)
              .otherwise(BUSINESS_DAY))
    return (out.withColumn("operational_status", status).withColumn(value, volume)
            .withColumn("is_expected_zero",
                        flag(F.col("operational_status").isin(HOLIDAY_OFF, WEEKEND_DOWNTIME)))
            .withColumn("is_operational_anomaly",
                        flag(F.col("operational_status") == OPERATIONAL_ANOMALY))
            .drop("_holiday"))
