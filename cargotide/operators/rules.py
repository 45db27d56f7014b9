"""Business rules on a forecast in original units."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ..columns import BRAND, CATEGORY, DATE
from ..functions.lunar import MID_AUTUMN_ANCHORS, Anchors, mooncake_active
from ..sources.calendars import holiday_dates, major_events
from .events import flag_membership, next_event
from .series import carryover_forecast

Keys = Sequence[str]
P = "predicted"

# Floors, the August factor and the multipliers before a major event.
BRAND_FLOOR = 1.0
MOONCAKE_FLOOR = 2.0
AUGUST_FACTOR = 2.0
EVENT_MULTIPLIERS = ((1, 3, 2.5), (4, 7, 1.5), (8, 10, 1.2))


def month_boundary_signal(window: DataFrame, keys: Keys, date: str = DATE, rows: int = 3) -> DataFrame:
    """F8. For a forecast of the first day of a month: early-month signals on the last rows of
    the window of each key."""
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(date)))
    near = F.col("_back") <= rows
    out = window.withColumn("_back", back).withColumns({
        "is_first_5_days": F.when(near, 1).otherwise(F.col("is_first_5_days")),
        "post_peak_signal": F.when(near, F.lit(1.0)).otherwise(F.col("post_peak_signal")),
        "is_high_vol_weekday_AND_early_month":
            F.when(near & (F.col("is_high_volume_weekday") == 1), -2)
            .otherwise(F.col("is_high_vol_weekday_AND_early_month"))})
    return out.drop("_back")


def clip_floor(df: DataFrame, minimum: float = 0.0, category: str | None = None, value: str = P) -> DataFrame:
    """F9. Values below the minimum (and negative ones) become 0, for one category if given."""
    low = (F.col(value) < minimum) | (F.col(value) < 0)
    if category is not None:
        low = low & (F.col(CATEGORY) == category)
    return df.withColumn(value, F.when(low, F.lit(0.0)).otherwise(F.col(value)))


def zero_closed_days(df: DataFrame, calendar: DataFrame, sundays: bool = True, value: str = P,
                     date: str = "date", kind: str = "business") -> DataFrame:
    """F10."""
    out = flag_membership(df, holiday_dates(calendar, kind), "_closed", date)
    closed = F.col("_closed") == 1
    if sundays:
        closed = closed | (F.weekday(date) == 6)
    return out.withColumn(value, F.when(closed, F.lit(0.0)).otherwise(F.col(value))).drop("_closed")


def season_mask(df: DataFrame, anchors: Anchors = MID_AUTUMN_ANCHORS, rule: str = "mid_autumn_window",
                category: str = "MOONCAKE", value: str = P, date: str = "date",
                lunar_month: str = "lunar_month") -> DataFrame:
    """F11. Off-season forecasts of the seasonal category become 0."""
    active = mooncake_active(date, rule, lunar_month, anchors)
    off = (F.col(CATEGORY) == category) & ~active
    return df.withColumn(value, F.when(off, F.lit(0.0)).otherwise(F.col(value)))


def month_boost(df: DataFrame, month: int = 8, factor: float = AUGUST_FACTOR, category: str = "MOONCAKE",
                value: str = P, date: str = "date") -> DataFrame:
    """F11."""
    hit = (F.col(CATEGORY) == category) & (F.month(date) == month)
    return df.withColumn(value, F.when(hit, F.col(value) * factor).otherwise(F.col(value)))


def pre_holiday_multiplier(df: DataFrame, calendar: DataFrame, value: str = P, date: str = "date",
                           steps: Sequence[tuple[int, int, float]] = EVENT_MULTIPLIERS) -> DataFrame:
    """F12. By the days to the next major event date (strictly later)."""
    out = next_event(df, major_events(calendar), "_ahead", date, default=None)
    factor = F.lit(1.0)
    for low, high, times in steps:
        factor = F.when(F.col("_ahead").between(low, high), F.lit(times)).otherwise(factor)
    return out.withColumn(value, F.col(value) * factor).drop("_ahead")


@dataclass(frozen=True)
class DayOverride:
    """`base + predicted * multiplier` for one brand on some days of the month, in one category
    or, with None, in all."""

    brand: str
    days: tuple[int, ...] = (22, 23)
    base: float = 0.0
    multiplier: float = 2.0
    category: str | None = None


def day_overrides(df: DataFrame, rules: Sequence[DayOverride], value: str = P, date: str = "date",
                  brand: str = BRAND, category: str = CATEGORY) -> DataFrame:
    """F13. Rules apply one after the other, in list order."""
    name = F.upper(F.trim(F.col(brand)))
    result = F.col(value)
    for rule in rules:
        hit = (name == rule.brand.strip().upper()) & F.dayofmonth(date).isin(*rule.days)
        if rule.category is not None:
            hit &= F.upper(F.trim(F.col(category))) == rule.category.strip().upper()
        result = F.when(hit, F.lit(rule.base) + result * F.lit(rule.multiplier)).otherwise(result)
    return df.withColumn(value, result)


def postprocess_category(df: DataFrame, calendar: DataFrame, anchors: Anchors = MID_AUTUMN_ANCHORS,
                         keys: Keys = (CATEGORY,)) -> DataFrame:
    """F14, category path: no negatives, season mask, August boost, small-value floor, closed
    holidays, Sunday carried to Monday."""
    out = clip_floor(df)
    out = month_boost(season_mask(out, anchors))
    out = clip_floor(out, MOONCAKE_FLOOR, "MOONCAKE")
    out = zero_closed_days(out, calendar, sundays=False)
    return carryover_forecast(out, keys)


def postprocess_brand(df: DataFrame, calendar: DataFrame, rules: Sequence[DayOverride] = (),
                      keys: Keys = (CATEGORY, BRAND)) -> DataFrame:
    """F14, brand path: closed days, floor, event multiplier, day rules, Sunday carried to
    Monday."""
    out = clip_floor(zero_closed_days(df, calendar), BRAND_FLOOR)
    out = day_overrides(pre_holiday_multiplier(out, calendar), rules)
    return carryover_forecast(out, keys)
