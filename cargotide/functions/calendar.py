"""Calendar features of a date.

Every function returns `{feature name: column}`; apply with `df.withColumns(...)`.
A pattern is the profile of a category; `by_category` picks one per row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F

from .cleaning import as_column

Features = dict[str, Column]

# Tier per weekday (Monday first), busy weekdays, and tiers by day of month.
WEEKDAY_TIER = {
    "default": (-1, 0, 2, 0, 1, -1, -1),
    "fresh": (6, 0, 5, 0, 5, -3, -3),
}
BUSY_WEEKDAYS = {"default": (2, 4), "fresh": (0, 2, 4)}
BUSY_WEEKDAYS_FALLBACK = (0, 2, 4)
MID_MONTH_TIER = {
    "default": {19: 3, 20: 3, 21: 4, 22: 5, 23: 5, 24: 4, 25: 1, 26: 1, 27: 1},
    "fresh": {8: 2, 9: 3, 10: 4, 11: 4, 12: 4, 13: 3, 14: 3, 15: 3, 16: 1, 17: 1, 18: 1},
}
MID_MONTH_FLAG = {"default": (21, 24), "fresh": (10, 12)}
MID_MONTH_CENTRE = {"default": 23, "fresh": 11}
EARLY_MONTH_TIER = {"first_5": -10, "until_10": 1, "later": 2}
EARLY_MONTH_BUSY_SIGNAL = {"first_5": -5, "until_10": -2, "later": 0}
POST_PEAK_DECAY = 0.3
FRESH_CATEGORIES = ("FRESH",)


def flag(condition: Column) -> Column:
    """0/1, with null treated as 0."""
    return F.when(condition, 1).otherwise(0)


def cycle(position: Column, period: float, name: str) -> Features:
    """Sine and cosine of a zero-based position in a period."""
    angle = F.lit(2 * math.pi) * position / F.lit(float(period))
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def by_category(category: str | Column, build: Callable[[str], Features],
                fresh: Sequence[str] = FRESH_CATEGORIES) -> Features:
    """One feature set per profile, chosen by the row's category."""
    is_fresh = as_column(category).isin(*fresh)
    fresh_set, default_set = build("fresh"), build("default")
    return {name: F.when(is_fresh, fresh_set[name]).otherwise(default_set[name])
            for name in default_set}


def temporal_cyclic(date: str | Column) -> Features:
    """C1."""
    d = as_column(date)
    return {**cycle(F.month(d) - 1, 12, "month"), **cycle(F.dayofmonth(d) - 1, 31, "dayofmonth")}


def weekend(date: str | Column) -> Features:
    """C2. Monday is 0."""
    dow = F.weekday(as_column(date))
    return {"day_of_week": dow, "is_weekend": flag(dow >= 5)}


def dow_cyclic(date: str | Column) -> Features:
    """C3."""
    return cycle(F.weekday(as_column(date)), 7, "day_of_week")


def is_monday(date: str | Column) -> Features:
    """C4."""
    return {"Is_Monday": flag(F.weekday(as_column(date)) == 0)}


def weekday_tier(date: str | Column, pattern: str = "default") -> Features:
    """C5. Tier of the weekday and the busy-weekday flag (a fresh Monday is 6)."""
    dow = F.weekday(as_column(date))
    tiers = F.array(*[F.lit(t) for t in WEEKDAY_TIER[pattern]])
    return {"weekday_volume_tier": F.element_at(tiers, dow + 1),
            "is_high_volume_weekday": flag(dow.isin(*BUSY_WEEKDAYS[pattern]))}


def end_of_month(date: str | Column, days: int = 3) -> Features:
    """C6."""
    d = as_column(date)
    left = F.dayofmonth(F.last_day(d)) - F.dayofmonth(d)
    return {"days_until_month_end": left, "is_EOM": flag(left < days)}


def mid_month_peak(date: str | Column, pattern: str = "default") -> Features:
    """C7."""
    day = F.dayofmonth(as_column(date))
    tiers: Mapping[int, int] = MID_MONTH_TIER[pattern]
    by_day = F.array(*[F.lit(tiers.get(n, 0)) for n in range(1, 32)])
    return {"mid_month_peak_tier": F.element_at(by_day, day),
            "is_mid_month_peak": flag(day.between(*MID_MONTH_FLAG[pattern])),
            "days_to_mid_month_peak": day - MID_MONTH_CENTRE[pattern]}


def _early(day: Column, values: Mapping[str, int]) -> Column:
    return (F.when(day <= 5, values["first_5"]).when(day <= 10, values["until_10"])
            .otherwise(values["later"]))


def early_month(date: str | Column, busy_weekday: Column | None = None,
                decay: float = POST_PEAK_DECAY) -> Features:
    """C8. `busy_weekday` is an existing 0/1 column; without it Monday, Wednesday and
    Friday count as busy. One definition serves training and forecasting."""
    d = as_column(date)
    day = F.dayofmonth(d)
    busy = flag(F.weekday(d).isin(*BUSY_WEEKDAYS_FALLBACK)) if busy_weekday is None else busy_weekday
    return {"early_month_low_tier": _early(day, EARLY_MONTH_TIER),
            "is_early_month_low": flag(day <= 10),
            "is_first_5_days": flag(day <= 5),
            "is_first_3_days": flag(day <= 3),
            "days_from_month_start": day - 1,
            "post_peak_signal": F.exp(F.lit(-decay) * (day - 1)),
            "is_high_vol_weekday_AND_early_month":
                F.when(busy == 1, _early(day, EARLY_MONTH_BUSY_SIGNAL)).otherwise(0)}


def high_volume_month(date: str | Column, lunar_month: str | Column = "lunar_month") -> Features:
    """C12. A low lunar month wins over a busy calendar month."""
    month, lunar = F.month(as_column(date)), as_column(lunar_month)
    busy, low = (month == 12) | lunar.isin(7, 8), lunar == 12
    return {"month": month,
            "high_volume_month_tier": F.when(low, 0).when(busy, 2).otherwise(1),
            "is_high_volume_month": flag(busy),
            "is_low_volume_month": flag(low)}


def is_august(date: str | Column) -> Features:
    """C21."""
    return {"is_august": flag(F.month(as_column(date)) == 8)}
