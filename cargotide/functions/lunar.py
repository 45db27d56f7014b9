"""Lunar dates by arithmetic from Mid-Autumn anchors.

The model calendar has 12 months of 30 days. The position of a day is counted from the
Mid-Autumn day (month 8, day 15) of its own calendar year, so one `pmod` replaces any
stepping through months.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from .calendar import Features, cycle, flag
from .cleaning import as_column

# Mid-Autumn days used as anchors.
MID_AUTUMN_ANCHORS = {2023: "2023-09-29", 2024: "2024-09-17", 2025: "2025-10-06", 2026: "2026-09-25"}
MONTH_DAYS = 30
YEAR_DAYS = 360
ANCHOR_POSITION = 7 * MONTH_DAYS + 14
FAR_AWAY = 365

Anchors = Mapping[int, str]


def anchor_date(date: str | Column, anchors: Anchors = MID_AUTUMN_ANCHORS) -> Column:
    """Mid-Autumn of the row's year; years outside the table use the nearest table year."""
    years = sorted(anchors)
    if years != list(range(years[0], years[-1] + 1)):
        raise ValueError("anchor years must be consecutive")
    table = F.array(*[F.lit(dt.date.fromisoformat(anchors[y])) for y in years])
    year = F.greatest(F.least(F.year(as_column(date)), F.lit(years[-1])), F.lit(years[0]))
    return F.element_at(table, year - years[0] + 1)


def lunar_position(date: str | Column, anchors: Anchors = MID_AUTUMN_ANCHORS) -> Column:
    """Zero-based day within the 360-day lunar year."""
    d = as_column(date)
    return F.pmod(F.date_diff(d, anchor_date(d, anchors)) + ANCHOR_POSITION, F.lit(YEAR_DAYS))


def lunar_date(date: str | Column, anchors: Anchors = MID_AUTUMN_ANCHORS) -> Features:
    """C9."""
    position = lunar_position(date, anchors)
    return {"lunar_month": (F.floor(position / MONTH_DAYS) + 1).cast("int"),
            "lunar_day": (position % MONTH_DAYS + 1).cast("int")}


def lunar_cyclic(lunar_month: str | Column = "lunar_month",
                 lunar_day: str | Column = "lunar_day") -> Features:
    """C10."""
    return {**cycle(as_column(lunar_month) - 1, 12, "lunar_month"),
            **cycle(as_column(lunar_day) - 1, 30, "lunar_day")}


def days_until_lunar_0801(lunar_month: str | Column = "lunar_month",
                          lunar_day: str | Column = "lunar_day") -> Features:
    """C20. Days to the next first day of month 8, never negative."""
    ahead = F.pmod(F.lit(7 * MONTH_DAYS) - _position(lunar_month, lunar_day), F.lit(YEAR_DAYS))
    return {"days_until_lunar_08_01": ahead}


def _position(lunar_month: str | Column, lunar_day: str | Column) -> Column:
    return (as_column(lunar_month) - 1) * MONTH_DAYS + as_column(lunar_day) - 1


def mid_autumn_countdown(lunar_month: str | Column, lunar_day: str | Column,
                         days_to_next: str | Column) -> Column:
    """C17. Up to the festival the lunar count is used. After it the distance to the next
    listed festival (`days_to_next`, null if none is listed); without one, 365 inside
    month 8 and the lunar count to next year's festival in later months."""
    lm, ld, nxt = as_column(lunar_month), as_column(lunar_day), as_column(days_to_next)
    lunar_count = F.lit(ANCHOR_POSITION) - _position(lm, ld)
    return (F.when(lunar_count >= 0, lunar_count)
            .when(nxt.isNotNull(), nxt)
            .when(lm == 8, FAR_AWAY)
            .otherwise(lunar_count + YEAR_DAYS))


SEASON_RULES = ("lunar_gregorian", "lunar_6_9", "mid_autumn_window")
GOLDEN_RULES = ("gregorian_august", "lunar_0615_0801")
# The season around Mid-Autumn in days, and the length of the Tet season.
MID_AUTUMN_SEASON = (-66, 15)
TET_SEASON_DAYS = 45


def mooncake_active(date: str | Column, rule: str = "lunar_gregorian",
                    lunar_month: str | Column = "lunar_month",
                    anchors: Anchors = MID_AUTUMN_ANCHORS,
                    festival: str | Column | None = None) -> Column:
    """Season test for the Mid-Autumn category under one of three rules. The window rule
    needs the year's first date on lunar 8-15; inside the anchor years that is the anchor."""
    d, lm = as_column(date), as_column(lunar_month)
    if rule == "lunar_gregorian":
        return lm.between(7, 9) & F.month(d).between(7, 9)
    if rule == "lunar_6_9":
        return lm.between(6, 9)
    if rule == "mid_autumn_window":
        centre = festival_of_year(d, anchors) if festival is None else as_column(festival)
        return F.date_diff(d, centre).between(*MID_AUTUMN_SEASON)
    raise ValueError(f"unknown season rule {rule!r}; expected one of {SEASON_RULES}")


def festival_of_year(date: str | Column, anchors: Anchors = MID_AUTUMN_ANCHORS) -> Column:
    """First date of the row's year whose lunar date is 8-15: lunar positions repeat every
    360 days, so it is the first day of the year plus the remaining positions."""
    first = F.trunc(as_column(date), "year")
    wait = F.pmod(F.lit(ANCHOR_POSITION) - lunar_position(first, anchors), F.lit(YEAR_DAYS))
    return F.date_add(first, wait)


def mooncake_golden(date: str | Column, rule: str = "gregorian_august",
                    lunar_month: str | Column = "lunar_month",
                    lunar_day: str | Column = "lunar_day") -> Column:
    """Golden window under one of two rules."""
    if rule == "gregorian_august":
        return F.month(as_column(date)) == 8
    if rule == "lunar_0615_0801":
        return _position(lunar_month, lunar_day).between(5 * MONTH_DAYS + 14, 7 * MONTH_DAYS)
    raise ValueError(f"unknown golden rule {rule!r}; expected one of {GOLDEN_RULES}")


def season_window(date: str | Column, category: str | Column = "CATEGORY",
                  lunar_month: str | Column = "lunar_month", lunar_day: str | Column = "lunar_day",
                  days_to_tet: str | Column = "days_to_tet", rule: str = "lunar_gregorian",
                  golden_rule: str = "gregorian_august",
                  anchors: Anchors = MID_AUTUMN_ANCHORS) -> Features:
    """C19. Season flags by category; other categories get 0 and 365."""
    cat, tet = as_column(category), as_column(days_to_tet)
    position = _position(lunar_month, lunar_day)
    mooncake, is_tet = cat == "MOONCAKE", cat == "TET"
    to_peak = F.abs(F.lit(ANCHOR_POSITION) - position)
    return {
        "is_active_season": flag((mooncake & mooncake_active(date, rule, lunar_month, anchors))
                                 | (is_tet & (tet <= TET_SEASON_DAYS))),
        "is_golden_window": flag(mooncake & mooncake_golden(date, golden_rule, lunar_month, lunar_day)),
        "is_peak_loss_window": flag(mooncake & position.between(6 * MONTH_DAYS + 14, ANCHOR_POSITION)),
        "days_until_peak": F.coalesce(F.when(mooncake, to_peak).when(is_tet, tet), F.lit(FAR_AWAY)),
    }


def gregorian_for_lunar(lunar_month: str | Column, lunar_day: str | Column, year: str | Column,
                        anchors: Anchors = MID_AUTUMN_ANCHORS) -> Column:
    """C11. First date of a year with the given lunar date. Any 360 consecutive days hold
    every lunar date once, so it always exists and needs no search."""
    first = F.make_date(as_column(year), F.lit(1), F.lit(1))
    return _first_at(first, _position(lunar_month, lunar_day), anchors)


def lunar_aligned_date(date: str | Column, years_back: int,
                       anchors: Anchors = MID_AUTUMN_ANCHORS) -> Column:
    """First date of the year `years_back` years earlier with the same lunar date."""
    d = as_column(date)
    first = F.make_date(F.year(d) - years_back, F.lit(1), F.lit(1))
    return _first_at(first, lunar_position(d, anchors), anchors)


def _first_at(first: Column, position: Column, anchors: Anchors) -> Column:
    return F.date_add(first, F.pmod(position - lunar_position(first, anchors), F.lit(YEAR_DAYS)))
