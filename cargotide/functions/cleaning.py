"""Cleaning expressions for raw lines."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Unit corrections per SKU, outlier threshold, excluded categories.
CBM_FROM_QTY_SKU = ("4305254", 16.0, 0.027)
QTY_FROM_QTY_SKU = ("ZW840244", 120.0, 0.019)
CBM_OUTLIER_THRESHOLD = 2.7
CBM_OUTLIER_DIVISOR = 1000.0
EXCLUDED_CATEGORIES = ("TEST", "OFFBOM")


@dataclass(frozen=True)
class UnitRule:
    """`target = QTY / divisor * factor` for one SKU."""

    sku: str
    target: str
    divisor: float
    factor: float


UNIT_RULES = (
    UnitRule(CBM_FROM_QTY_SKU[0], "CUBE_OUT", CBM_FROM_QTY_SKU[1], CBM_FROM_QTY_SKU[2]),
    UnitRule(QTY_FROM_QTY_SKU[0], "QTY", QTY_FROM_QTY_SKU[1], QTY_FROM_QTY_SKU[2]),
)


def as_column(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def business_date(ts: str | Column, tz_hours: int = 7, cutoff_hour: int = 17) -> Column:
    """P1. Local business day: a line shipped at or after the local cut-off hour counts
    for the next day. Both shifts together are one constant shift of the clock."""
    return F.to_date(as_column(ts) + F.expr(f"INTERVAL {tz_hours + 24 - cutoff_hour} HOURS"))


def week_label(date: str | Column) -> Column:
    """P2. `1.Monday` … `7.Sunday`."""
    d = as_column(date)
    return F.concat((F.weekday(d) + 1).cast("string"), F.lit("."), F.date_format(d, "EEEE"))


def day_label(date: str | Column) -> Column:
    """P2. Day of the month."""
    return F.dayofmonth(as_column(date))


def unit_override(target: str, qty: str = "QTY", sku: str = "SKU",
                  rules: Sequence[UnitRule] = UNIT_RULES) -> Column:
    """P4. `target` with the per-SKU unit rules for that column applied."""
    out = F.col(target)
    for rule in rules:
        if rule.target == target:
            out = F.when(F.col(sku) == rule.sku,
                         F.col(qty) / F.lit(rule.divisor) * F.lit(rule.factor)).otherwise(out)
    return out


def rescale_outlier(value: str | Column, exclude: Column | None = None,
                    threshold: float = CBM_OUTLIER_THRESHOLD,
                    divisor: float = CBM_OUTLIER_DIVISOR) -> Column:
    """P5. Values at or above the threshold were recorded in the wrong unit."""
    v = as_column(value)
    hit = v >= F.lit(threshold)
    if exclude is not None:
        hit = hit & ~F.coalesce(exclude, F.lit(False))
    return F.when(hit, v / F.lit(divisor)).otherwise(v)


def category_allowed(category: str | Column,
                     excluded: Sequence[str] = EXCLUDED_CATEGORIES) -> Column:
    """P6. Null-safe exclusion: a missing category is kept."""
    keep = F.lit(True)
    for name in excluded:
        keep = keep & ~as_column(category).eqNullSafe(F.lit(name))
    return keep


def numeric(value: str | Column, fill: float | None = None) -> Column:
    """P7. Text or number to double; what cannot be read (or is NaN) is null, then `fill`."""
    parsed = as_column(value).try_cast("double")
    parsed = F.when(~F.isnan(parsed), parsed)
    return parsed if fill is None else F.coalesce(parsed, F.lit(float(fill)))


def slug(value: str | Column) -> Column:
    """P12. File-safe name: blanks and slashes become underscores."""
    return F.translate(as_column(value), " /", "__")


# Accepted date layouts (after `-` became `/` and `T` a blank) and the optional time of day.
YEAR_FIRST, DAY_FIRST, MONTH_FIRST = "yyyy/M/d", "d/M/yyyy", "M/d/yyyy"
TIME_OF_DAY = "[ H:m[:s][.SSSSSS]]"


# After a time of day: a zone as Z or an offset, or the half of the day.
ZONE = r"(?<=:\d{2})(\.\d+)?\s*(Z|z|[+-]\d{2}:?\d{2}|[+-]\d{2})$"
HALF_DAY = r"(?i)(?<=\d)\s*([ap])\.?m\.?$"


# What a text must look like for a layout to fit; a layout is only tried on such texts, since a failed try costs an exception.
MONTH_NUMBER = r"0*(?:[1-9]|1[0-2])"
SHAPES = {YEAR_FIRST: rf"^\+?\d{{4,}}/{MONTH_NUMBER}/\d", DAY_FIRST: rf"^\d+/{MONTH_NUMBER}/\+?\d{{4,}}(?: |$)",
          MONTH_FIRST: rf"^{MONTH_NUMBER}/\d+/\+?\d{{4,}}(?: |$)"}


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once for a row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def parse_mixed_timestamp(value: str | Column, dayfirst: bool = True) -> Column:
    """S6. Wall-clock time of a text: year first, else day before month (or the other way round), the
    other order where that cannot be; one or two digits, `-` or `/`, blank or `T`, time of day and
    fraction optional. A time with a zone (`Z`, `+07:00`) becomes UTC, `AM` and `PM` are understood.
    Nothing fits gives null."""
    order = (YEAR_FIRST, DAY_FIRST, MONTH_FIRST) if dayfirst else (YEAR_FIRST, MONTH_FIRST, DAY_FIRST)

    def moved(clock: Column, half: Column, zone: Column) -> Column:
        hour = F.hour(clock)
        hours = F.when((half == "p") & (hour < 12), 12).when((half == "a") & (hour == 12), -12).otherwise(0)
        digits = F.rpad(F.regexp_replace(zone, "[^0-9]", ""), 4, "0")  # always a number: a cast that fails is an exception too
        minutes = F.substring(digits, 1, 2).cast("int") * 60 + F.substring(digits, 3, 2).cast("int")
        ahead = F.when(F.startswith(zone, F.lit("-")), -minutes).otherwise(minutes)
        return F.when((half == "") & (zone == ""), clock).otherwise((clock + F.make_dt_interval(hours=hours, mins=-ahead)).cast("timestamp_ntz"))

    def clock_of(text: Column) -> Column:
        return F.coalesce(*[F.when(text.rlike(SHAPES[f]), F.try_to_timestamp(text, F.lit(f + TIME_OF_DAY))) for f in order]).cast("timestamp_ntz")

    def by_half(local: Column, zone: Column) -> Column:
        def parsed(half: Column) -> Column:
            text = F.translate(F.when(half == "", local).otherwise(F.regexp_replace(local, HALF_DAY, "")), "-T", "/ ")
            return bound(bound(text, clock_of), lambda clock: moved(clock, half, zone))
        return bound(F.lower(F.regexp_extract(local, HALF_DAY, 1)), parsed)

    def by_zone(whole: Column) -> Column:
        return bound(F.regexp_extract(whole, ZONE, 2), lambda zone: bound(
            F.when(zone == "", whole).otherwise(F.regexp_replace(whole, ZONE, "$1")), lambda local: by_half(local, zone)))

    return bound(F.trim(as_column(value)), by_zone)


def parse_mixed_date(value: str | Column, dayfirst: bool = True,
                     formats: Sequence[str] | None = None) -> Column:
    """S6. The day of `parse_mixed_timestamp`, or of the first of the given layouts that fits."""
    if formats is None:
        return F.to_date(parse_mixed_timestamp(value, dayfirst))
    text = F.trim(as_column(value))
    return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in formats])
