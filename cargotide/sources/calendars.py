"""Holiday calendars as flat tables: `kind, key_year, name, date`.

The key year is the block a date was listed under; it can differ from the date's own
year, so filters use the date only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# Kind, key year, holiday name, then its dates.
HOLIDAY_TEXT = """
model 2023 tet 2023-01-20 2023-01-21 2023-01-22 2023-01-23 2023-01-24 2023-01-25 2023-01-26
model 2023 mid_autumn 2023-09-29
model 2024 tet 2024-02-08 2024-02-09 2024-02-10 2024-02-11 2024-02-12 2024-02-13 2024-02-14
model 2024 mid_autumn 2024-09-17
model 2025 tet 2025-01-27 2025-01-28 2025-01-29 2025-01-30 2025-01-31 2025-02-01 2025-02-02
model 2025 mid_autumn 2025-10-06
model 2026 tet 2026-02-14 2026-02-15 2026-02-16 2026-02-17 2026-02-18 2026-02-19 2026-02-20 2026-02-21 2026-02-22
model 2026 mid_autumn 2026-09-25
business 2023 new_year 2022-12-31 2023-01-01
business 2023 tet 2023-01-19 2023-01-20 2023-01-21 2023-01-22 2023-01-23 2023-01-24 2023-01-25
business 2023 hung_kings_reunification_labor 2023-04-28 2023-04-29 2023-04-30 2023-05-01 2023-05-02
business 2023 independence_day 2023-08-31 2023-09-01 2023-09-02 2023-09-03
business 2024 new_year 2023-12-31 2024-01-01
business 2024 tet 2024-02-07 2024-02-08 2024-02-09 2024-02-10 2024-02-11 2024-02-12 2024-02-13
business 2024 hung_kings 2024-04-17
business 2024 reunification_labor 2024-04-29 2024-04-30
business 2024 independence_day 2024-08-30 2024-08-31 2024-09-01 2024-09-02
business 2025 new_year 2024-12-31 2025-01-01
business 2025 tet 2025-01-26 2025-01-27 2025-01-28 2025-01-29 2025-01-30 2025-01-31 2025-02-01
business 2025 hung_kings 2025-04-06
business 2025 reunification_labor 2024-04-29 2025-04-30
business 2025 independence_day 2025-08-29 2025-08-30 2025-08-31 2025-09-01
business 2026 new_year 2025-12-31 2026-01-01
business 2026 tet 2026-02-13 2026-02-14 2026-02-15 2026-02-16 2026-02-17 2026-02-18 2026-02-19 2026-02-20 2026-02-21
business 2026 hung_kings 2026-04-25 2026-04-26
business 2026 reunification_labor 2026-04-29 2026-04-30
business 2026 independence_day 2026-08-31 2026-09-01
"""

CALENDAR_SCHEMA = "kind string, key_year int, name string, date date"


def parse_calendar(text: str) -> list[tuple[str, int, str, dt.date]]:
    rows = []
    for line in text.strip().splitlines():
        kind, year, name, *days = line.split()
        rows += [(kind, int(year), name, dt.date.fromisoformat(d)) for d in days]
    return rows


def holiday_calendar(spark: SparkSession, text: str = HOLIDAY_TEXT) -> DataFrame:
    """The calendar as a literal table; pass another text for another country or period."""
    return spark.createDataFrame(parse_calendar(text), CALENDAR_SCHEMA)


def holiday_dates(calendar: DataFrame, kind: str, start: str | None = None,
                  end: str | None = None) -> DataFrame:
    """C15. Distinct dates of one kind within an inclusive range."""
    out = calendar.filter(F.col("kind") == kind)
    if start is not None:
        out = out.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        out = out.filter(F.col("date") <= F.lit(end).cast("date"))
    return out.select("date").distinct()


def event_starts(calendar: DataFrame, name: str, kind: str = "model") -> DataFrame:
    """C15. First date of each year's block of a holiday (Tet start, Mid-Autumn)."""
    return (calendar.filter((F.col("kind") == kind) & (F.col("name") == name))
            .groupBy("key_year").agg(F.min("date").alias("date")).select("date"))


def major_events(calendar: DataFrame) -> DataFrame:
    """Tet and Mid-Autumn dates with their listing order (year, Tet before Mid-Autumn)."""
    order = Window.orderBy("key_year", F.when(F.col("name") == "tet", 0).otherwise(1), "date")
    return (calendar.filter((F.col("kind") == "model") & F.col("name").isin("tet", "mid_autumn"))
            .select("date", F.row_number().over(order).alias("event_order")))


# Month and day; then month, weekday and its rank in the month.
US_FIXED = (("new_year", 1, 1), ("independence", 7, 4), ("veterans", 11, 11), ("christmas", 12, 25))
US_NTH_WEEKDAY = (("mlk", 1, "MON", 3), ("presidents", 2, "MON", 3), ("labor", 9, "MON", 1),
                  ("columbus", 10, "MON", 2), ("thanksgiving", 11, "THU", 4))
US_MEMORIAL_MONTH = 5


def us_holidays(years: DataFrame, year_col: str = "year") -> DataFrame:
    """C14. `name, date` for every year of a table of distinct years."""
    y = F.col(year_col)

    def item(name, date):
        return F.struct(F.lit(name).alias("name"), date.alias("date"))

    items = [item(n, F.make_date(y, F.lit(m), F.lit(d))) for n, m, d in US_FIXED]
    for name, month, weekday, rank in US_NTH_WEEKDAY:
        first = F.next_day(F.date_sub(F.make_date(y, F.lit(month), F.lit(1)), 1), weekday)
        items.append(item(name, F.date_add(first, 7 * (rank - 1))))
    after_may = F.make_date(y, F.lit(US_MEMORIAL_MONTH + 1), F.lit(1))
    items.append(item("memorial", F.next_day(F.date_sub(after_may, 8), "MON")))
    return years.select(F.explode(F.array(*items)).alias("h")).select("h.name", "h.date")
