"""Holiday calendar for the years of the given tables (1995-2001): public lunar dates as
parameters, days around them by rule."""

from __future__ import annotations

import datetime as dt

# Lunar New Year and Mid-Autumn days.
LUNAR_NEW_YEAR = {1995: "1995-01-31", 1996: "1996-02-19", 1997: "1997-02-07", 1998: "1998-01-28",
                  1999: "1999-02-16", 2000: "2000-02-05", 2001: "2001-01-24"}
ANCHORS = {1995: "1995-09-09", 1996: "1996-09-27", 1997: "1997-09-16", 1998: "1998-10-05",
           1999: "1999-09-24", 2000: "2000-09-12", 2001: "2001-10-01"}


def _run(first: dt.date, days: int) -> str:
    return " ".join((first + dt.timedelta(n)).isoformat() for n in range(days))


def calendar_text() -> str:
    out = []
    for year, new_year in LUNAR_NEW_YEAR.items():
        tet = dt.date.fromisoformat(new_year) - dt.timedelta(2)
        out += [f"model {year} tet {_run(tet, 7)}", f"model {year} mid_autumn {ANCHORS[year]}",
                f"business {year} new_year {_run(dt.date(year - 1, 12, 31), 2)}",
                f"business {year} tet {_run(tet - dt.timedelta(1), 7)}",
                f"business {year} reunification_labor {_run(dt.date(year, 4, 29), 3)}",
                f"business {year} independence_day {_run(dt.date(year, 8, 31), 4)}"]
    return "\n".join(out)


CALENDAR_TEXT = calendar_text()
