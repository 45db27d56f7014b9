"""Oracle SQL: the shipment stand-in as reusable common table expressions (DuckDB dialect)."""

from __future__ import annotations

from ..sources.calendars import parse_calendar
from .stand_in_calendar import ANCHORS, CALENDAR_TEXT

D = "ACTUALSHIPDATE"
Q = '"Total QTY"'
V = '"Total CBM"'
FAR = 365


def r(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0e0)"


def flag(cond: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS INTEGER)"


def i(expr: str) -> str:
    return f"CAST({expr} AS INTEGER)"


def b(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def dow(d: str = D) -> str:
    return f"CAST(isodow({d}) - 1 AS INTEGER)"


def anchor(d: str) -> str:
    cases = " ".join(f"WHEN {y} THEN DATE '{a}'" for y, a in ANCHORS.items())
    return f"(CASE least(greatest(year({d}), {min(ANCHORS)}), {max(ANCHORS)}) {cases} END)"


def pos(d: str) -> str:
    """Zero-based day of the 360-day lunar year."""
    return f"(((date_diff('day', {anchor(d)}, {d}) + 224) % 360 + 360) % 360)"


def _values() -> str:
    rows = ", ".join(f"('{k}', {y}, '{n}', DATE '{d}')" for k, y, n, d in parse_calendar(CALENDAR_TEXT))
    return f"SELECT * FROM (VALUES {rows}) AS t(kind, key_year, name, date)"


CTES: dict[str, tuple[list[str], str]] = {
    "lines": ([], """
        SELECT l_shipdate + to_hours(CAST(l_orderkey % 24 AS BIGINT)) AS ACTUALSHIPDATE,
          'WH' || CAST(l_suppkey % 3 AS VARCHAR) AS WHSEID, CAST(l_partkey AS VARCHAR) AS SKU,
          CASE l_returnflag WHEN 'A' THEN 'TEST' WHEN 'R' THEN 'DRY' END AS CATEGORY,
          l_quantity AS QTY, l_quantity * (l_partkey % 50 + 1) * 0.00217348391e0 AS CUBE_OUT FROM lineitem"""),
    "master": ([], """
        SELECT CAST(p_partkey AS VARCHAR) AS SKU, p_brand AS BRAND,
          CASE p_type WHEN 'ECONOMY' THEN 'DRY' WHEN 'STANDARD' THEN 'FRESH' WHEN 'PROMO' THEN 'MOONCAKE'
            WHEN 'LARGE' THEN 'TET' WHEN 'MEDIUM' THEN 'POSM' WHEN 'SMALL' THEN 'OTHER' END AS CATEGORY_MASTER
        FROM part"""),
    "clean": (["lines", "master"], """
        SELECT CAST(l.ACTUALSHIPDATE + INTERVAL 14 HOUR AS DATE) AS ACTUALSHIPDATE, l.WHSEID, l.SKU,
          coalesce(m.CATEGORY_MASTER, l.CATEGORY) AS CATEGORY, m.BRAND,
          CASE WHEN l.SKU = '11' THEN l.QTY / 120e0 * 0.019e0 ELSE l.QTY END AS QTY,
          CASE WHEN l.SKU = '7' THEN l.QTY / 16e0 * 0.0270137e0 WHEN l.CUBE_OUT >= 2.7e0 THEN l.CUBE_OUT / 1000e0
            ELSE l.CUBE_OUT END AS CUBE_OUT
        FROM lines l JOIN master m ON m.SKU = l.SKU
        WHERE coalesce(m.CATEGORY_MASTER, l.CATEGORY) IS DISTINCT FROM 'TEST'
          AND coalesce(m.CATEGORY_MASTER, l.CATEGORY) IS DISTINCT FROM 'OFFBOM'"""),
    "panel": (["clean"], """
        SELECT ACTUALSHIPDATE, WHSEID, CATEGORY, BRAND, sum(QTY) AS "Total QTY", sum(CUBE_OUT) AS "Total CBM"
        FROM clean WHERE CATEGORY IS NOT NULL AND BRAND IS NOT NULL AND WHSEID IS NOT NULL GROUP BY ALL"""),
    "daily": (["panel"], """
        SELECT ACTUALSHIPDATE, CATEGORY, sum("Total CBM") AS "Total CBM", sum("Total QTY") AS "Total QTY"
        FROM panel GROUP BY ALL"""),
    "span": (["panel"], """
        SELECT CAST(unnest(generate_series(min(ACTUALSHIPDATE), max(ACTUALSHIPDATE), INTERVAL 1 DAY)) AS DATE) AS day
        FROM panel"""),
    "dense": (["daily", "span"], """
        SELECT s.day AS ACTUALSHIPDATE, k.CATEGORY, coalesce(d."Total QTY", 0e0) AS "Total QTY",
          coalesce(d."Total CBM", 0e0) AS "Total CBM"
        FROM span s CROSS JOIN (SELECT DISTINCT CATEGORY FROM daily) k
        LEFT JOIN daily d ON d.ACTUALSHIPDATE = s.day AND d.CATEGORY = k.CATEGORY"""),
    "brand_daily": (["panel"], """
        SELECT ACTUALSHIPDATE, CATEGORY, BRAND, sum("Total CBM") AS "Total CBM", sum("Total QTY") AS "Total QTY"
        FROM panel GROUP BY ALL"""),
    "brand_dense": (["brand_daily", "span"], """
        SELECT s.day AS ACTUALSHIPDATE, k.CATEGORY, k.BRAND, coalesce(d."Total QTY", 0e0) AS "Total QTY",
          coalesce(d."Total CBM", 0e0) AS "Total CBM"
        FROM span s CROSS JOIN (SELECT DISTINCT CATEGORY, BRAND FROM brand_daily) k
        LEFT JOIN brand_daily d ON d.ACTUALSHIPDATE = s.day AND d.CATEGORY = k.CATEGORY AND d.BRAND = k.BRAND"""),
    "cal": ([], _values()),
    "closed": (["cal"], "SELECT DISTINCT date FROM cal WHERE kind = 'business'"),
    "observed": (["cal"], "SELECT DISTINCT date FROM cal WHERE kind = 'model'"),
    "tet_start": (["cal"], "SELECT min(date) AS date FROM cal WHERE kind = 'model' AND name = 'tet' GROUP BY key_year"),
    "autumn": (["cal"], "SELECT min(date) AS date FROM cal WHERE kind = 'model' AND name = 'mid_autumn' GROUP BY key_year"),
    "major": (["cal"], """SELECT date, row_number() OVER (ORDER BY key_year, CASE name WHEN 'tet' THEN 0 ELSE 1 END, date)
        AS ord FROM cal WHERE kind = 'model' AND name IN ('tet', 'mid_autumn')"""),
    "days": (["span", "closed", "observed", "tet_start", "autumn", "major"], f"""
        SELECT day, {pos('day')} AS p, i_next, i_last, tet, next_autumn, near FROM (
          SELECT s.day,
            (SELECT min(date) FROM observed o WHERE o.date > s.day) AS n_obs,
            coalesce(date_diff('day', s.day, (SELECT min(date) FROM observed o WHERE o.date > s.day)), {FAR}) AS i_next,
            coalesce(date_diff('day', (SELECT max(date) FROM observed o WHERE o.date <= s.day), s.day), {FAR}) AS i_last,
            coalesce(date_diff('day', s.day, (SELECT min(date) FROM tet_start t WHERE t.date >= s.day)), {FAR}) AS tet,
            date_diff('day', s.day, (SELECT min(date) FROM autumn a WHERE a.date > s.day)) AS next_autumn,
            date_diff('day', s.day, n.date) AS near
          FROM span s JOIN (
            SELECT day, date FROM (SELECT x.day, m.date, row_number() OVER (
              PARTITION BY x.day ORDER BY abs(date_diff('day', x.day, m.date)), m.ord) AS k
              FROM span x CROSS JOIN major m) WHERE k = 1) n ON n.day = s.day)"""),
    "lunar": (["days"], "SELECT day, p, CAST(p // 30 + 1 AS INTEGER) AS lm, CAST(p % 30 + 1 AS INTEGER) AS ld FROM days"),
    "fc": (["dense"], """
        SELECT date, CATEGORY, predicted, actual FROM (
          SELECT ACTUALSHIPDATE AS date, CATEGORY, "Total CBM" AS actual,
            avg("Total CBM") OVER (PARTITION BY CATEGORY ORDER BY ACTUALSHIPDATE
              ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS predicted FROM dense)
        WHERE predicted IS NOT NULL"""),
    "fcb": (["brand_dense"], """
        SELECT date, CATEGORY, BRAND, predicted, actual FROM (
          SELECT ACTUALSHIPDATE AS date, CATEGORY, BRAND, "Total CBM" AS actual,
            avg("Total CBM") OVER (PARTITION BY CATEGORY, BRAND ORDER BY ACTUALSHIPDATE
              ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS predicted FROM brand_dense)
        WHERE predicted IS NOT NULL"""),
}


def sql(body: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """`WITH <needed expressions in order> body`; `extra` adds query-local expressions."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in CTES[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in order]
    parts += [f"{n} AS ({t.strip()})" for n, t in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body.strip()}" if parts else body.strip()
