"""From raw lines to the daily panel and its summaries
(SURVEY P3, P8-P11, P13, J1, J2, A1-A8, A15, A16, S7).

Scale notes. Lines are cleaned by column expressions and reduced by one map-side combined
aggregation, so the shuffle carries at most one row per (day, warehouse, category, brand)
and map task, however many lines one key holds. The master join has no hint: Spark checks
its size against `spark.sql.autoBroadcastJoinThreshold`; beyond it the join is shuffled
and adaptive execution splits a hot SKU.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..columns import BRAND, CATEGORY, CBM, DATE, LINE_CBM, LINE_QTY, PANEL_KEYS, QTY, SERIES_KEYS, SKU
from ..functions.cleaning import (EXCLUDED_CATEGORIES, UNIT_RULES, UnitRule, as_column, business_date,
                                  category_allowed, day_label, rescale_outlier, unit_override, week_label)


# ---------------------------------------------------------------- cleaning

def load_sku_master(raw: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """S7. Detect the SKU, BRAND* and CATEGORY / *GROUP* / *CAGO* headers, trim the values
    and keep one row per SKU. A table has no row order, so the first row is the least by
    `tie_break` (default: brand, then category). `min_by` combines on the map side, so a SKU
    with very many copies is no hot spot."""
    headers = {c.strip().upper(): c for c in raw.columns}
    sku = headers.get("SKU")
    brand = next((c for h, c in headers.items() if h.startswith("BRAND")), None)
    category = next((c for h, c in headers.items()
                     if h == "CATEGORY" or "GROUP" in h or "CAGO" in h), None)
    if sku is None or brand is None:
        raise ValueError(f"master needs SKU and BRAND columns, found {raw.columns}")
    values = raw.select(
        F.trim(as_column(sku).cast("string")).alias(SKU),
        F.trim(as_column(brand).cast("string")).alias(BRAND),
        (F.upper(F.trim(as_column(category).cast("string"))) if category
         else F.lit(None).cast("string")).alias("CATEGORY_MASTER"),
        *[as_column(c).alias(f"_tie{i}") for i, c in enumerate(tie_break)])
    order = [f"_tie{i}" for i in range(len(tie_break))] or [BRAND, "CATEGORY_MASTER"]
    first = F.min_by(F.struct(BRAND, "CATEGORY_MASTER"), F.struct(*order))
    return values.groupBy(SKU).agg(first.alias("m")).select(SKU, "m.BRAND", "m.CATEGORY_MASTER")


def enrich_sku(lines: DataFrame, master: DataFrame) -> DataFrame:
    """J1. Inner join on the trimmed SKU; the master's category wins over the line's."""
    m = master.select(F.col(SKU).alias("_sku"), BRAND, "CATEGORY_MASTER")
    return (lines.join(m, F.trim(F.col(SKU)) == F.col("_sku"), "inner")
            .withColumn(CATEGORY, F.coalesce("CATEGORY_MASTER", CATEGORY))
            .drop("_sku", "CATEGORY_MASTER"))


def unmatched_sku_count(lines: DataFrame, master: DataFrame) -> DataFrame:
    """J1. Lines whose SKU the master does not know, per SKU count in one row."""
    unknown = lines.join(master.select(F.col(SKU).alias("_sku")),
                         F.trim(F.col(SKU)) == F.col("_sku"), "left_anti")
    return unknown.agg(F.count("*").alias("lines"), F.count_distinct(SKU).alias("skus"))


def drop_categories(df: DataFrame, excluded: Sequence[str] = EXCLUDED_CATEGORIES,
                    category: str = CATEGORY) -> DataFrame:
    """P6."""
    return df.filter(category_allowed(category, excluded))


def clean_measures(lines: DataFrame, rules: Sequence[UnitRule] = UNIT_RULES) -> DataFrame:
    """P4 then P5: rules that set the volume read the raw quantity, and SKUs with such a rule
    are not rescaled."""
    ruled = F.col(SKU).isin(*[r.sku for r in rules if r.target == LINE_CBM]) if rules else None
    volume = rescale_outlier(unit_override(LINE_CBM, rules=rules), exclude=ruled)
    return lines.withColumns({LINE_CBM: volume, LINE_QTY: unit_override(LINE_QTY, rules=rules)})


def daily_panel(lines: DataFrame, master: DataFrame, rules: Sequence[UnitRule] = UNIT_RULES,
                excluded: Sequence[str] = EXCLUDED_CATEGORIES, tz_hours: int = 7,
                cutoff_hour: int = 17, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """P1 + J1 + P6 + P4 + P5 + A1 in one pass over the lines. Rows with a missing key are
    left out, as grouping in the original does. Coarser `keys` go straight from the lines to
    the coarser totals with a single small shuffle."""
    return panel_of(drop_categories(enrich_sku(lines, master), excluded), rules, tz_hours, cutoff_hour, keys)


def panel_of(joined: DataFrame, rules: Sequence[UnitRule] = UNIT_RULES, tz_hours: int = 7, cutoff_hour: int = 17,
             keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """P1 + P4 + P5 + A1 of lines that have their brand and category."""
    dated = clean_measures(joined, rules).withColumn(DATE, business_date(DATE, tz_hours, cutoff_hour))
    return aggregate_panel(dated, keys)


def aggregate_panel(lines: DataFrame, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """A1. Sum quantity and volume per day and key."""
    complete = lines
    for k in (DATE, *PANEL_KEYS):
        complete = complete.filter(F.col(k).isNotNull())
    return complete.groupBy(DATE, *keys).agg(F.sum(LINE_QTY).alias(QTY), F.sum(LINE_CBM).alias(CBM))


def with_labels(df: DataFrame, date: str = DATE) -> DataFrame:
    """P2."""
    return df.withColumns({"Week": week_label(date), "Day": day_label(date)})


def with_business_year(df: DataFrame, date: str = DATE) -> DataFrame:
    """P3. The year of the business day is the storage bucket, so no row is lost when the
    day shift crosses a year end."""
    return df.withColumn("year", F.year(date))


def list_brands(df: DataFrame, category: str | None = None) -> DataFrame:
    """P8. Distinct brands without blanks and the text NAN."""
    rows = df if category is None else df.filter(F.col(CATEGORY) == category)
    name = F.trim(F.col(BRAND))
    return (rows.filter(F.col(BRAND).isNotNull() & (name != "") & (F.upper(name) != "NAN"))
            .select(name.alias(BRAND)).distinct().orderBy(BRAND))


def select_series(df: DataFrame, category: str, brand: str | None = None,
                  check: bool = False) -> DataFrame:
    """P9. One category or brand; with `check` an empty result is an error."""
    out = df.filter(F.col(CATEGORY) == category)
    if brand is not None:
        out = out.filter(F.col(BRAND) == brand)
    if check and out.isEmpty():
        raise ValueError(f"no rows for category {category!r} brand {brand!r}")
    return out


def slice_dates(df: DataFrame, start: str, end: str, date: str = DATE, check: bool = False) -> DataFrame:
    """P10. Half-open range [start, end + 1 day); a plain comparison, so it reaches the scan."""
    out = df.filter((F.col(date) >= F.lit(start).cast("date"))
                    & (F.col(date) < F.date_add(F.lit(end).cast("date"), 1)))
    if check and out.isEmpty():
        lo, hi = df.agg(F.min(date), F.max(date)).first()
        raise ValueError(f"no rows in [{start}, {end}]; available {lo} to {hi}")
    return out


def slice_business_dates(lines: DataFrame, start: str, end: str, ts: str = DATE, tz_hours: int = 7,
                         cutoff_hour: int = 17) -> DataFrame:
    """P10 on raw lines: the range of business days as a range of raw timestamps, so the
    predicate is pushed to the files instead of being hidden behind the day shift."""
    shift = F.expr(f"INTERVAL {tz_hours + 24 - cutoff_hour} HOURS")
    lo = F.lit(start).cast("date").cast("timestamp_ntz") - shift
    hi = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz") - shift
    return lines.filter((F.col(ts) >= lo) & (F.col(ts) < hi))


def select_features(df: DataFrame, wanted: Sequence[str], missing: str = "drop",
                    known: dict[str, Column] | None = None) -> DataFrame:
    """P11. Training keeps the wanted columns that exist; forecasting creates the others,
    from `known` expressions or as 0."""
    if missing == "drop":
        return df.select(*[as_column(c) for c in wanted if c in df.columns])
    if missing != "zero":
        raise ValueError("missing must be 'drop' or 'zero'")
    known = known or {}
    return df.select(*[as_column(c) if c in df.columns else known.get(c, F.lit(0.0)).alias(c)
                       for c in wanted])


def keep_known_categories(df: DataFrame, mapping: DataFrame, category: str = CATEGORY) -> DataFrame:
    """P13. Rows whose category has a trained id."""
    return df.join(mapping.select(category), category, "left_semi")


# ---------------------------------------------------------------- calendar densification

def densify_calendar(df: DataFrame, keys: Sequence[str] = PANEL_KEYS, scope: str = "all",
                     date: str = DATE, measures: Sequence[str] = (QTY, CBM)) -> DataFrame:
    """J2. One row per observed key and day between the first and last day of the frame
    (`scope='all'`) or of each year (`scope='year'`, keys seen in that year only).

    Each row is expanded up to the day before the key's next row, so there is no skeleton
    table and no join with it: one shuffle by key, which later windows over the same key
    reuse. The bounds come from a one-row (or one-row-per-year) aggregate over exactly the
    columns of the series, so Spark reuses the shuffled rows instead of reading the source
    a second time (the row count keeps the optimizer from planning the bounds differently).
    """
    df = df.select(date, *keys, *[as_column(m) for m in measures])
    row = F.struct(*[as_column(c) for c in df.columns])
    lo_day, hi_day = F.min(row)[date], F.max(row)[date]
    w = Window.partitionBy(*keys).orderBy(date)
    d = F.col(date)
    prev_day, next_day = F.lag(date).over(w), F.lead(date).over(w)
    if scope == "all":
        bounds = df.agg(F.struct(lo_day.alias("lo"), hi_day.alias("hi"), F.count("*").alias("rows"))).scalar()
        rows = df.select("*", prev_day.alias("_prev"), next_day.alias("_next"))
        lo, hi = bounds["lo"], bounds["hi"]
        same_prev, same_next = F.lit(True), F.lit(True)
    elif scope == "year":
        years = df.groupBy(F.year(date).alias("_y")).agg(lo_day.alias("_lo"), hi_day.alias("_hi"), F.count("*").alias("_rows"))
        rows = (df.select("*", prev_day.alias("_prev"), next_day.alias("_next"))
                .join(F.broadcast(years), F.year(date) == F.col("_y")))
        lo, hi = F.col("_lo"), F.col("_hi")
        same_prev, same_next = F.year("_prev") == F.year(d), F.year("_next") == F.year(d)
    else:
        raise ValueError("scope must be 'all' or 'year'")
    start = F.when(F.col("_prev").isNotNull() & same_prev, d).otherwise(lo)
    stop = F.when(F.col("_next").isNotNull() & same_next, F.date_sub("_next", 1)).otherwise(hi)
    days = rows.select("*", F.explode(F.sequence(start, stop)).alias("_day"))
    filled = {m: F.when(F.col("_day") == d, F.coalesce(F.col(f"`{m}`"), F.lit(0.0))).otherwise(F.lit(0.0))
              for m in measures}
    return days.select(F.col("_day").alias(date), *keys, *[c.alias(m) for m, c in filled.items()])


# ---------------------------------------------------------------- aggregates

def aggregate_daily(df: DataFrame, keys: Sequence[str] = SERIES_KEYS, target: str = CBM,
                    keep: Sequence[str] = (), date: str = DATE) -> DataFrame:
    """A2. Sum the target (and the quantity if it is another column) per day and key. Columns
    that are constant per day can be kept; recomputing them afterwards is cheaper."""
    sums = [target] + ([QTY] if QTY in df.columns and target != QTY else [])
    return df.groupBy(F.to_date(date).alias(date), *keys).agg(
        *[F.sum(as_column(c)).alias(c) for c in sums], *[F.min(as_column(c)).alias(c) for c in keep])


def monthly_summary(df: DataFrame, by_brand: bool = True, date: str = DATE) -> DataFrame:
    """A3. Monthly totals; sorted at the sink with `sort_summary`."""
    keys = [CATEGORY] + ([BRAND] if by_brand else [])
    return (df.groupBy(F.year(date).alias("Year"), *keys, F.month(date).alias("Month"))
            .agg(F.sum(as_column(QTY)).alias(QTY), F.sum(as_column(CBM)).alias(CBM))
            .select("Year", *keys, as_column(QTY), as_column(CBM), "Month"))


def sort_summary(df: DataFrame) -> DataFrame:
    """L1."""
    return df.orderBy(*[c for c in ("Year", "Month", CATEGORY, BRAND) if c in df.columns])


def month_year_pivot(df: DataFrame, years: Sequence[int], value: str = CBM, date: str = DATE) -> DataFrame:
    """A4. Months 1-12 as rows, one column per year, 0 where nothing was shipped. Plain
    conditional sums over one aggregation; the twelve months are a fixed table."""
    year = F.year(date)
    sums = df.groupBy(F.month(date).alias("Month")).agg(
        *[F.sum(F.when(year == y, as_column(value)).otherwise(0.0)).alias(str(y)) for y in years])
    months = df.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("Month"))
    return (months.join(sums, "Month", "left")
            .select("Month", *[F.coalesce(F.col(f"`{y}`"), F.lit(0.0)).alias(str(y)) for y in years]))


def series_stats(df: DataFrame, keys: Sequence[str] = (CATEGORY, BRAND), value: str = CBM,
                 date: str = DATE) -> DataFrame:
    """A7."""
    return df.groupBy(*keys).agg(F.count("*").alias("samples"), F.min(date).alias("first_date"),
                                 F.max(date).alias("last_date"), F.sum(as_column(value)).alias("total"))


def season_totals(df: DataFrame, months: Sequence[int], keys: Sequence[str] = (), value: str = CBM,
                  date: str = DATE) -> DataFrame:
    """A8."""
    return (df.filter(F.month(date).isin(*months)).groupBy(*keys, F.year(date).alias("year"))
            .agg(F.count("*").alias("rows"), F.sum(as_column(value)).alias("total"),
                 F.avg(as_column(value)).alias("mean")))


def busiest_dates(df: DataFrame, n: int, date: str = DATE) -> DataFrame:
    """A15, L2. Days with most rows; the earlier day wins a tie."""
    return (df.groupBy(date).agg(F.count("*").alias("rows"))
            .orderBy(F.desc("rows"), F.asc(date)).limit(n))


def coverage_report(df: DataFrame, by: Sequence[str] = (CATEGORY,), date: str = DATE) -> DataFrame:
    """A16. Rows and date range per category, with the overall row (null key) from the same
    aggregation."""
    return df.rollup(*by).agg(F.count("*").alias("rows"), F.min(date).alias("first_date"),
                              F.max(date).alias("last_date"), F.grouping_id().alias("level"))
