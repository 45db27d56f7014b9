"""Queries: sources, sinks, cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..columns import BRAND, CATEGORY, CBM, DATE, LINE_CBM, LINE_QTY, SKU, WAREHOUSE
from ..functions import cleaning as C
from ..operators import panel as P, rejects
from ..operators.history import append_history, upsert
from ..operators.scoring import run_scores
from ..operators.stats import encode_categories
from ..session import cut_lineage, scratch_path
from ..sources import readers as R, writers as W
from . import shipments as S
from .catalog import query, r, rounded
from .queries_forecast import forecast_frame
from .sqltext import i, r as rs, sql


@query("S1_read_years", sql(f"""
    SELECT year(ACTUALSHIPDATE) AS year, CATEGORY, count(*) AS rows, {rs('sum("Total CBM")')} AS cbm
    FROM panel WHERE year(ACTUALSHIPDATE) BETWEEN 1996 AND 1999 GROUP BY ALL""", "panel"))
def s1(spark: SparkSession, d: str) -> DataFrame:
    """Written per year, then only four years are read back."""
    path = scratch_path(spark, "panel-years")
    W.write_panel(S.panel(spark, d), path, "csv")
    back = R.read_years(spark, path, range(1996, 2000), "year={year}")
    return back.groupBy(F.year(DATE).cast("bigint").alias("year"), CATEGORY).agg(
        F.count("*").alias("rows"), r(F.sum(f"`{CBM}`")).alias("cbm"))


def _report_files(spark: SparkSession, d: str) -> str:
    """Raw lines stored under dated report names, one folder per year of the raw timestamp."""
    path = scratch_path(spark, "reports")
    y = F.year(DATE).cast("string")
    named = S.lines(spark, d).withColumn("f", F.concat(F.lit("Outboundreports_"), y, F.lit("0101_"), y, F.lit("1231")))
    named.write.partitionBy("f").option("header", True).csv(path)
    return path


@query("S2_read_by_prefix", sql(f"""
    SELECT year(ACTUALSHIPDATE) AS file_year, count(*) AS rows, {rs('sum(QTY)')} AS qty FROM lines
    WHERE year(ACTUALSHIPDATE) IN (1997, 2000) GROUP BY ALL""", "lines"))
def s2(spark: SparkSession, d: str) -> DataFrame:
    rows = R.read_by_prefix(spark, _report_files(spark, d), "f=Outboundreports", [1997, 2000])
    year = F.regexp_extract("source_file", R.REPORT_YEAR, 1).cast("bigint")
    return rows.groupBy(year.alias("file_year")).agg(F.count("*").alias("rows"), r(F.sum("QTY")).alias("qty"))


def _messy_files(spark: SparkSession, d: str) -> str:
    """Raw lines as text files, one folder per warehouse, some with texts that give no value and keys that are missing."""
    path = scratch_path(spark, "messy")
    key = F.col("l_orderkey")
    clock = F.col("l_shipdate") + F.make_dt_interval(hours=(key % 24).cast("int"))
    raw = S.table(spark, d, "lineitem")
    text = (F.when(key % 41 == 1, F.lit("soon")).when(key % 41 == 2, F.lit(None)).when(key % 3 == 0, F.date_format(clock, "dd/MM/yyyy hh:mm:ss a"))
            .when(key % 3 == 1, F.concat(F.date_format(clock + F.make_dt_interval(hours=F.lit(7)), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00")))
            .otherwise(F.date_format(clock, "yyyy-MM-dd HH:mm:ss")))
    sku = F.when(key % 43 == 1, F.lit("none")).when(key % 43 == 2, F.lit(" ")).otherwise(F.col("l_partkey").cast("string"))
    rows = raw.select(
        sku.alias(SKU), text.alias(DATE), F.when(key % 47 != 1, F.concat(F.lit("WH"), (F.col("l_suppkey") % 3).cast("string"))).alias(WAREHOUSE),
        F.lit(None).cast("string").alias(CATEGORY), F.when(key % 53 == 1, F.lit("many")).otherwise(F.col("l_quantity").cast("string")).alias(LINE_QTY),
        F.lit("1.5").alias(LINE_CBM), F.concat(F.lit("lines_200"), (F.col("l_suppkey") % 3).cast("string")).alias("f"))
    rows.write.partitionBy("f").option("header", True).csv(path)
    return path


REJECT_SQL = """SELECT SKU, CASE WHEN k % 41 = 1 OR k % 53 = 1 THEN 'unreadable' WHEN k % 41 = 2 THEN 'missing_date' WHEN k % 43 = 2 THEN 'missing_sku'
    WHEN k % 43 = 1 OR c IS NULL THEN 'unknown_sku' WHEN c = 'OTHER' THEN 'excluded_category' WHEN k % 47 = 1 THEN 'missing_key' END AS reject_reason, d, q
    FROM (SELECT l_orderkey AS k, CASE WHEN l_orderkey % 43 = 1 THEN 'none' WHEN l_orderkey % 43 = 2 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS SKU,
      m.CATEGORY_MASTER AS c, l_shipdate + to_hours(CAST(l_orderkey % 24 AS BIGINT)) AS d, l_quantity AS q
      FROM lineitem LEFT JOIN master m ON m.SKU = CAST(l_partkey AS VARCHAR))"""


def _marked(spark: SparkSession, d: str) -> DataFrame:
    lines = R.read_by_prefix(spark, _messy_files(spark, d), "f=lines", [2000, 2001, 2002], source_column=None, unreadable="unreadable")
    return rejects.mark_lines(lines, S.master(spark, d), ("OTHER",), "unreadable")


@query("J1_reject_counts", sql("SELECT reject_reason, count(*) AS lines, count(DISTINCT SKU) AS skus FROM x WHERE reject_reason IS NOT NULL GROUP BY ALL",
                               "master", extra={"x": REJECT_SQL}))
def j1_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Messy text files: every line that the panel cannot use, by reason."""
    counts = rejects.reject_counts(_marked(spark, d))
    return counts.withColumn("skus", F.col("skus").cast("bigint"))


@query("S2_good_lines_of_messy_files", sql(f"""SELECT CAST(d AS DATE) AS day, count(*) AS rows, {rs('sum(q)')} AS qty, {rs('sum(hour(d))', 0)} AS hours
    FROM x WHERE reject_reason IS NULL GROUP BY ALL""", "master", extra={"x": REJECT_SQL}))
def s2_good(spark: SparkSession, d: str) -> DataFrame:
    """The other lines keep their time of day, from three layouts with and without a zone."""
    good = rejects.good_lines(_marked(spark, d))
    return good.groupBy(F.to_date(DATE).alias("day")).agg(F.count("*").alias("rows"), r(F.sum(LINE_QTY)).alias("qty"),
                                                          r(F.sum(F.hour(DATE)).cast("double"), 0).alias("hours"))


@query("S3_prune_files_by_range", sql("""
    SELECT name FROM (SELECT 'Outboundreports_' || strftime(min(ACTUALSHIPDATE), '%Y%m%d') || '_'
        || strftime(max(ACTUALSHIPDATE), '%Y%m%d') || '.csv' AS name,
        CAST(min(ACTUALSHIPDATE) AS DATE) AS lo, CAST(max(ACTUALSHIPDATE) AS DATE) AS hi
      FROM lines GROUP BY year(ACTUALSHIPDATE), month(ACTUALSHIPDATE))
    WHERE hi >= DATE '1997-03-10' AND lo <= DATE '1998-02-05'""", "lines"))
def s3(spark: SparkSession, d: str) -> DataFrame:
    stamp = lambda c: F.date_format(c, "yyyyMMdd")
    files = S.lines(spark, d).groupBy(F.year(DATE), F.month(DATE)).agg(F.concat(
        F.lit("Outboundreports_"), stamp(F.min(DATE)), F.lit("_"), stamp(F.max(DATE)), F.lit(".csv")).alias("name"))
    return R.prune_files_by_range(files.select("name"), "1997-03-10", "1998-02-05")


@query("S4_read_date_range", sql(f"""
    SELECT CAST(ACTUALSHIPDATE AS DATE) AS day, count(*) AS rows, {rs('sum(QTY)')} AS qty FROM lines
    WHERE CAST(ACTUALSHIPDATE AS DATE) BETWEEN DATE '1997-11-20' AND DATE '1998-01-15' GROUP BY ALL""", "lines"))
def s4(spark: SparkSession, d: str) -> DataFrame:
    rows = R.read_date_range(spark, _report_files(spark, d), "1997-11-20", "1998-01-15", "f=Outboundreports")
    return rows.groupBy(F.to_date(DATE).alias("day")).agg(F.count("*").alias("rows"), r(F.sum("QTY")).alias("qty"))


@query("S5_read_csv_with_encoding", sql(f"""
    SELECT BRAND || 'é' AS BRAND, count(*) AS rows, {rs('sum("Total CBM")')} AS cbm FROM panel GROUP BY ALL""", "panel"))
def s5(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "latin")
    rows = S.panel(spark, d).select(F.concat(BRAND, F.lit("é")).alias(BRAND), F.col(f"`{CBM}`").alias("cbm"))
    rows.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    back = R.read_csv_with_encoding(spark, [path], "BRAND string, cbm double")
    return back.groupBy(BRAND).agg(F.count("*").alias("rows"), r(F.sum("cbm")).alias("cbm"))


@query("S6_parse_mixed_dates", """
    SELECT CAST(l_orderkey % 4 AS INTEGER) AS layout, d AS parsed, count(*) AS rows FROM (
      SELECT l_orderkey, CASE WHEN l_orderkey % 4 = 3 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS d FROM lineitem)
    GROUP BY ALL""")
def s6(spark: SparkSession, d: str) -> DataFrame:
    layout = (F.col("l_orderkey") % 4).cast("int")
    text = (F.when(layout == 0, F.date_format("l_shipdate", "dd/MM/yyyy"))
            .when(layout == 1, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
            .when(layout == 2, F.date_format("l_shipdate", "dd-MM-yyyy")).otherwise("n/a"))
    return (S.table(spark, d, "lineitem").select(layout.alias("layout"), C.parse_mixed_date(text).alias("parsed"))
            .groupBy("layout", "parsed").agg(F.count("*").alias("rows")))


@query("S7_load_sku_master", sql("SELECT SKU, BRAND, CATEGORY_MASTER FROM master", "master"))
def s7(spark: SparkSession, d: str) -> DataFrame:
    """Every SKU twice in the raw list; one row each comes back."""
    raw = S.raw_master(spark, d)
    return P.load_sku_master(raw.unionByName(raw))


@query("S8_write_panel", sql(f"""
    SELECT year(ACTUALSHIPDATE) AS year, CAST(isodow(ACTUALSHIPDATE) AS VARCHAR) || '.' || dayname(ACTUALSHIPDATE) AS Week,
      count(*) AS rows, {rs('sum("Total CBM")')} AS cbm FROM panel GROUP BY ALL""", "panel"))
def s8(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "panel")
    W.write_panel(S.panel(spark, d), path)
    return spark.read.parquet(path).groupBy(F.col("year").cast("bigint").alias("year"), "Week").agg(
        F.count("*").alias("rows"), r(F.sum(f"`{CBM}`")).alias("cbm"))


@query("S9_write_forecasts", sql(f"""
    SELECT CATEGORY, BRAND, year(date) AS year, count(*) AS rows, {rs('sum(predicted)')} AS predicted
    FROM fcb GROUP BY ALL""", "fcb"))
def s9(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "forecasts")
    W.write_forecasts(forecast_frame(spark, d, (CATEGORY, BRAND)), path)
    return W.combined_forecasts(spark, path).groupBy(CATEGORY, BRAND, F.col("year").cast("bigint").alias("year")).agg(
        F.count("*").alias("rows"), r(F.sum("predicted")).alias("predicted"))


MONTH_SQL = """SELECT CAST(year(date) AS INTEGER) AS "Year", CATEGORY, CAST(month(date) AS INTEGER) AS "Month",
    sum(predicted) AS predicted, sum(actual) AS actual FROM fc GROUP BY ALL"""


@query("S10_upsert", sql(f"""
    SELECT coalesce(n."Year", o."Year") AS "Year", coalesce(n.CATEGORY, o.CATEGORY) AS CATEGORY,
      coalesce(n."Month", o."Month") AS "Month", {rs('coalesce(n.predicted, o.predicted)')} AS predicted,
      {rs('o.actual')} AS actual
    FROM (SELECT "Year", CATEGORY, "Month", CASE WHEN "Month" % 2 = 0 THEN predicted * 2 END AS predicted
          FROM m WHERE "Year" >= 1999) n
    FULL JOIN (SELECT * FROM m WHERE "Year" <= 2000) o
      ON n."Year" = o."Year" AND n.CATEGORY = o.CATEGORY AND n."Month" = o."Month" """, "fc", extra={"m": MONTH_SQL}))
def s10(spark: SparkSession, d: str) -> DataFrame:
    """Stored months up to 2000; new months from 1999 on with empty cells in odd months."""
    months = forecast_frame(spark, d).groupBy(
        F.year("date").alias("Year"), CATEGORY, F.month("date").alias("Month")).agg(
        F.sum("predicted").alias("predicted"), F.sum("actual").alias("actual"))
    existing = months.filter(F.col("Year") <= 2000)
    new = months.filter(F.col("Year") >= 1999).select(
        "Year", CATEGORY, "Month", F.when(F.col("Month") % 2 == 0, F.col("predicted") * 2).alias("predicted"))
    return rounded(upsert(existing, new, ["Year", CATEGORY, "Month"], "Year"), "predicted", "actual")


@query("S10_upsert_partitions", sql(f"""
    SELECT coalesce(n."Year", o."Year") AS "Year", coalesce(n.CATEGORY, o.CATEGORY) AS CATEGORY, coalesce(n."Month", o."Month") AS "Month",
      {rs('coalesce(n.predicted, o.predicted)')} AS predicted, {rs('o.actual')} AS actual
    FROM (SELECT "Year", CATEGORY, "Month", CASE WHEN "Month" % 2 = 0 THEN predicted * 2 END AS predicted FROM m WHERE "Year" >= 2000) n
    FULL JOIN (SELECT * FROM m WHERE "Year" <= 2000) o ON n."Year" = o."Year" AND n.CATEGORY = o.CATEGORY AND n."Month" = o."Month" """, "fc", extra={"m": MONTH_SQL}))
def s10_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Stored months up to 2000 in a folder per year; new months from 2000 on replace and add one folder each."""
    path = scratch_path(spark, "months")
    months = cut_lineage(forecast_frame(spark, d).groupBy(F.year("date").alias("Year"), CATEGORY, F.month("date").alias("Month")).agg(
        F.sum("predicted").alias("predicted"), F.sum("actual").alias("actual")), "months")
    months.filter(F.col("Year") <= 2000).write.partitionBy("Year").parquet(path)
    new = months.filter(F.col("Year") >= 2000).select("Year", CATEGORY, "Month", F.when(F.col("Month") % 2 == 0, F.col("predicted") * 2).alias("predicted"))
    W.upsert_partitions(spark, path, new, ["Year", CATEGORY, "Month"], ["Year"])
    return rounded(spark.read.parquet(path), "predicted", "actual")


@query("S11_append_history", sql(f"""
    SELECT CATEGORY, "Year", {rs('mae')} AS mae, NULL::DOUBLE AS rmse FROM s WHERE "Year" < 1999
    UNION ALL SELECT CATEGORY, "Year", {rs('mae')} AS mae, {rs('rmse')} AS rmse FROM s WHERE "Year" >= 1999""", "fc",
    extra={"s": """SELECT CATEGORY, CAST(year(date) AS INTEGER) AS "Year", avg(abs(predicted - actual)) AS mae,
        sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse FROM fc GROUP BY ALL"""}))
def s11(spark: SparkSession, d: str) -> DataFrame:
    """The stored history has no rmse column yet."""
    e = F.col("predicted") - F.col("actual")
    scores = forecast_frame(spark, d).groupBy(CATEGORY, F.year("date").alias("Year")).agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"))
    old = scores.filter(F.col("Year") < 1999).drop("rmse")
    return rounded(append_history(old, scores.filter(F.col("Year") >= 1999)), "mae", "rmse")


@query("S12_scan_runs", sql(f"""
    SELECT 'run_' || CAST(year(date) AS VARCHAR) || '0101_000000' AS run_id, 'recursive' AS mode,
      {rs('avg(abs(predicted - actual))')} AS mae, {rs('avg((predicted - actual) * (predicted - actual))')} AS mse,
      {rs('sqrt(avg((predicted - actual) * (predicted - actual)))')} AS rmse FROM fc GROUP BY ALL""", "fc"))
def s12(spark: SparkSession, d: str) -> DataFrame:
    """Forecast rows stored as one run folder per year, scored from the folders."""
    base = scratch_path(spark, "runs")
    run = F.concat(F.lit("run_"), F.year("date").cast("string"), F.lit("0101_000000"))
    (forecast_frame(spark, d).select("predicted", "actual", run.alias("x"), F.lit("predictions_recursive").alias("y"))
     .write.partitionBy("x", "y").option("header", True).csv(base))
    rows = R.read_runs(spark, base, "predicted double, actual double", pattern="x=run_*/y=predictions_*")
    return rounded(run_scores(rows), "mae", "mse", "rmse")


# ---------------------------------------------------------------- cleaning

@query("P1_business_date", """
    SELECT CAST(CASE WHEN hour(ts + INTERVAL 7 HOUR) >= 17 THEN ts + INTERVAL 7 HOUR + INTERVAL 1 DAY
      ELSE ts + INTERVAL 7 HOUR END AS DATE) AS business_date, event_type, count(*) AS rows
    FROM events GROUP BY ALL""")
def p1(spark: SparkSession, d: str) -> DataFrame:
    """The oracle applies the two steps one after the other."""
    return (S.table(spark, d, "events").select(C.business_date("ts").alias("business_date"), "event_type")
            .groupBy("business_date", "event_type").agg(F.count("*").alias("rows")))


@query("P2_week_day_labels", sql(f"""
    SELECT ACTUALSHIPDATE, CATEGORY, CAST(isodow(ACTUALSHIPDATE) AS VARCHAR) || '.' || dayname(ACTUALSHIPDATE) AS "Week",
      {i('day(ACTUALSHIPDATE)')} AS "Day" FROM daily""", "daily"))
def p2(spark: SparkSession, d: str) -> DataFrame:
    return P.with_labels(S.daily(spark, d).select(DATE, CATEGORY))


@query("P3_bucket_by_business_year", sql(f"""
    SELECT {i('year(l.ACTUALSHIPDATE)')} AS file_year, {i('year(CAST(l.ACTUALSHIPDATE + INTERVAL 14 HOUR AS DATE))')} AS year,
      count(*) AS rows FROM lines l GROUP BY ALL""", "lines"))
def p3(spark: SparkSession, d: str) -> DataFrame:
    """Rows per file year and business year: lines of late 31 December move on, none is lost."""
    rows = S.lines(spark, d).select(F.year(DATE).alias("file_year"), C.business_date(DATE).alias(DATE))
    return P.with_business_year(rows).groupBy("file_year", "year").agg(F.count("*").alias("rows"))


@query("P4_apply_unit_overrides", sql(f"""
    SELECT SKU, {rs("sum(CASE WHEN SKU = '11' THEN QTY / 120e0 * 0.019e0 ELSE QTY END)")} AS qty,
      {rs("sum(CASE WHEN SKU = '7' THEN QTY / 16e0 * 0.0270137e0 ELSE CUBE_OUT END)")} AS cbm FROM lines GROUP BY SKU""", "lines"))
def p4(spark: SparkSession, d: str) -> DataFrame:
    rows = S.lines(spark, d).withColumns({LINE_CBM: C.unit_override(LINE_CBM, rules=S.RULES),
                                          LINE_QTY: C.unit_override(LINE_QTY, rules=S.RULES)})
    return rows.groupBy(SKU).agg(r(F.sum(LINE_QTY)).alias("qty"), r(F.sum(LINE_CBM)).alias("cbm"))


@query("P5_rescale_outliers", sql(f"""
    SELECT WHSEID, count(*) FILTER (CUBE_OUT >= 2.7e0) AS outliers,
      {rs("sum(CASE WHEN CUBE_OUT >= 2.7e0 AND SKU <> '7' THEN CUBE_OUT / 1000e0 ELSE CUBE_OUT END)")} AS cbm
    FROM lines GROUP BY ALL""", "lines"))
def p5(spark: SparkSession, d: str) -> DataFrame:
    fixed = C.rescale_outlier(LINE_CBM, exclude=F.col(SKU) == "7")
    return S.lines(spark, d).groupBy(WAREHOUSE).agg(
        F.count(F.when(F.col(LINE_CBM) >= C.CBM_OUTLIER_THRESHOLD, 1)).alias("outliers"), r(F.sum(fixed)).alias("cbm"))


@query("P6_drop_categories", sql("""
    SELECT CATEGORY, WHSEID, count(*) AS rows FROM lines
    WHERE CATEGORY IS DISTINCT FROM 'TEST' AND CATEGORY IS DISTINCT FROM 'OFFBOM' GROUP BY ALL""", "lines"))
def p6(spark: SparkSession, d: str) -> DataFrame:
    """Lines of unknown category stay."""
    return P.drop_categories(S.lines(spark, d)).groupBy(CATEGORY, WAREHOUSE).agg(F.count("*").alias("rows"))


@query("P7_coerce_numeric", f"""
    SELECT event_type, count(*) FILTER (x IS NULL) AS unreadable, {rs('sum(coalesce(x, 0e0))')} AS total FROM (
      SELECT event_type, TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS x
      FROM events) GROUP BY ALL""")
def p7(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("string"))
    rows = S.table(spark, d, "events").select("event_type", text.alias("t"))
    return rows.groupBy("event_type").agg(F.count(F.when(C.numeric("t").isNull(), 1)).alias("unreadable"),
                                          r(F.sum(C.numeric("t", 0.0))).alias("total"))


@query("P8_list_brands", sql("SELECT DISTINCT BRAND FROM clean WHERE CATEGORY = 'DRY' ORDER BY 1", "clean"))
def p8(spark: SparkSession, d: str) -> DataFrame:
    rows = S.panel(spark, d)
    noise = rows.select(F.lit("DRY").alias(CATEGORY), F.element_at(F.array(F.lit(" "), F.lit("nan"), F.lit(None).cast("string")),
                        F.weekday(DATE) % 3 + 1).alias(BRAND))
    return P.list_brands(rows.select(CATEGORY, BRAND).unionByName(noise), "DRY")


@query("P9_select_series", sql(f"""
    SELECT ACTUALSHIPDATE, WHSEID, {rs('"Total CBM"')} AS cbm FROM panel
    WHERE CATEGORY = 'FRESH' AND BRAND = 'Brand#7'""", "panel"))
def p9(spark: SparkSession, d: str) -> DataFrame:
    rows = P.select_series(S.panel(spark, d), "FRESH", "Brand#7")
    return rows.select(DATE, WAREHOUSE, r(CBM).alias("cbm"))


@query("P10_slice_dates", sql(f"""
    SELECT CAST(ACTUALSHIPDATE + INTERVAL 14 HOUR AS DATE) AS day, count(*) AS rows, {rs('sum(QTY)')} AS qty FROM lines
    WHERE CAST(ACTUALSHIPDATE + INTERVAL 14 HOUR AS DATE) BETWEEN DATE '1998-12-25' AND DATE '1999-03-31'
    GROUP BY ALL""", "lines"))
def p10(spark: SparkSession, d: str) -> DataFrame:
    """On raw lines the range of business days is a range of raw timestamps."""
    rows = P.slice_business_dates(S.lines(spark, d), "1998-12-25", "1999-03-31")
    return rows.groupBy(C.business_date(DATE).alias("day")).agg(F.count("*").alias("rows"), r(F.sum("QTY")).alias("qty"))


@query("P11_select_features", sql(f"""
    SELECT CATEGORY, {rs('"Total CBM"')} AS "Total CBM", 0e0 AS cbm_last_year,
      {i('dayofmonth(ACTUALSHIPDATE) - 1')} AS days_from_month_start FROM daily""", "daily"))
def p11(spark: SparkSession, d: str) -> DataFrame:
    """One wanted column exists, one is computed, one is unknown and becomes 0."""
    rows = P.select_features(S.daily(spark, d), [CATEGORY, CBM, "cbm_last_year", "days_from_month_start"], "zero",
                             {"days_from_month_start": (F.dayofmonth(DATE) - 1).alias("days_from_month_start")})
    return rounded(rows, CBM)


@query("P12_slug", """SELECT p_brand, translate(p_name || '/' || p_type, ' /', '__') AS slug, count(*) AS rows
    FROM part GROUP BY ALL""")
def p12(spark: SparkSession, d: str) -> DataFrame:
    name = C.slug(F.concat("p_name", F.lit("/"), "p_type")).alias("slug")
    return S.table(spark, d, "part").groupBy("p_brand", name).agg(F.count("*").alias("rows"))


@query("P13_keep_known_categories", sql("""
    SELECT CATEGORY, count(*) AS rows FROM panel WHERE CATEGORY IN (SELECT CATEGORY FROM daily
      WHERE ACTUALSHIPDATE < DATE '1995-01-06') GROUP BY ALL""", "panel", "daily"))
def p13(spark: SparkSession, d: str) -> DataFrame:
    """Known are the categories of the first four days."""
    rows = S.panel(spark, d)
    known = encode_categories(rows.filter(F.col(DATE) < F.lit("1995-01-06").cast("date")))
    return P.keep_known_categories(rows, known).groupBy(CATEGORY).agg(F.count("*").alias("rows"))
