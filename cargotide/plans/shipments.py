"""Shipment data derived from the given tables: every row of `lineitem` is an outbound line,
every row of `part` a SKU. The same definitions exist as SQL text in `sqltext`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..columns import BRAND, CATEGORY, CBM, DATE, LINE_CBM, LINE_QTY, PANEL_KEYS, QTY, SKU, WAREHOUSE
from ..functions.cleaning import UnitRule
from ..operators.panel import daily_panel, densify_calendar, load_sku_master
from ..session import cut_lineage
from ..sources.calendars import holiday_calendar
from .stand_in_calendar import ANCHORS, CALENDAR_TEXT

CATEGORY_OF_TYPE = {"ECONOMY": "DRY", "STANDARD": "FRESH", "PROMO": "MOONCAKE",
                    "LARGE": "TET", "MEDIUM": "POSM", "SMALL": "OTHER"}
CATEGORY_OF_FLAG = {"A": "TEST", "R": "DRY"}
RULES = (UnitRule("7", LINE_CBM, 16.0, 0.0270137), UnitRule("11", LINE_QTY, 120.0, 0.019))
# Volume of one unit per size step. Its digits keep sums off rounding boundaries.
UNIT_VOLUME = 0.00217348391


SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """With the schema given, planning needs no job to look into file footers."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _case(column: str, mapping: dict[str, str]):
    out = F.lit(None).cast("string")
    for key, value in mapping.items():
        out = F.when(F.col(column) == key, value).otherwise(out)
    return out


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw outbound lines with a UTC time of day."""
    hours = F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_shipdate") + hours).alias(DATE),
        F.concat(F.lit("WH"), (F.col("l_suppkey") % 3).cast("string")).alias(WAREHOUSE),
        F.col("l_partkey").cast("string").alias(SKU), _case("l_returnflag", CATEGORY_OF_FLAG).alias(CATEGORY),
        F.col("l_quantity").alias(LINE_QTY),
        (F.col("l_quantity") * (F.col("l_partkey") % 50 + 1) * F.lit(UNIT_VOLUME)).alias(LINE_CBM))


def raw_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKU list with loose headers and padded values, as a spreadsheet export would have."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), F.col("p_partkey").cast("string")).alias(" sku "),
        F.concat(F.col("p_brand"), F.lit(" ")).alias("Brand Name"),
        F.lower(_case("p_type", CATEGORY_OF_TYPE)).alias("Group of Cago"))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_sku_master(raw_master(spark, sf_dir))


def panel(spark: SparkSession, sf_dir: str, keys=PANEL_KEYS) -> DataFrame:
    """Daily rows per (warehouse, category, brand)."""
    return daily_panel(lines(spark, sf_dir), master(spark, sf_dir), RULES, keys=keys)


def daily(spark: SparkSession, sf_dir: str, keys=(CATEGORY,)) -> DataFrame:
    """Daily totals per key; days without a shipment have no row."""
    return panel(spark, sf_dir, keys)


def dense(spark: SparkSession, sf_dir: str, keys=(CATEGORY,), measures=(CBM,)) -> DataFrame:
    """Daily totals per key without missing days. Ask for the measures that are used, so the
    bounds of the calendar and the series share one shuffled aggregate."""
    return densify_calendar(daily(spark, sf_dir, keys), keys, measures=measures)


def stored_dense(spark: SparkSession, sf_dir: str, keys=(CATEGORY,), measures=(CBM,)) -> DataFrame:
    """`dense`, written once: a job that takes its history, its actuals and its keys from it reads the lines once."""
    return cut_lineage(dense(spark, sf_dir, keys, measures), "dense")


def calendar(spark: SparkSession) -> DataFrame:
    return holiday_calendar(spark, CALENDAR_TEXT)


__all__ = ["ANCHORS", "BRAND", "CATEGORY", "CBM", "DATE", "QTY", "RULES", "calendar", "daily", "dense", "lines", "master",
           "panel", "raw_master", "stored_dense", "table"]
