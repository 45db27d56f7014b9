"""Raw lines that cannot be used, told apart and counted in the pass that uses the others.

A line leaves the panel for one reason, the first that holds. The reason is a column, so the same pass feeds
the panel, the counts (an observation, no extra job) and, where wanted, a table of the rejected lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..columns import BRAND, CATEGORY, DATE, SKU, WAREHOUSE
from ..functions.cleaning import EXCLUDED_CATEGORIES, category_allowed

REASON = "reject_reason"
# In the order in which they are tested.
REASONS = ("unreadable", "missing_date", "missing_sku", "unknown_sku", "excluded_category", "missing_key")


def mark_lines(lines: DataFrame, master: DataFrame, excluded: Sequence[str] = EXCLUDED_CATEGORIES, unreadable: str | None = None) -> DataFrame:
    """J1 with reasons. The lines joined to the master (its category wins) and `reject_reason`, null for a line that
    the panel can use. `unreadable` names the readers' column of texts that gave no value. One join, one pass."""
    known = master.select(F.col(SKU).alias("_sku"), BRAND, "CATEGORY_MASTER")
    sku = F.trim(F.col(SKU))
    joined = lines.join(known, sku == F.col("_sku"), "left").withColumn(CATEGORY, F.coalesce("CATEGORY_MASTER", CATEGORY))
    tests: dict[str, Column] = {
        "unreadable": F.lit(False) if unreadable is None else F.col(unreadable).isNotNull(),
        "missing_date": F.col(DATE).isNull(),
        "missing_sku": sku.isNull() | (sku == ""),
        "unknown_sku": F.col("_sku").isNull(),
        "excluded_category": ~category_allowed(CATEGORY, excluded),
        "missing_key": F.col(CATEGORY).isNull() | F.col(BRAND).isNull() | F.col(WAREHOUSE).isNull()}
    reason = F.coalesce(*[F.when(tests[name], F.lit(name)) for name in REASONS])
    return joined.withColumn(REASON, reason).drop("_sku", "CATEGORY_MASTER")


def observed(marked: DataFrame, counts: Observation) -> DataFrame:
    """The same rows; after the first action on them `counts.get` holds the lines, the good ones and those of
    each reason. A task that runs twice after a lost executor may be counted twice."""
    per_reason = [F.count(F.when(F.col(REASON) == name, 1)).alias(name) for name in REASONS]
    return marked.observe(counts, F.count(F.lit(1)).alias("lines"), F.count(F.when(F.col(REASON).isNull(), 1)).alias("good"), *per_reason)


def good_lines(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col(REASON).isNull()).drop(REASON)


def rejected_lines(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col(REASON).isNotNull())


def reject_counts(marked: DataFrame) -> DataFrame:
    """`reject_reason, lines, skus` as a table; good lines are not in it."""
    return rejected_lines(marked).groupBy(REASON).agg(F.count(F.lit(1)).alias("lines"), F.count_distinct(SKU).alias("skus"))
