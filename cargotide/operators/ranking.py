"""Positions in a total order, found by range partitions and prefix counts.

No task orders the whole frame: rows are dealt to ranges of the order, sorted inside them and
written once; the sizes of the ranges (one row each) are summed up, and a row's position is the
sum before its range plus its place inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

#: Bits that `monotonically_increasing_id` gives to the row within its partition.
_PLACE_BITS = 33


def ranges_of(df: DataFrame) -> int:
    """Number of ranges: as many as the session's shuffles have partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_ranges(df: DataFrame, order: Sequence[Column], label: str = "ranges", ranges: int | None = None) -> DataFrame:
    """The rows with `_range`, the number of their range of the order, and `_place`, their place in
    it from 0; stored, so both stay as they are. Rows equal in the whole order stay in one range:
    combine them first, or add a column that tells them apart."""
    dealt = df.repartitionByRange(ranges or ranges_of(df), *order).sortWithinPartitions(*order)
    stamped = cut_lineage(dealt.withColumn("_stamp", F.monotonically_increasing_id()), label)
    return stamped.withColumns({"_range": F.shiftright("_stamp", _PLACE_BITS).cast("int"),
                                "_place": F.col("_stamp").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))}).drop("_stamp")


def with_positions(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """Adds the row's position in the order, from 0, without gaps. The order should be total: rows
    that it does not tell apart get neighbouring positions in any order."""
    rows = in_ranges(df, order, "positions")
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # one row per range: the window and the broadcast are bounded by the number of ranges
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(starts), "_range")
            .withColumn(out, F.col("_before") + F.col("_place")).drop("_range", "_place", "_before"))
