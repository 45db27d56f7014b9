"""Exact quantiles without sorting a column, or a group, in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.cleaning import as_column
from ..session import cut_lineage
from .ranking import in_ranges

Keys = Sequence[str]


def grouped_quantiles(df: DataFrame, by: Keys, value: str | Column, qs: Sequence[float], ranges: int | None = None) -> DataFrame:
    """One row per group that has a value: the keys, `n` (its values that are not null) and `quantiles`, the exact
    linear-interpolated quantiles in the order of `qs`. Null keys are groups too. Stored.

    Equal values of a group are combined first, so a value that fills a third of the rows is one
    row. The combined rows are dealt to ranges of (keys, value), also where one group fills them all;
    sums per group and range (a row each) give the range that holds a wanted rank, and only those
    ranges are read again.
    """
    key = F.struct(*[F.col(k) for k in by]) if by else F.struct(F.lit(0).alias("all"))
    v = as_column(value).cast("double")
    rows = df.select(key.alias("_k"), v.alias("_v")).filter(F.col("_v").isNotNull())
    counts = rows.groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranged = in_ranges(counts, [F.col("_k"), F.col("_v")], "quantiles", ranges)

    # one row per group and range: a window of a group has at most as many rows as there are ranges
    sums = ranged.groupBy("_k", "_range").agg(F.sum("_c").alias("_here"))
    earlier = Window.partitionBy("_k").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumns({"_before": F.coalesce(F.sum("_here").over(earlier), F.lit(0)),
                               "_n": F.sum("_here").over(Window.partitionBy("_k"))})
    wanted = placed.select("*", F.posexplode(F.array(*[F.lit(float(q)) for q in qs])).alias("_i", "_q"))
    wanted = wanted.withColumn("_at", F.col("_q") * (F.col("_n") - 1))
    ends = wanted.select("*", F.explode(F.array(F.floor("_at"), F.ceil("_at"))).alias("_rank"))
    targets = cut_lineage(
        ends.filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_here")))
        .select("_k", "_range", "_n", "_i", "_at", "_rank", (F.col("_rank") - F.col("_before")).alias("_in")).distinct(), "ranks")

    near = ranged.join(targets.select("_k", "_range").distinct(), ["_k", "_range"], "left_semi")
    upto = Window.partitionBy("_k", "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    found = (near.withColumn("_last", F.sum("_c").over(upto)).join(targets, ["_k", "_range"])
             .filter((F.col("_last") > F.col("_in")) & (F.col("_last") - F.col("_c") <= F.col("_in"))))
    share = F.max("_at") - F.floor(F.max("_at"))
    low, high = F.min_by("_v", "_rank"), F.max_by("_v", "_rank")
    each = found.groupBy("_k", "_i").agg(F.max("_n").alias("_n"), F.when(share == 0, low).otherwise(low + (high - low) * share).alias("_x"))
    out = each.groupBy("_k").agg(F.max("_n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))),
                                                                   lambda s: s["_x"]).alias("quantiles"))
    return cut_lineage(out.select(*[F.col(f"_k.{k}").alias(k) for k in by], "n", "quantiles"), "quantiles")


def exact_quantiles(df: DataFrame, value: str | Column, qs: Sequence[float], ranges: int | None = None) -> DataFrame:
    """One row with `quantiles` of a whole column, nulls ignored; an empty array where no value is
    left, so read it with `get`."""
    found = grouped_quantiles(df, (), value, qs, ranges)
    return found.agg(F.coalesce(F.max("quantiles"), F.array().cast("array<double>")).alias("quantiles"))


def quantile_column(df: DataFrame, value: str | Column, q: float) -> Column:
    """A single exact quantile as a literal; null without values."""
    quantiles = exact_quantiles(df, value, [q]).first()["quantiles"]
    return F.lit(quantiles[0] if quantiles else None).cast("double")
