"""Statistics used for training and reporting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (BooleanType, DataType, DecimalType, DoubleType, FloatType, TimestampNTZType,
                               TimestampType)

from ..columns import CATEGORY, CBM, DATE, SERIES_KEYS
from ..functions.cleaning import as_column
from .quantiles import quantile_column
from .ranking import with_positions

Keys = Sequence[str]


def _to_rows(wide: DataFrame, names: Sequence[str], fields: Sequence[str], label: str) -> DataFrame:
    """Unpivot one wide aggregate row into one row per name."""
    items = [F.struct(F.lit(n).alias(label), *[F.col(f"`{n}|{f}`").alias(f) for f in fields]) for n in names]
    return wide.select(F.explode(F.array(*items)).alias("_i")).select("_i.*")


def feature_target_correlations(df: DataFrame, features: Sequence[str], target: str = CBM) -> DataFrame:
    """A9. Pearson r of each feature with the target in one pass; 0 for a constant feature."""
    t = as_column(target).cast("double")
    aggs = []
    for f in features:
        c = as_column(f).cast("double")
        constant = F.min(c).eqNullSafe(F.max(c))
        x, y = F.when(t.isNotNull(), c), F.when(c.isNotNull(), t)  # moments over the same pairs
        pearson = F.try_divide(F.covar_pop(c, t), F.stddev_pop(x) * F.stddev_pop(y))
        aggs.append(F.when(constant, F.lit(0.0)).otherwise(pearson).alias(f"{f}|r"))
    return _to_rows(df.agg(*aggs), features, ["r"], "feature")


def feature_ranges(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """A10."""
    aggs = []
    for f in features:
        c = as_column(f).cast("double")
        aggs += [F.min(c).alias(f"{f}|min"), F.max(c).alias(f"{f}|max")]
    return _to_rows(df.agg(*aggs), features, ["min", "max"], "feature")


def fit_scaler(df: DataFrame, keys: Keys = SERIES_KEYS, value: str = CBM) -> DataFrame:
    """A11. Mean and population deviation per key; a deviation of 0 becomes 1."""
    std = F.stddev_pop(as_column(value))
    return df.groupBy(*keys).agg(F.avg(as_column(value)).alias("mean"),
                                 F.when(std == 0, F.lit(1.0)).otherwise(std).alias("std"))


def encode_categories(df: DataFrame, category: str = CATEGORY, out: str = "CATEGORY_ID") -> DataFrame:
    """A12. The dictionary `category -> id` in sorted order; join it where ids are needed. Ids are positions
    found by range partitions and prefix counts, so no task orders all names."""
    names = df.select(category).filter(F.col(category).isNotNull()).distinct()
    return with_positions(names, [F.col(category)], out).withColumn(out, F.col(out).cast("int"))


def _plain_text(c: str, kind: DataType, digits: int) -> Column:
    """Text of a value that does not depend on the engine: numbers as whole units of the last digit,
    times as microseconds."""
    v = as_column(c)
    if isinstance(kind, (FloatType, DoubleType, DecimalType)):
        v = F.floor(v.cast("double") * F.lit(10.0 ** digits) + F.lit(0.5)).try_cast("bigint")
    elif isinstance(kind, TimestampNTZType):
        v = F.unix_micros(v.cast("timestamp"))
    elif isinstance(kind, TimestampType):
        v = F.unix_micros(v)
    elif isinstance(kind, BooleanType):
        v = v.cast("int")
    text = v.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def dataset_fingerprint(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """A13. Order-free hash of the rows: equal data in any order and partitioning gives the same
    value, a repeated or changed row another one. Each row's values are written one after the other with their
    lengths (a null is `-`), doubles to `digits` decimals, and hashed by MD5; the first 60 bits are summed modulo 2^64.
    `fingerprint` is that number as text; without rows it is 0."""
    kinds = {f.name: f.dataType for f in df.schema}
    row = F.concat(*[_plain_text(c, kinds[c], digits) for c in columns])
    bits = F.conv(F.substring(F.md5(row.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    total = F.coalesce(F.sum(bits), F.lit(0).cast("decimal(38,0)"))
    return df.agg(F.count("*").alias("rows"), F.pmod(total, F.lit(str(2 ** 64)).cast("decimal(38,0)")).cast("string").alias("fingerprint"))


def spike_flags(df: DataFrame, actual: str = "actual", q: float = 0.8, keys: Keys | None = None) -> DataFrame:
    """E16. `is_spike` against the quantile of the whole frame (exact, no single-task sort) or
    of each key (series bounded by the calendar)."""
    if keys is None:
        threshold = quantile_column(df, actual, q)
    else:
        threshold = F.percentile(as_column(actual), F.lit(q)).over(Window.partitionBy(*keys))
    return df.withColumn("is_spike", as_column(actual) > threshold)


# The two reason labels.
HOLIDAY_EFFECT = "holiday_effect"
EOM_RUSH = "EOM_rush"


def spike_reasons(df: DataFrame, keys: Keys = (), date: str = DATE, out_date: str = "date") -> DataFrame:
    """E16. Reason per day from its flags: month end overrides a holiday or the days near one.
    Several rows per day are reduced to the least reason, which does not depend on row order."""
    reason = (F.when(F.col("is_EOM") == 1, EOM_RUSH)
              .when((F.col("holiday_indicator") == 1) | (F.col("is_pre_holiday_surge") == 1), HOLIDAY_EFFECT))
    return df.groupBy(*keys, F.col(date).alias(out_date)).agg(F.min(reason).alias("spike_reason"))


def spike_labels(df: DataFrame, keys: Keys = ("date", "split")) -> DataFrame:
    """A14."""
    return df.groupBy(*keys).agg(F.bool_or("is_spike").alias("is_spike"),
                                 F.min("spike_reason").alias("spike_reason"))
