"""Sliding windows and splits."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..columns import CBM, DATE, SERIES_KEYS
from ..functions.cleaning import as_column
from .ranking import with_positions
from .series import ordered

Keys = Sequence[str]


def sliding_windows(df: DataFrame, inputs: int, horizon: int, features: Sequence[str], target: str = CBM,
                    keys: Keys = SERIES_KEYS, date: str = DATE, drop_last: bool = False) -> DataFrame:
    """W8 / W9. One row per window: `x` (inputs x features), `y`, `y_dates`, the date of the
    first label and a running number per key. A key with n rows gives n - T - H + 1 windows,
    one fewer with `drop_last` (the older form; pass `keys=()` columns of one value for one series).
    """
    w = ordered(keys, date)
    past = w.rowsBetween(-(inputs - 1), 0)
    ahead = w.rowsBetween(1, horizon)
    row, size = F.row_number().over(w), F.count(F.lit(1)).over(Window.partitionBy(*keys))
    spare = horizon + (1 if drop_last else 0)
    rows = df.select(
        *keys, row.alias("_row"), size.alias("_size"),
        F.collect_list(F.array(*[as_column(c).cast("double") for c in features])).over(past).alias("x"),
        F.collect_list(F.struct(F.col(date).alias("date"), as_column(target).cast("double").alias("value"))
                       ).over(ahead).alias("_labels"))
    return (rows.filter((F.col("_row") >= inputs) & (F.col("_row") <= F.col("_size") - spare))
            .select(*keys, (F.col("_row") - inputs).alias("window_id"),
                    F.element_at("_labels", 1)["date"].alias("label_date"), "x",
                    F.col("_labels.value").alias("y"), F.col("_labels.date").alias("y_dates")))


def explode_windows(windows: DataFrame, predicted: str, keys: Keys = SERIES_KEYS) -> DataFrame:
    """W10. Window x step rows; the date is the label row's own date. `predicted` is an array
    column as long as `y`."""
    steps = F.posexplode(F.arrays_zip(F.col("y_dates"), F.col("y"), as_column(predicted)))
    rows = windows.select(*keys, "window_id", steps.alias("_pos", "_s"))
    out = rows.select(*keys, "window_id", (F.col("_pos") + 1).alias("horizon_step"),
                      F.col("_s.y_dates").alias("date"), F.dayofmonth("_s.y_dates").alias("day_of_month"),
                      F.col("_s.y").alias("actual"), F.col(f"_s.{predicted}").alias("predicted"))
    return out.withColumn("error", F.col("predicted") - F.col("actual")).withColumn(
        "abs_error", F.abs("error"))


def check_ratios(*ratios: float) -> None:
    if abs(sum(ratios) - 1.0) > 1e-6:
        raise ValueError(f"split ratios must sum to 1, got {ratios}")


def temporal_split(df: DataFrame, train: float = 0.7, val: float = 0.1, test: float = 0.2,
                   keys: Keys = SERIES_KEYS, date: str = DATE) -> DataFrame:
    """W11. First part train, then validation, rest test, per key."""
    check_ratios(train, val, test)
    row, size = F.row_number().over(ordered(keys, date)), F.count(F.lit(1)).over(Window.partitionBy(*keys))
    train_end = F.floor(F.lit(train) * F.col("_size"))
    val_end = train_end + F.floor(F.lit(val) * F.col("_size"))
    return (df.withColumns({"_row": row, "_size": size})
            .withColumn("split", F.when(F.col("_row") <= train_end, "train")
                        .when(F.col("_row") <= val_end, "val").otherwise("test"))
            .drop("_row", "_size"))


def random_split(df: DataFrame, train: float = 0.7, val: float = 0.1, test: float = 0.2, seed: int = 42,
                 keys: Keys = SERIES_KEYS, date: str = DATE) -> DataFrame:
    """W12. Exact sizes: the rows in the order of an MD5 of seed, keys and day, the first floor(train * n) of them
    train, the next floor(val * n) validation. The order is found by range partitions and prefix counts; the
    same row always falls on the same side, also when a lost task is run again. Rows equal in keys and day are
    ordered by their other columns."""
    check_ratios(train, val, test)
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys] + [F.coalesce(F.col(date).cast("string"), F.lit(""))]
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))
    kept = df.columns
    rest = [F.col(f"`{c}`") for c, t in df.dtypes if c not in (*keys, date) and not t.startswith(("map", "variant"))]
    rows = with_positions(df.withColumn("_mark", mark), [F.col("_mark"), *[F.col(k) for k in keys], F.col(date), *rest], "_at")
    n = rows.count()
    first, second = math.floor(train * n), math.floor(train * n) + math.floor(val * n)
    split = F.when(F.col("_at") < first, "train").when(F.col("_at") < second, "val").otherwise("test")
    return rows.withColumn("split", split).select(*[F.col(f"`{c}`") for c in kept], "split")
