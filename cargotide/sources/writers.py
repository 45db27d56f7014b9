"""Sinks. Overwrites are idempotent, so a retried job is safe."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..columns import BRAND, CATEGORY, DATE
from ..operators.history import append_history, upsert
from ..operators.panel import with_business_year, with_labels


def _write(df: DataFrame, path: str, fmt: str, partition_by: Sequence[str], mode: str) -> None:
    # an overwrite replaces the folders it has rows for and leaves the others
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_panel(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", date: str = DATE) -> None:
    """S8. Labels added, one folder per business year. The rebalance hint gathers the rows of
    a year instead of leaving one tiny file per task and year, while adaptive execution splits
    a year that holds most of the rows."""
    rows = with_business_year(with_labels(df, date), date).hint("rebalance", "year")
    _write(rows, path, fmt, ["year"], mode)


def write_forecasts(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                    date: str = "date") -> None:
    """S9. One folder per category, brand and year; reading the parent gives the combined set.
    A folder holds at most one row per day, so hashing the folders over the cluster leaves one
    file in each and no hot task; the number of tasks is that of the cluster's slots, as the
    cost is in opening files."""
    folders = [CATEGORY, BRAND, "year"]
    tasks = df.sparkSession.sparkContext.defaultParallelism
    _write(df.withColumn("year", F.year(date)).repartition(tasks, *folders), path, fmt, folders, mode)


def combined_forecasts(spark: SparkSession, path: str, fmt: str = "parquet", date: str = "date") -> DataFrame:
    """S9. The combined file, in date and brand order."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path).orderBy(date, BRAND)


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str],
                 required: str | None = None, fmt: str = "parquet", into: str | None = None) -> str:
    """S10. Merge a table with new rows into a new version folder and return its path, from which
    the next merge starts; no version is ever overwritten."""
    existing = spark.read.format(fmt).load(path)
    target = into or f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    upsert(existing, new, keys, required).write.mode("errorifexists").format(fmt).save(target)
    return target


def upsert_partitions(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], partition_by: Sequence[str],
                      required: str | None = None, fmt: str = "parquet") -> None:
    """S10. Merge into a table that is stored by `partition_by`, part of the keys. Only the folders that new rows fall into
    are read, merged and replaced (when all tasks have finished); the others keep their files, and readers keep the
    path. So the work follows the new rows, not the table. Existing rows without the required key leave when
    their folder is merged. New rows may lack columns of the table and add none; a null in `partition_by` fails."""
    if not set(partition_by) <= set(keys):
        raise ValueError(f"{partition_by} are not all keys")
    existing = spark.read.format(fmt).load(path)
    added = sorted(set(new.columns) - set(existing.columns))
    if added:
        raise ValueError(f"the table has no column {', '.join(added)}")
    known = new.withColumns({c: F.coalesce(c, F.raise_error(F.lit(f"null in {c}"))).cast(existing.schema[c].dataType) for c in partition_by})
    touched = existing.join(known.select(*partition_by).distinct(), list(partition_by), "left_semi")
    merged = upsert(touched, known, keys, required).select(*[F.col(f"`{c}`").cast(existing.schema[c].dataType).alias(c) for c in existing.columns])
    _write(merged.repartition(*partition_by), path, fmt, partition_by, "overwrite")


def append_rows(spark: SparkSession, path: str, new: DataFrame, fmt: str = "parquet") -> None:
    """S11. Append history rows in the existing column layout."""
    existing = spark.read.format(fmt).load(path)
    aligned = append_history(existing.limit(0), new).select(*existing.columns)
    aligned.write.mode("append").format(fmt).save(path)
