"""Session defaults and the shared scratch area."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "cargotide", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution (runtime broadcast choice, skew-join splitting,
    partition coalescing) and a fixed time zone."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    `spark.checkpoint.dir` of the session wins, then a folder set on the context. Where both
    are unset it is a folder beside the warehouse, which executors share; a warehouse on a
    local disk is refused unless the master is local too.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        local = warehouse.startswith(("file:", "/"))
        if local and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = f"{warehouse.rstrip('/')}/_scratch"
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a written table inside the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "table") -> DataFrame:
    """Write to the shared folder and read back: survives the loss of executors, computes the
    rows once, keeps plans short and leaves column pruning to the reader."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
