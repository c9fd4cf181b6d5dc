"""Staged tables: a costly frame is written once and read back with its lineage cut."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_dir(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share; the session has to name one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return found


def stage_path(spark: SparkSession) -> str:
    """A fresh path in the staging folder."""
    return f"{staging_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write and read back as parquet. Unlike cached blocks the table survives the loss of
    executors, and later scans prune its columns and know its size."""
    path = stage_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
