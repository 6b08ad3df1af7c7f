"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only for a purely local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith(("local[", "local*")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    root = f"file://{tempfile.mkdtemp(prefix='spark-scratch-')}"
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written there as Parquet and read back: lineage ends, and a lost executor costs a re-read."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
