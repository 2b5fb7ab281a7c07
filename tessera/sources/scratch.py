"""Intermediate tables in the folder that the driver and all executors share."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where that is unset (as in tests) a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not found and not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="tessera-"))
    return (found or _own[0]).rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read back: its lineage ends there, and lost executors lose nothing."""
    path = f"{folder(df.sparkSession)}/tessera-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
