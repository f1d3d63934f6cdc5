"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where a local session names none."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="seqloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read from there: what it takes is done once, and a lost executor costs its tasks only."""
    path = f"{shared_dir(df.sparkSession)}/seqloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
