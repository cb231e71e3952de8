"""Frames written once to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. A local session without that setting gets a temporary folder; a cluster gets an error."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.conf.set("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='admill-')}")
    return spark.conf.get("spark.checkpoint.dir").rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written below the shared folder, by application, and read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/admill-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
