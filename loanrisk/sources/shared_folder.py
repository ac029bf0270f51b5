"""The folder that driver and executors share, for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of `spark.checkpoint.dir`.

    Where the setting is absent a temporary folder serves, in local mode only: on a cluster the
    executors could not see it, so that raises instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so that what reads it several times does
    not derive it several times."""
    path = new_shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
