"""Tables written once to the folder that driver and executors share, so that what follows reads them instead of making them again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where none is set, as in tests, below the system's temporary folder."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or "file:///tmp/checkpoints/tessera"
    return f"{base.rstrip('/')}/core-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a table of its own: its lineage ends there and survives lost executors."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
