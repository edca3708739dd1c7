"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    return f"{spark.conf.get('spark.checkpoint.dir', None) or spark.conf.get('spark.sql.warehouse.dir')}/stored-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` as written there and read again: made once, and still there when an executor is lost."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
