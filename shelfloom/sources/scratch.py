"""Working tables in the folder all executors share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``.

    Without that setting a local session uses a temporary folder; a cluster must set it,
    because a folder of one machine is lost with that machine.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="shelfloom-")
    return f"{base.rstrip('/')}/shelfloom/{name}-{uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once and read them back: later steps neither repeat nor change them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
