"""Run configuration files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom import schemas

# Fixed value: table root of a request that names none.
DEFAULT_DATABASE = "mini.sqlite"


def read_requests(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(site, database_path, pages_to_crawl) from JSON: one document per file, or lines."""
    raw = spark.read.schema(schemas.REQUESTS).json(path, multiLine=multi_line)
    return raw.withColumn("database_path", F.coalesce("database_path", F.lit(DEFAULT_DATABASE)))
