"""Session settings the jobs are written for."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Pages are large: bound the bytes, not only the rows, that one Arrow batch holds.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def session(name: str = "shelfloom", **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; pass more as keywords with dots written as ``__``."""
    builder = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    The parsing tasks import it. A job submitted with ``--py-files`` does not need this.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        folder = tempfile.mkdtemp(prefix="shelfloom-code-")
        archive = shutil.make_archive(
            f"{folder}/{_PACKAGE.name}", "zip", _PACKAGE.parent, _PACKAGE.name
        )
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)
