"""Export of product records with the URLs they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfloom.functions.names import stamp_text

FIELDS = (
    "id", "source_url", "product_url", "product_code", "name", "slug", "price", "currency",
    "reviews", "image", "parsed_at",
)


def export_records(products: DataFrame) -> DataFrame:
    """One flat record per product; takes ``product_with_source`` rows."""
    return products.select(*FIELDS).withColumn("parsed_at", stamp_text(F.col("parsed_at")))


def export_json(products: DataFrame, path: str) -> None:
    """JSON lines, missing values kept as null."""
    export_records(products).write.mode("overwrite").json(path, ignoreNullFields=False)


def export_csv(products: DataFrame, path: str) -> None:
    """CSV with a header; an empty field is a missing value, a quoted one an empty text."""
    export_records(products).write.mode("overwrite").csv(path, header=True, escape='"')
