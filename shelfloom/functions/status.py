"""Status columns of the two work queues."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PENDING = "pending"
IN_PROGRESS = "in_progress"
FETCHING = "fetching"
FETCHED = "fetched"
FAILED = "failed"
UNFETCHABLE = "failed_unfetchable"
PARSING = "parsing"
PARSED = "parsed_succeeded"
PARSE_FAILED = "parsing_failed"
STATUSES = (PENDING, IN_PROGRESS, FETCHING, FETCHED, FAILED, UNFETCHABLE, PARSING, PARSED, PARSE_FAILED)


def already_queued(status: Column) -> Column:
    """Pending or fetched; a URL that is unknown or in another state is not queued."""
    return F.coalesce(status.isin(PENDING, FETCHED), F.lit(False))


def reset_stuck(status: Column, stuck: str, to: str | None) -> Column:
    """Put rows left in a working state back to ``to``."""
    return F.when(status == stuck, F.lit(to)).otherwise(status)


def fetched_unparsed(fetch_status: Column, parse_status: Column) -> Column:
    return (fetch_status == FETCHED) & parse_status.isNull()


def unfetchable(product_url: Column, fetch_status: Column) -> Column:
    """Status after looking at the URL: a product without one can never be fetched."""
    return F.when(
        (fetch_status == PENDING) & product_url.isNull(), F.lit(UNFETCHABLE)
    ).otherwise(fetch_status)


def fetch_result(captured: Column) -> Column:
    return F.when(captured, F.lit(FETCHED)).otherwise(F.lit(FAILED))


def parse_result(has_html: Column, readable: Column) -> Column:
    return F.when(has_html & readable, F.lit(PARSED)).otherwise(F.lit(PARSE_FAILED))
