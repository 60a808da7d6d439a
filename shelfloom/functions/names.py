"""File names, stamps and column affinity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAGE_FILE_PATTERN = r"^page_([0-9]+)\.html$"
_NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def listing_filename(page_id: Column) -> Column:
    return F.format_string("page_%d.html", page_id)


def product_filename(slug: Column) -> Column:
    return F.concat(F.coalesce(slug, F.lit("None")), F.lit(".html"))


def is_page_file(name: Column) -> Column:
    return name.rlike(PAGE_FILE_PATTERN)


def page_id_from_filename(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, PAGE_FILE_PATTERN, 1), F.lit("")).try_cast("bigint")


def stamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd, HH:mm 'hs.'")


def real_affinity(text: Column) -> Column:
    """Number stored in a REAL column for this text; NULL where the text would stay text."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(_NUMBER_PATTERN), trimmed.try_cast("double"))


def integer_affinity(text: Column) -> Column:
    """Whole number stored in an INTEGER column for this text, else NULL."""
    trimmed = F.trim(text)
    number = real_affinity(text)
    whole = (number == F.floor(number)) & (number >= -(2.0**63)) & (number < 2.0**63)
    return F.when(trimmed.rlike(r"^[+-]?[0-9]+$"), trimmed.try_cast("bigint")).otherwise(
        F.when(whole, number.try_cast("bigint"))
    )
