"""Price and currency columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfloom.functions.text import WHITESPACE_CLASS

# An amount after a currency mark.
_AMOUNT = WHITESPACE_CLASS + r"*([\p{Nd}.,]+)"
USD_PATTERN = r"\$" + _AMOUNT
ARS_PATTERN = "ARS" + _AMOUNT


def price_thousands(text: Column) -> Column:
    """Whole price whose dots separate thousands; NULL when it does not read as a number."""
    return F.replace(text, F.lit("."), F.lit("")).try_cast("bigint")


def price_unreadable(text: Column, price: Column) -> Column:
    """There was a price text, but no price came out of it."""
    return text.isNotNull() & price.isNull()


def price_trailing_dot(text: Column) -> Column:
    """Drop one dot at the end."""
    return F.when(text.endswith("."), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)


def has_amount(text: Column, pattern: str = USD_PATTERN) -> Column:
    return text.rlike(pattern)


def _first_amount(texts: Column, pattern: str, currency: str) -> Column:
    hit = F.get(F.filter(texts, lambda t: t.rlike(pattern)), F.lit(0))
    return F.struct(
        F.when(hit.isNotNull(), F.lit(currency)).alias("currency"),
        F.regexp_extract(hit, pattern, 1).alias("price"),
    )


def price_usd(texts: Column) -> Column:
    """(currency, price) of the first text with a dollar amount; both NULL without one."""
    return _first_amount(texts, USD_PATTERN, "$")


def price_ars(texts: Column) -> Column:
    """The same for amounts marked ARS."""
    return _first_amount(texts, ARS_PATTERN, "ARS")


def price_fallback(currency: Column, price: Column, found: Column) -> Column:
    """Take both values from ``found`` when there is no price, a NULL currency included."""
    missing = price.isNull()
    return F.struct(
        F.when(missing, found["currency"]).otherwise(currency).alias("currency"),
        F.when(missing, found["price"]).otherwise(price).alias("price"),
    )


def amount_as_double(text: Column) -> Column:
    """Amount with comma thousands as a number."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")
