"""Numeric and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_int(c: Column) -> Column:
    """Number text or number to BIGINT, truncated; anything else NULL."""
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number).try_cast("bigint")


def safe_float(c: Column) -> Column:
    """Number text or number rounded half-even to two places; else NULL."""
    number = c.try_cast("double")
    return F.bround(F.when(~F.isnan(number), number), 2)


def percent(part: Column, total: Column) -> Column:
    """Whole percent, half-even, 0 for an empty total."""
    return F.coalesce(F.bround(F.try_divide(part * 100, total), 0), F.lit(0.0)).cast("int")


def thousands(c: Column, mark: str) -> Column:
    return F.replace(F.format_number(c, 0), F.lit(","), F.lit(mark))


def format_price(c: Column) -> Column:
    return F.coalesce(F.concat(thousands(safe_int(c), "."), F.lit("đ")), F.lit("n/a"))


def parse_timestamp(c: Column) -> Column:
    """Epoch seconds or ISO text to a UTC timestamp, else NULL."""
    text = c.cast("string")
    digits = text.rlike("^[0-9]+$")
    return F.when(digits, F.timestamp_seconds(F.when(digits, text).try_cast("bigint"))).otherwise(
        F.try_to_timestamp(text)
    )


def timestamp_text(c: Column) -> Column:
    """Epoch seconds as UTC text, other text unchanged, NULL to ''."""
    text = c.cast("string")
    digits = text.rlike("^[0-9]+$")
    stamp = F.date_format(F.timestamp_seconds(F.when(digits, text).try_cast("bigint")), "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(F.when(digits, stamp).otherwise(text), F.lit(""))


def adaptive_k(n: Column) -> Column:
    """How many reviews represent a product with ``n`` reviews."""
    return (
        F.when(n <= 3, n).when(n <= 10, F.lit(4)).when(n <= 20, F.lit(5))
        .when(n <= 50, F.lit(6)).when(n <= 100, F.lit(8))
        .otherwise(F.least(F.greatest(F.bround(n * F.lit(0.08), 0), F.lit(8)), F.lit(20)))
        .cast("int")
    )


def positive_limit(k: Column) -> Column:
    return F.greatest(F.lit(1), k - F.floor(k / 3)).cast("int")


def negative_limit(k: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(k / 3)).cast("int")
