"""Numeric expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_minutes(start: Column, end: Column) -> Column:
    """Minutes between two timestamps, from their whole epoch seconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is null, not an error, where the denominator is zero."""
    return F.try_divide(numerator, F.nullif(denominator, F.lit(0)))


def zero_filled(raw: Column, number: Column) -> Column:
    """``number`` where the file has a value, 0 where it has none.

    ``raw`` is the value before conversion: text that is no number stays null instead of turning
    into a zero nobody reported.
    """
    return F.when(raw.isNull(), F.lit(0.0)).otherwise(number)
