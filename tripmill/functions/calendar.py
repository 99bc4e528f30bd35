"""Calendar expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill.functions.labels import lookup
from tripmill.schema import DAY_NAMES, UNKNOWN_DAY

WEEKEND_DAYS = (1, 7)  # fixed values: Sunday is 1


def weekday_name(day: Column) -> Column:
    """Full English weekday name of a date."""
    return F.date_format(day, "EEEE")


def is_weekend(day: Column) -> Column:
    """True on Saturdays and Sundays; an unknown date is not a weekend."""
    return F.coalesce(F.dayofweek(day).isin(*WEEKEND_DAYS), F.lit(False))


def day_label(number: Column) -> Column:
    """Weekday name of a weekday number, ``Unknown`` for anything outside 1 to 7."""
    return F.coalesce(lookup(DAY_NAMES, number), F.lit(UNKNOWN_DAY))
