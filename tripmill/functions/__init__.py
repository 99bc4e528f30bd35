"""Scalar expressions shared by the plans. All are built-in column functions; there is no UDF."""

from tripmill.functions.calendar import day_label, is_weekend, weekday_name
from tripmill.functions.keys import surrogate_key
from tripmill.functions.labels import payment_label
from tripmill.functions.measures import duration_minutes, safe_ratio, zero_filled

__all__ = [
    "day_label",
    "duration_minutes",
    "is_weekend",
    "payment_label",
    "safe_ratio",
    "surrogate_key",
    "weekday_name",
    "zero_filled",
]
