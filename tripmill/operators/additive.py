"""Additive measures: every report of the warehouse over one shape of input.

``trip_measures`` gives each trip a count of 1 and, per measure, its value and whether it has one.
All of these add up, so ``rollup`` to a finer grain and a later ``groupBy`` give the same totals
and averages as grouping the trips themselves. A standalone report groups trips directly; the
pipeline rolls the fact up twice and feeds every other table from the two small rollups.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("total_amount", "tip_amount", "fare_amount", "trip_distance", "trip_duration_min")

# Grains that together serve all dimensions and aggregates.
ROUTE_GRAIN = ("pickup_date", "pulocation_id", "dolocation_id")
CLOCK_GRAIN = ("pickup_date", "pickup_hour", "day_of_week", "vendor_id", "payment_type")

TRIPS_COUNT = "trips"


def _sum_name(measure: str) -> str:
    return f"{measure}_sum"


def _known_name(measure: str) -> str:
    return f"{measure}_known"


def trip_measures(trips: DataFrame) -> DataFrame:
    """Add the additive form of the measures to single trips. Unused columns are pruned."""
    added = {TRIPS_COUNT: F.lit(1).cast("bigint")}
    for m in MEASURES:
        added[_sum_name(m)] = F.col(m)
        added[_known_name(m)] = F.col(m).isNotNull().cast("bigint")
    return trips.withColumns(added)


def rollup(measured: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Totals per ``grain``; again additive. Combined map-side, so hot keys shuffle as one row."""
    totals = [F.sum(TRIPS_COUNT).alias(TRIPS_COUNT)]
    for m in MEASURES:
        totals += [F.sum(name).alias(name) for name in (_sum_name(m), _known_name(m))]
    return measured.groupBy(*grain).agg(*totals)


def trip_count() -> Column:
    return F.sum(TRIPS_COUNT)


def total(measure: str) -> Column:
    return F.sum(_sum_name(measure))


def average(measure: str) -> Column:
    """Mean over the trips that have a value."""
    return F.try_divide(total(measure), F.sum(_known_name(measure)))
