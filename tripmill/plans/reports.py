"""Dashboard reports over the views."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOURS = range(24)
TOP_ZONES = 20  # fixed value: rows of the zone table


def between_dates(df: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col("pickup_date") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("pickup_date") <= F.lit(end))
    return df


def scorecards(kpi_daily: DataFrame) -> DataFrame:
    """Totals, plain averages of the daily averages, and the same averages weighted by trips."""

    def weighted(column: str):
        return F.try_divide(F.sum(F.col(column) * F.col("total_trips")), F.sum("total_trips"))

    return kpi_daily.agg(
        F.sum("total_trips").alias("total_trips"),
        F.sum("total_revenue").alias("total_revenue"),
        F.avg("avg_ticket").alias("avg_ticket"),
        F.avg("avg_trip_duration_min").alias("avg_trip_duration_min"),
        weighted("avg_ticket").alias("weighted_avg_ticket"),
        weighted("avg_trip_duration_min").alias("weighted_avg_trip_duration_min"),
    )


def monthly(kpi_daily: DataFrame) -> DataFrame:
    """Trips and revenue per month, in order."""
    return (
        kpi_daily.groupBy(F.trunc("pickup_date", "month").alias("pickup_month"))
        .agg(F.sum("total_trips").alias("total_trips"), F.sum("total_revenue").alias("total_revenue"))
        .orderBy("pickup_month")
    )


def filtered_traffic(hourly_traffic: DataFrame, day_names: Sequence[str] | None = None) -> DataFrame:
    """Hourly traffic of chosen weekdays, or of all."""
    if day_names is None:
        return hourly_traffic
    return hourly_traffic.filter(F.col("day_name").isin(*day_names))


def heatmap(hourly_traffic: DataFrame) -> DataFrame:
    """Trips by weekday and hour: one row per day name, columns ``hour_0`` to ``hour_23``.

    The hours are given, so the pivot needs no extra pass to find them.
    """
    table = (
        hourly_traffic.groupBy("day_name")
        .pivot("pickup_hour", list(HOURS))
        .agg(F.sum("total_trips"))
    )
    return table.select("day_name", *[F.col(f"`{h}`").alias(f"hour_{h}") for h in HOURS])


def by_hour(hourly_traffic: DataFrame) -> DataFrame:
    """Revenue and plain average of the weekday durations per hour."""
    return (
        hourly_traffic.groupBy("pickup_hour")
        .agg(
            F.sum("total_revenue").alias("total_revenue"),
            F.avg("avg_trip_duration_min").alias("avg_trip_duration_min"),
        )
        .orderBy("pickup_hour")
    )


def payments(payment_performance: DataFrame) -> DataFrame:
    """Trips, revenue and tips by payment name."""
    return payment_performance.select(
        "payment_type_name", "total_trips", "total_revenue", "avg_tip_amount", "tip_to_fare_ratio"
    )


def top_zones(zone_performance: DataFrame, n: int = TOP_ZONES) -> DataFrame:
    """The ``n`` zones with most revenue; equal revenues in zone order."""
    return (
        zone_performance.select(
            "pulocation_id", "total_trips", "total_revenue", "avg_total_amount", "avg_trip_distance"
        )
        .orderBy(F.desc("total_revenue"), "pulocation_id")
        .limit(n)
    )


def filtered_routes(
    route_performance: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    pickup_zones: Sequence[int] | None = None,
    dropoff_zones: Sequence[int] | None = None,
) -> DataFrame:
    """Routes by revenue in cents, narrowed by any of the dashboard's controls; equal ones by key."""
    routes = between_dates(route_performance, start, end)
    if pickup_zones is not None:
        routes = routes.filter(F.col("pulocation_id").isin(*pickup_zones))
    if dropoff_zones is not None:
        routes = routes.filter(F.col("dolocation_id").isin(*dropoff_zones))
    return routes.select(
        "pickup_date", "pulocation_id", "dolocation_id", "total_trips", "total_revenue"
    ).orderBy(F.desc(F.round("total_revenue", 2)), "pickup_date", "pulocation_id", "dolocation_id")
