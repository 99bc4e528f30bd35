"""Staging, dimensions, trip fact and aggregates.

Dimensions and aggregates take a frame in additive form (``operators.additive``): either single
trips or a rollup that holds their keys.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions import is_weekend, safe_ratio, surrogate_key, weekday_name
from tripmill.operators.additive import ROUTE_GRAIN, TRIPS_COUNT, average, total, trip_count
from tripmill.operators.numbering import number_rows
from tripmill.schema import TRIP_COLUMNS, TRIP_KEY, TRIP_ORDER, staged


def stg_trips(trips: DataFrame) -> DataFrame:
    """Trips in warehouse types."""
    return trips.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in staged().fields])


# --- dimensions ------------------------------------------------------------------------------


def dim_date(measured: DataFrame) -> DataFrame:
    """One row per pickup date."""
    day = F.col("date_key")
    return (
        measured.select(F.col("pickup_date").alias("date_key"))
        .distinct()
        .select(
            day,
            F.year(day).cast("bigint").alias("year"),
            F.month(day).cast("bigint").alias("month"),
            F.dayofmonth(day).cast("bigint").alias("day"),
            F.dayofweek(day).cast("bigint").alias("day_of_week"),
            weekday_name(day).alias("day_name"),
            is_weekend(day).alias("is_weekend"),
        )
    )


def zone_touches(measured: DataFrame) -> DataFrame:
    """A row per trip end with its zone and role. One scan yields both ends."""
    ends = "stack(2, pulocation_id, 'pickup', dolocation_id, 'dropoff') as (location_id, zone_role)"
    return measured.selectExpr(ends, "trips").filter("location_id is not null")


def dim_zone(measured: DataFrame) -> DataFrame:
    """Touches per zone, in all and by role."""

    def trips_as(role: str):
        return F.sum(F.when(F.col("zone_role") == role, F.col("trips")).otherwise(0))

    return (
        zone_touches(measured)
        .groupBy("location_id")
        .agg(
            trip_count().alias("total_trips_touching_zone"),
            trips_as("pickup").alias("pickup_trips"),
            trips_as("dropoff").alias("dropoff_trips"),
        )
    )


def dim_vendor(measured: DataFrame) -> DataFrame:
    """Activity span and totals per vendor."""
    return (
        measured.filter(F.col("vendor_id").isNotNull())
        .groupBy("vendor_id")
        .agg(
            F.min("pickup_date").alias("first_seen_date"),
            F.max("pickup_date").alias("last_seen_date"),
            trip_count().alias("total_trips"),
            total("total_amount").alias("total_revenue"),
            average("total_amount").alias("avg_trip_revenue"),
            average("trip_duration_min").alias("avg_trip_duration_min"),
        )
    )


def dim_payment_type(measured: DataFrame) -> DataFrame:
    """Totals per known payment type."""
    return (
        measured.filter(F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(
            trip_count().alias("total_trips"),
            total("total_amount").alias("total_revenue"),
            average("total_amount").alias("avg_total_amount"),
            average("tip_amount").alias("avg_tip_amount"),
            average("trip_duration_min").alias("avg_trip_duration_min"),
        )
    )


# --- fact ------------------------------------------------------------------------------------


# The key with time first: ranges of numbered trips are then spans of time, so a day lies in few of them.
ALONG_TIME = ("pickup_datetime", *(name for name in TRIP_KEY if name != "pickup_datetime"))


def trip_seq(stg: DataFrame) -> DataFrame:
    """Number the trips that share a key, along time; none is dropped."""
    return number_rows(stg, ALONG_TIME, TRIP_ORDER, "trip_seq")


def fct_trip(stg: DataFrame) -> DataFrame:
    """One row per trip with its surrogate key."""
    numbered = trip_seq(stg)
    key = surrogate_key(numbered, (*TRIP_KEY, "trip_seq"))
    return numbered.select(key.alias("event_id"), *TRIP_COLUMNS)


# --- aggregates ------------------------------------------------------------------------------


def agg_payment_type(measured: DataFrame) -> DataFrame:
    """Volume, revenue and tip rate per payment type; unknown types form a group."""
    return measured.groupBy("payment_type").agg(
        trip_count().alias("total_trips"),
        total("total_amount").alias("total_revenue"),
        average("total_amount").alias("avg_total_amount"),
        average("tip_amount").alias("avg_tip_amount"),
        safe_ratio(total("tip_amount"), total("fare_amount")).alias("tip_to_fare_ratio"),
    )


def agg_route_daily(measured: DataFrame) -> DataFrame:
    """Volume, revenue and duration per day and zone pair."""
    return measured.groupBy(*ROUTE_GRAIN).agg(
        trip_count().alias("total_trips"),
        total("total_amount").alias("total_revenue"),
        average("total_amount").alias("avg_total_amount"),
        average("trip_duration_min").alias("avg_trip_duration_min"),
    )


def agg_route_daily_rolled(routes: DataFrame) -> DataFrame:
    """The same from the route rollup, which has a row for each of its groups already."""
    return routes.select(
        *ROUTE_GRAIN,
        F.col(TRIPS_COUNT).alias("total_trips"),
        F.col("total_amount_sum").alias("total_revenue"),
        F.try_divide("total_amount_sum", "total_amount_known").alias("avg_total_amount"),
        F.try_divide("trip_duration_min_sum", "trip_duration_min_known").alias("avg_trip_duration_min"),
    )


def agg_pickup_zone(measured: DataFrame) -> DataFrame:
    """Volume, distance and fares per pickup zone."""
    return measured.groupBy("pulocation_id").agg(
        trip_count().alias("total_trips"),
        average("trip_distance").alias("avg_trip_distance"),
        average("total_amount").alias("avg_total_amount"),
        total("total_amount").alias("total_revenue"),
    )


def agg_hourly_traffic(measured: DataFrame) -> DataFrame:
    """Volume, duration, distance and revenue per hour and weekday."""
    return measured.groupBy("pickup_hour", "day_of_week").agg(
        trip_count().alias("total_trips"),
        average("trip_duration_min").alias("avg_trip_duration_min"),
        average("trip_distance").alias("avg_trip_distance"),
        total("total_amount").alias("total_revenue"),
    )


# Order in which a table is shown, as SQL. Money is compared in cents, and equal rows go by their
# keys, so the order is the same however sums were added up. Stored files do not keep it.
# The leading column of each published table.
SERVING_ORDER = {
    "agg_payment_type": "round(total_revenue, 2) DESC, payment_type ASC NULLS LAST",
    "agg_route_daily": "round(total_revenue, 2) DESC, pickup_date, pulocation_id ASC NULLS LAST, dolocation_id ASC NULLS LAST",
    "agg_pickup_zone": "total_trips DESC, pulocation_id ASC NULLS LAST",
    "agg_hourly_traffic": "day_of_week, pickup_hour",
}


def serve(name: str, df: DataFrame) -> DataFrame:
    """``df`` in the order in which table ``name`` is shown."""
    order = SERVING_ORDER.get(name)
    return df.sparkSession.sql(f"SELECT * FROM {{table}} ORDER BY {order}", table=df) if order else df
