"""Small hand-made trip frames."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tripmill.schema import TRIPS

NOON = dt.datetime(2023, 5, 7, 12, 0)  # a Sunday


def trip(**changes) -> dict:
    """A canonical trip with some columns changed."""
    row = {
        "vendor_id": 1,
        "pickup_datetime": NOON,
        "dropoff_datetime": NOON + dt.timedelta(minutes=10),
        "pickup_date": NOON.date(),
        "pickup_hour": 12,
        "day_of_week": 1,
        "passenger_count": 1.0,
        "trip_distance": 2.0,
        "pulocation_id": 10,
        "dolocation_id": 20,
        "payment_type": 1,
        "fare_amount": 10.0,
        "tip_amount": 2.0,
        "total_amount": 12.0,
        "trip_duration_min": 10.0,
    }
    return row | changes


def trips(spark: SparkSession, *rows: dict) -> DataFrame:
    return spark.createDataFrame([tuple(r[c] for c in TRIPS.fieldNames()) for r in rows], TRIPS)
