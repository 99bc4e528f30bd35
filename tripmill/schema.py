"""Column contracts and label tables.

Everything in this module is a fixed value: results are only right if these equal the published
trip-record layout and the labels the dashboards show.
"""

from pyspark.sql import types as T

# Spellings under which a raw file may carry each canonical column, in order of preference.
# Lookup ignores case, so VendorID also finds vendorid.
RAW_NAMES = {
    "vendor_id": ("VendorID",),
    "pickup_datetime": ("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime"),
    "dropoff_datetime": ("tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropoff_datetime"),
    "passenger_count": ("passenger_count",),
    "trip_distance": ("trip_distance",),
    "pulocation_id": ("PULocationID", "pu_location_id"),
    "dolocation_id": ("DOLocationID", "do_location_id"),
    "payment_type": ("payment_type",),
    "fare_amount": ("fare_amount",),
    "tip_amount": ("tip_amount",),
    "total_amount": ("total_amount",),
}

# Canonical trips: the contract between cleaning and modelling (fixed order).
TRIPS = T.StructType(
    [
        T.StructField("vendor_id", T.IntegerType()),
        T.StructField("pickup_datetime", T.TimestampType()),
        T.StructField("dropoff_datetime", T.TimestampType()),
        T.StructField("pickup_date", T.DateType()),
        T.StructField("pickup_hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pulocation_id", T.IntegerType()),
        T.StructField("dolocation_id", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("trip_duration_min", T.DoubleType()),
    ]
)
TRIP_COLUMNS = tuple(TRIPS.fieldNames())

# Missing measures count as zero; ids stay null.
ZERO_FILLED = ("passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount")

TAXI_TYPES = ("yellow", "green", "fhv", "fhvhv")

# A trip is identified by these columns plus its number among equal ones.
TRIP_KEY = ("vendor_id", "pickup_datetime", "pulocation_id", "dolocation_id")

# Order of trips that share a key. The last two columns only settle ties.
TRIP_ORDER = (
    "dropoff_datetime",
    "total_amount",
    "fare_amount",
    "tip_amount",
    "trip_distance",
    "passenger_count",
    "payment_type",
)

# Layout of large trip tables: one folder per day, rows sorted by these inside each file.
PARTITION_COLUMN = "pickup_date"
CLUSTER_COLUMNS = ("pulocation_id", "dolocation_id", "payment_type")

DAY_NAMES = {
    1: "Sunday",
    2: "Monday",
    3: "Tuesday",
    4: "Wednesday",
    5: "Thursday",
    6: "Friday",
    7: "Saturday",
}
UNKNOWN_DAY = "Unknown"

PAYMENT_NAMES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
OTHER_PAYMENT_PREFIX = "Type "

# Stand-in for a null key part, and the separator, in surrogate keys.
KEY_NULL = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def staged(schema: T.StructType = TRIPS) -> T.StructType:
    """The warehouse form of a schema: every integer is 64 bits wide."""
    return T.StructType(
        [
            T.StructField(f.name, T.LongType() if f.dataType == T.IntegerType() else f.dataType)
            for f in schema.fields
        ]
    )
