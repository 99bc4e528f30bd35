"""Raw-shaped trips from order tables.

There are no trip files beside the test tables, so one trip is made per order line. The ``fine``
form spreads pickups over zones and hours; the ``coarse`` form has few zones and hours, so that
many trips share a key.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import configure

ZONES = 263
COARSE_ZONES = 5

# Columns used, so that no file has to be opened to learn its schema.
LINES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_tax double, l_returnflag string"
)
ORDERS = "o_orderkey bigint, o_orderdate timestamp_ntz"


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the date of their order. A hot order is split by adaptive skew joins."""
    configure(spark)
    lines = spark.read.schema(LINES).parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.schema(ORDERS).parquet(f"{folder}/orders.parquet")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def raw_trips(spark: SparkSession, folder: str, coarse: bool = False) -> DataFrame:
    """Trips in raw layout, with missing values, non-positive durations and negative fares."""
    zones = COARSE_ZONES if coarse else ZONES
    hours = F.col("l_linenumber") % 3 + 6 if coarse else F.col("l_partkey") % 24
    minutes = F.lit(0) if coarse else F.col("l_linenumber")
    ordered = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    ride = ((F.col("l_partkey") * 7 + F.col("l_suppkey")) % 90 - 10) * 60 + F.col("l_quantity").cast("int")
    lines = order_lines(spark, folder).withColumn("pickup", ordered + hours * 3600 + minutes * 60)
    dropoff = F.timestamp_seconds(F.col("pickup") + ride)
    extended, tip = F.col("l_extendedprice"), F.col("l_tax") * 100
    refund = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 6)
    return lines.select(
        (F.col("l_suppkey") % 4 + 1).alias("VendorID"),
        F.timestamp_seconds("pickup").alias("tpep_pickup_datetime"),
        F.when(F.col("l_suppkey") % 37 != 0, dropoff).alias("tpep_dropoff_datetime"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber").cast("double")).alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.when(F.col("l_partkey") % 101 != 0, F.col("l_partkey") % zones + 1).alias("PULocationID"),
        (F.col("l_suppkey") % zones + 1).alias("DOLocationID"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("payment_type"),
        F.when(refund, -extended).otherwise(extended).alias("fare_amount"),
        tip.alias("tip_amount"),
        (extended + tip).alias("total_amount"),
    )
