"""Inputs that Spark writes from the test tables: drifting monthly files and a built warehouse."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.normalize import clean_trips, normalize_trips
from tripmill.plans.build import Warehouse, build
from tripmill.session import file_by_file, scratch, scratch_folder
from tripmill.sources.derived import raw_trips

# Each month is a folder of part files below the root.
PATTERN = "{taxi}_tripdata={month}"
TAXI = "yellow"
MONTH_FOLDER = "yellow_tripdata"

# First month of each later layout.
SECOND_LAYOUT = "1997-01"
THIRD_LAYOUT = "1999-01"

_staged: dict[tuple[str, str], str] = {}
_built: dict[tuple[str, str], Warehouse] = {}


def layouts(raw: DataFrame) -> list[DataFrame]:
    """Raw trips with their month in three layouts, one after the other in time.

    Passengers go from whole to floating numbers, a fee column changes its spelling and then
    disappears, a surcharge appears, and the last layout renames times, vendor and zones.
    """
    month, fee = F.col(MONTH_FOLDER), F.col("trip_distance") / 4
    first = raw.filter(month < SECOND_LAYOUT).withColumns(
        {"passenger_count": F.col("passenger_count").cast("bigint"), "airport_fee": fee}
    )
    second = raw.filter((month >= SECOND_LAYOUT) & (month < THIRD_LAYOUT)).withColumns(
        {"Airport_fee": fee, "payment_type": F.col("payment_type").cast("double")}
    )
    third = raw.filter(month >= THIRD_LAYOUT).withColumnsRenamed(
        {
            "VendorID": "vendorid",
            "tpep_pickup_datetime": "lpep_pickup_datetime",
            "tpep_dropoff_datetime": "lpep_dropoff_datetime",
            "PULocationID": "pu_location_id",
            "DOLocationID": "do_location_id",
        }
    )
    return [first, second, third.withColumn("congestion_surcharge", fee)]


def by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with their month, stored by it: joined and shuffled once for all layouts."""
    raw = raw_trips(spark, sf_dir)
    raw = raw.withColumn(MONTH_FOLDER, F.date_format("tpep_pickup_datetime", "yyyy-MM"))
    folder = scratch_folder(spark, "by-month")
    raw.hint("rebalance", MONTH_FOLDER).write.partitionBy(MONTH_FOLDER).parquet(folder)
    return spark.read.schema(raw.schema).parquet(folder)


def staged_months(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the monthly files; written once per application and test folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        folder = scratch_folder(spark, "raw-months")
        with scratch(spark):  # the trips by month go once the layouts are written
            raw = by_month(spark, sf_dir)
            with file_by_file(raw):
                for part in layouts(raw):
                    part.write.mode("append").partitionBy(MONTH_FOLDER).parquet(folder)
        _staged[key] = folder
    return _staged[key]


def built_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Warehouse over the fine trips; built once per application and test folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        trips = clean_trips(normalize_trips(raw_trips(spark, sf_dir)))
        _built[key] = build(spark, trips, scratch_folder(spark, "warehouse"))
    return _built[key]
