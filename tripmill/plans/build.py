"""The warehouse build: fact and rollups first, everything else from them, then the checks."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripmill.operators.additive import CLOCK_GRAIN, ROUTE_GRAIN, rollup, trip_measures
from tripmill.plans import models, views
from tripmill.schema import staged
from tripmill.session import file_by_file, scratch
from tripmill.sinks.tables import read_table, write_by_day, write_files

FACT = T.StructType([T.StructField("event_id", T.StringType()), *staged().fields])

# Independent tables written side by side.
WRITERS = 4

STORED = (
    "fct_trip",
    "rollup_route",
    "rollup_clock",
    "dim_date",
    "dim_zone",
    "dim_vendor",
    "dim_payment_type",
    "agg_payment_type",
    "agg_route_daily",
    "agg_pickup_zone",
    "agg_hourly_traffic",
)


class Warehouse:
    """Tables below a root folder. Each is also a temporary view of its name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def show(self, name: str, df: DataFrame) -> None:
        """Publish a frame under a name without storing it."""
        df.createOrReplaceTempView(name)
        self.tables[name] = df

    def open(self, name: str, schema: T.StructType) -> None:
        """Publish a stored table in its declared columns and types, however it is laid out."""
        self.show(name, read_table(self.spark, self.path(name), schema))

    def store(self, **frames: DataFrame) -> None:
        """Write tables that do not depend on each other, then publish them."""
        with ThreadPoolExecutor(WRITERS) as pool:
            list(pool.map(lambda name: write_files(frames[name], self.path(name)), frames))
        for name, df in frames.items():
            self.open(name, df.schema)


def build(
    spark: SparkSession,
    trips: DataFrame,
    root: str,
    start: dt.date = views.DEFAULT_START,
    end: dt.date = views.DEFAULT_END,
) -> Warehouse:
    """Build every model and view from canonical trips.

    The fact is scanned twice, once per rollup. Dimensions and aggregates then read rollups whose
    size depends on days, zones and codes, not on trips.
    """
    house = Warehouse(spark, root)
    house.show("stg_trips", models.stg_trips(trips))
    with scratch(spark):  # the numbered trips go once the fact is written
        fact = models.fct_trip(house["stg_trips"])
        with file_by_file(fact):
            write_by_day(fact, house.path("fct_trip"), gathered=True)
    house.open("fct_trip", FACT)
    house.store(**rollups(house["fct_trip"]))
    house.store(**derived(house["rollup_route"], house["rollup_clock"]))
    show_views(house, start, end)
    return house


def rollups(fact: DataFrame) -> dict[str, DataFrame]:
    measured = trip_measures(fact)
    return {"rollup_route": rollup(measured, ROUTE_GRAIN), "rollup_clock": rollup(measured, CLOCK_GRAIN)}


def derived(routes: DataFrame, clock: DataFrame) -> dict[str, DataFrame]:
    """Dimensions and aggregates, all from the two rollups."""
    return {
        "dim_date": models.dim_date(clock),
        "dim_zone": models.dim_zone(routes),
        "dim_vendor": models.dim_vendor(clock),
        "dim_payment_type": models.dim_payment_type(clock),
        "agg_payment_type": models.agg_payment_type(clock),
        "agg_route_daily": models.agg_route_daily_rolled(routes),
        "agg_pickup_zone": models.agg_pickup_zone(routes),
        "agg_hourly_traffic": models.agg_hourly_traffic(clock),
    }


def declared(spark: SparkSession) -> dict[str, T.StructType]:
    """Columns and types of every stored table, from the models themselves over no rows."""
    found = rollups(spark.createDataFrame([], FACT))
    found |= derived(found["rollup_route"], found["rollup_clock"])
    return {"fct_trip": FACT, **{name: df.schema for name, df in found.items()}}


def show_views(house: Warehouse, start: dt.date, end: dt.date) -> None:
    """Publish the dashboard views over stored tables."""
    house.show("v_kpi_daily", views.v_kpi_daily(house["rollup_route"], start, end))
    house.show("v_hourly_traffic", views.v_hourly_traffic(house["agg_hourly_traffic"]))
    house.show("v_payment_performance", views.v_payment_performance(house["agg_payment_type"]))
    zones = views.v_zone_performance(house["agg_pickup_zone"], house["dim_zone"])
    house.show("v_zone_performance", zones)
    house.show("v_route_performance", views.v_route_performance(house["agg_route_daily"]))
    for view, name in views.SERVED.items():
        house.show(view, models.serve(name, house[name]))


def reopen(
    spark: SparkSession,
    trips: DataFrame,
    root: str,
    start: dt.date = views.DEFAULT_START,
    end: dt.date = views.DEFAULT_END,
) -> Warehouse:
    """Publish the tables and views of an earlier build."""
    house = Warehouse(spark, root)
    house.show("stg_trips", models.stg_trips(trips))
    for name, schema in declared(spark).items():
        house.open(name, schema)
    show_views(house, start, end)
    return house
