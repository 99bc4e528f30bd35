"""Declares a finished build in the session catalog, for SQL clients that outlive the session."""

import datetime as dt

from pyspark.sql import SparkSession

from tripmill.plans import views
from tripmill.plans.build import STORED, Warehouse
from tripmill.schema import PARTITION_COLUMN


def drop_declaration(spark: SparkSession, table: str) -> None:
    """Drop a table whose files stay; one that owns its files is never dropped."""
    if spark.catalog.tableExists(table):
        kind = spark.catalog.getTable(table).tableType
        if kind != "EXTERNAL":
            raise ValueError(f"{table} is a {kind.lower()} table; dropping it would delete its data")
        spark.sql(f"DROP TABLE {table}")


def declare(house: Warehouse, name: str, table: str, by_day: bool) -> None:
    """Declare a stored table where it lies, in its columns and types. The day comes last if it
    is the partition, as in any catalog table."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in house[name].schema.fields)
    quoted = house.path(name).replace("\\", "\\\\").replace("'", "\\'")
    layout = f"PARTITIONED BY ({PARTITION_COLUMN})" if by_day else ""
    house.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {layout} LOCATION '{quoted}'")
    if by_day:
        house.spark.catalog.recoverPartitions(table)


def publish(
    house: Warehouse,
    database: str,
    start: dt.date = views.DEFAULT_START,
    end: dt.date = views.DEFAULT_END,
) -> None:
    """Declare the stored tables where they lie, and replace the views over them."""
    spark: SparkSession = house.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in STORED:
        drop_declaration(spark, f"{database}.{name}")
        declare(house, name, f"{database}.{name}", by_day=name == "fct_trip")
    for name in views.VIEWS:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {views.view_sql(name, f'{database}.', start, end)}")
