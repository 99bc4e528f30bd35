"""Parquet sinks that report how many rows they wrote."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schema import CLUSTER_COLUMNS, PARTITION_COLUMN


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while they pass, instead of running the plan a second time.

    Attach it after the last shuffle: Spark counts a repeated task of the final stage once, but
    one of an earlier stage again.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_files(df: DataFrame, path: str, files: int | None = None) -> int:
    """Overwrite ``path`` with snappy Parquet and return the row count.

    Without ``files`` every task writes what it has, with no shuffle; ``files`` forces a number.
    """
    df, seen = counted(df if files is None else df.repartition(files))
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return seen.get["rows"]


def by_day(df: DataFrame, gathered: bool = False) -> tuple[DataFrame, Observation]:
    """Lay rows out for a day-partitioned, clustered write.

    ``rebalance`` brings a day together but lets adaptive execution split a day that is too large
    for one task and merge small ones, so file sizes follow the data. Sorting inside each task
    gives row groups narrow zone ranges, which filters on zones and payment types skip by.

    ``gathered`` rows lie together by day already, as those numbered along time do, and are not
    shuffled again; a day then has a file for each of the tasks that hold some of it.
    """
    df, seen = counted(df if gathered else df.hint("rebalance", PARTITION_COLUMN))
    return df.sortWithinPartitions(PARTITION_COLUMN, *CLUSTER_COLUMNS), seen


def write_by_day(df: DataFrame, path: str, gathered: bool = False) -> int:
    """Overwrite ``path`` with one folder per day; returns the row count."""
    df, seen = by_day(df, gathered)
    df.write.mode("overwrite").partitionBy(PARTITION_COLUMN).parquet(path)
    return seen.get["rows"]


def save_by_day(df: DataFrame, table: str, path: str | None = None) -> int:
    """The same as a catalog table, which owns its files unless they are given a ``path``.

    The catalog knows every day, so a query of some days lists no other folders.
    """
    df, seen = by_day(df)
    writer = df.write.mode("overwrite").partitionBy(PARTITION_COLUMN).format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
    return seen.get["rows"]


def listed_partitions(spark: SparkSession, table: str) -> DataFrame:
    """The partitions that the catalog knows of a table, a column for each partition column.

    They come from the catalog alone: no folder is listed and no file is opened.
    """
    parts = spark.sql(f"SHOW PARTITIONS {table}")
    names = [f.name for f in spark.catalog.listColumns(table) if f.isPartition]
    pieces = F.split("partition", "/")
    values = [F.url_decode(F.regexp_extract(pieces[k], "=(.*)$", 1)).alias(n) for k, n in enumerate(names)]
    return parts.select(*values)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a written table in its declared types and column order, without inference."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
