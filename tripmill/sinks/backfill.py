"""Month-by-month backfill of the trip table."""

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schema import PARTITION_COLUMN, TRIPS
from tripmill.sinks.tables import by_day, listed_partitions, read_table
from tripmill.sources.files import read_trips

MONTH_COLUMN = "source_month"
TABLE = T.StructType([*TRIPS.fields, T.StructField(MONTH_COLUMN, T.StringType())])
MONTHS_AT_A_TIME = 4


def recreate(spark: SparkSession, path: str) -> None:
    """Empty the target, keeping nothing of an earlier backfill."""
    empty = spark.createDataFrame([], TABLE)
    empty.write.mode("overwrite").partitionBy(MONTH_COLUMN, PARTITION_COLUMN).parquet(path)


def create_table(spark: SparkSession, table: str, path: str, months: Sequence[str] | None = None) -> None:
    """Declare a backfilled folder as a catalog table and bring its partitions up to date.

    With ``months``, the months just loaded into an otherwise empty folder, only their folders are
    listed: the catalog's own partition list tells what to forget. Without, all folders are.
    """
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLE.fields)
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({MONTH_COLUMN}, {PARTITION_COLUMN}) LOCATION '{quoted}'"
    )
    if months is None:
        # Also forgets the partitions of months that a fresh backfill dropped.
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        return
    known = listed_partitions(spark, table).select(MONTH_COLUMN).distinct()
    for month in sorted({row[0] for row in known.collect()} - set(months)):
        forget_month(spark, table, month)
    for month in months:
        declare_month(spark, table, path, month)
    spark.catalog.refreshTable(table)


def _partition(month: str, day: str) -> str:
    return f"PARTITION ({MONTH_COLUMN} = '{month}', {PARTITION_COLUMN} = DATE'{day}')"


def _known_days(spark: SparkSession, table: str, month: str) -> set[str]:
    days = listed_partitions(spark, table).where(F.col(MONTH_COLUMN) == month)
    return {row[0] for row in days.select(PARTITION_COLUMN).collect()}


def forget_month(spark: SparkSession, table: str, month: str) -> None:
    """Drop a month's partitions from the catalog; files stay as they are."""
    dropped = [_partition(month, day) for day in sorted(_known_days(spark, table, month))]
    if dropped:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(dropped)}")


def declare_month(spark: SparkSession, table: str, path: str, month: str) -> None:
    """Make the catalog's days of a month those of its folder, which alone is listed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MONTH_COLUMN}={month}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [entry.getPath().getName() for entry in files.listStatus(folder)] if files.exists(folder) else []
    days = {name.partition("=")[2] for name in names if name.startswith(f"{PARTITION_COLUMN}=")}
    known = _known_days(spark, table, month)
    if known - days:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(_partition(month, d) for d in sorted(known - days))}")
    if days - known:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(_partition(month, d) for d in sorted(days - known))}")


def load_month(spark: SparkSession, month: str, files: Sequence[str], path: str) -> int:
    """Replace one source month with the clean trips of its files; returns their number.

    The month of the *file* is the outer partition. Files hold stray trips of other months, so if
    days alone were overwritten, one month's file would wipe days another had filled.
    """
    trips, seen = by_day(read_trips(spark, files))
    folder = f"{path}/{MONTH_COLUMN}={month}"
    trips.write.mode("overwrite").partitionBy(PARTITION_COLUMN).parquet(folder)
    return seen.get["rows"]


def backfill(
    spark: SparkSession,
    months: Mapping[str, Sequence[str]],
    path: str,
    fresh: bool = True,
    at_a_time: int = MONTHS_AT_A_TIME,
) -> DataFrame:
    """Load each month on its own and set what went in beside what is stored.

    Running it again gives the same table. A few months run side by side, so that the last tasks
    of one do not idle the cluster. One result row per month.
    """
    if fresh:
        recreate(spark, path)
    with ThreadPoolExecutor(at_a_time) as pool:
        loads = [pool.submit(load_month, spark, m, files, path) for m, files in months.items()]
        rows = [(month, load.result()) for month, load in zip(months, loads)]
    inserted = spark.createDataFrame(rows, f"{MONTH_COLUMN} string, inserted_rows bigint")
    # Only partition values and row counts are read here, no column.
    stored = (
        read_table(spark, path, TABLE)
        .groupBy(MONTH_COLUMN)
        .agg(F.count(F.lit(1)).alias("stored_rows"))
    )
    both = inserted.join(stored, MONTH_COLUMN, "left")
    return both.select(
        MONTH_COLUMN, "inserted_rows", F.coalesce("stored_rows", F.lit(0)).alias("stored_rows")
    )
