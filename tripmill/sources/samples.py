"""Capped reads for trial runs."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.normalize import clean_trips, normalize_trips
from tripmill.schema import TRIP_COLUMNS
from tripmill.sources.files import (
    FILE,
    PLACE,
    SchemaGroup,
    count_files,
    placed_trips,
    read_group,
    schema_groups,
    union_by_name,
)

# Rows of a file that a cap counts together.
BLOCK = 1 << 16


def rows_per_file(sample_rows: int, files: int) -> int:
    """Equal share of the sample for each file, rounded up, at least one row."""
    return max(1, -(-sample_rows // files))


def _first_of_each(spark: SparkSession, groups: Sequence[SchemaGroup], sample_rows: int) -> list[DataFrame]:
    """The first rows of every file, by a filter on their place: one scan a schema group.

    The plan does not grow with the files, and a file's rows are the same however it is split.
    """
    n = rows_per_file(sample_rows, count_files(spark, groups))
    return [read_group(spark, group, with_place=True).filter(F.col(PLACE) < n) for group in groups]


def sample_per_file(spark: SparkSession, paths: Sequence[str], sample_rows: int, with_path: bool = False) -> DataFrame:
    """Raw rows, the same number from each file, so that every month stays covered."""
    sample = union_by_name(_first_of_each(spark, schema_groups(spark, paths), sample_rows))
    return sample.drop(PLACE) if with_path else sample.drop(FILE, PLACE)


def sample_trips(spark: SparkSession, paths: Sequence[str], sample_rows: int) -> DataFrame:
    """Clean trips of a per-file sample."""
    parts = map(normalize_trips, _first_of_each(spark, schema_groups(spark, paths), sample_rows))
    sample = next(parts)
    for part in parts:
        sample = sample.unionByName(part)
    return clean_trips(sample)


def limit_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of a frame with ``FILE`` and ``PLACE``, in the order of files and places.

    Rows are counted per block of a file. Blocks are taken whole until the next would pass the cap;
    of that one the place of its last row is looked up. What is left is a filter on blocks, so a
    cap of any size is read and written by as many tasks as its files have splits.
    """
    block = F.floor(F.col(PLACE) / BLOCK)
    chosen, left = [], n
    counts = df.groupBy(FILE, block.alias("block")).agg(F.count(F.lit(1)).alias("rows")).orderBy(FILE, "block")
    # Read in order and only as far as the cap reaches; a row a block.
    for row in counts.toLocalIterator():
        if left <= 0:
            break
        last = (row["block"] + 1) * BLOCK
        if row["rows"] > left:
            edge = df.filter((F.col(FILE) == row[FILE]) & (block == row["block"]))
            last = edge.select(PLACE).orderBy(PLACE).offset(left - 1).limit(1).first()[0] + 1
        chosen.append((row[FILE], row["block"], last))
        left -= row["rows"]
    spark = df.sparkSession
    blocks = spark.createDataFrame(chosen, f"{FILE} string, _block bigint, _last bigint")
    kept = df.withColumn("_block", block).join(blocks, [FILE, "_block"])
    return kept.filter(F.col(PLACE) < F.col("_last")).select(df.columns)


def first_trips(spark: SparkSession, paths: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` clean trips in the order of files."""
    return limit_rows(placed_trips(spark, schema_groups(spark, paths)), n).select(*TRIP_COLUMNS)
