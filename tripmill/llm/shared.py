"""Helpers that several operators use."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import scratch_folder

# Fixed value: the white space that separates words.
SPACE = " \t\n\x0b\f\r"


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write a frame to the shared checkpoint folder and go on from there.

    Later stages then neither recompute it nor depend on executors that may be lost.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_folder(spark, "llm"))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """A frame written as Parquet to the shared folder and read again, with its place."""
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a folder that ``stored`` made."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_text(text: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit(""))


def split_words(text: Column) -> Column:
    """Words between runs of SPACE; an empty array when there is none."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[ \t\n\x0B\f\r]+"))


def row_hash(key: str, text: str) -> Column:
    """Tells rows apart when results are joined back; equal rows share theirs.

    A hash skips nulls, so it also takes which of the two is null.
    """
    both = (F.col(f"`{key}`").cast("string"), F.col(f"`{text}`"))
    return F.xxhash64(*both, *(c.isNull() for c in both))


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster it is installed on the nodes or sent with ``--py-files``; then this changes nothing.
    """
    root = str(Path(__file__).resolve().parents[2])
    found = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in found.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, found) if p)


def map_arrow(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path; ids keep their exact type, nulls too."""
    on_workers(df.sparkSession)
    return df.mapInArrow(work, schema)


def portions(texts: Sequence[str], most: int = 4_000_000, rows: int = 1 << 30) -> Iterator[slice]:
    """Slices of about ``most`` characters or ``rows`` rows, so that a batch of long texts needs little memory."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most or i + 1 - start >= rows:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))
