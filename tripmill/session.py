"""Spark session settings and the shared scratch folder."""

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Calendar parts of a trip are wall-clock parts, so the session zone must be UTC: in a zone with
# daylight saving some local times do not exist and durations across the change are off by an hour.
RUNTIME_SETTINGS = {"spark.sql.session.timeZone": "UTC"}

CLUSTER_SETTINGS = {
    **RUNTIME_SETTINGS,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Also the target size of the files a rebalanced write produces.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Shuffles start wide, so that large data spreads before adaptive execution merges partitions.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    # Range shuffles of thousands of partitions send this many rows of each to the driver.
    "spark.sql.execution.rangeExchange.sampleSizePerPartition": "20",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}

# Scratch folders of every application, for their removal.
_folders: dict[str, list[str]] = {}


def build_session(app_name: str = "tripmill") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in CLUSTER_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder on storage that every executor sees.

    The cluster names the place in ``spark.checkpoint.dir``. Only a local session may fall back to
    a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not _one_machine(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tripmill-")
        spark.sparkContext.setCheckpointDir(base)
    folder = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _folders.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def _one_machine(master: str) -> bool:
    """Whether driver and executors are one process. ``local-cluster[...]`` has executors apart."""
    return master == "local" or master.startswith("local[")


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster it is installed on the nodes or sent with ``--py-files``; then this changes nothing.
    """
    root = str(Path(__file__).resolve().parents[1])
    found = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in found.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, found) if p)


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the scratch folder as Parquet and go on from there.

    Unlike a checkpoint the files are compressed, are read by column and tell their size to the
    planner. They stay until the end of ``scratch``, or for good.
    """
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def file_by_file(df: DataFrame) -> Iterator[None]:
    """Read the files of ``df`` one a task, or in smaller pieces, inside a block.

    Files that tasks of a bounded size wrote are such tasks again. Spark packs files by their compressed
    bytes, which says little about rows: many well compressed files would meet in one task, whose
    sort then spills.
    """
    spark, name = df.sparkSession, "spark.sql.files.maxPartitionBytes"
    sizes = []
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        held = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path)
        sizes.append((held.getLength(), held.getFileCount()))
    before = spark.conf.get(name)
    if sizes:
        mean = sum(size for size, _ in sizes) // max(sum(files for _, files in sizes), 1)
        limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
        spark.conf.set(name, str(max(min(mean, limit), 1 << 20)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of a block, the scratch folders made inside it.

    Frames that read them end with the block.
    """
    folders = _folders.setdefault(spark.sparkContext.applicationId, [])
    kept = len(folders)
    try:
        yield
    finally:
        for folder in folders[kept:]:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        del folders[kept:]
