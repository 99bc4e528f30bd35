"""The fact is laid out by the shuffle that numbers it, and monthly files come from one join."""

import glob

import pytest
from pyspark.sql import functions as F

from tripmill.operators.normalize import clean_trips, normalize_trips
from tripmill.plans import models
from tripmill.session import file_by_file
from tripmill.sinks.tables import by_day, write_by_day
from tripmill.sources.derived import raw_trips
from verification import staging

SF = "/root/testdata/sf0.001"


@pytest.fixture
def fact(spark):
    """A fact numbered in several ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield models.fct_trip(models.stg_trips(clean_trips(normalize_trips(raw_trips(spark, SF, coarse=True)))))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranges_of_numbered_trips_are_spans_of_time(spark, fact):
    stored = spark.read.parquet(*fact.inputFiles()).groupBy("_range")
    spans = stored.agg(F.min("pickup_datetime").alias("low"), F.max("pickup_datetime").alias("high")).orderBy("_range").collect()
    assert len(spans) > 4
    assert all(a.high <= b.low for a, b in zip(spans, spans[1:]))


def test_numbered_trips_are_written_by_day_without_a_shuffle(spark, fact, folder):
    plan = by_day(fact, gathered=True)[0]._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" not in plan.upper() and "pickup_date#" in plan
    with file_by_file(fact):
        assert write_by_day(fact, folder + "/t", gathered=True) == fact.count()
    found = spark.read.parquet(folder + "/t")
    assert found.select(*sorted(fact.columns)).exceptAll(fact.select(*sorted(fact.columns))).isEmpty()
    days, ranges = len(glob.glob(folder + "/t/pickup_date=*")), len(set(fact.inputFiles()))
    assert len(glob.glob(folder + "/t/*/*.parquet")) <= days + ranges


def test_files_are_read_one_a_task_inside_the_block_only(spark, folder):
    spark.range(0, 12_000, 1, 12).write.parquet(folder + "/t")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def tasks():
        return spark.read.parquet(folder + "/t").rdd.getNumPartitions()

    packed = tasks()
    with file_by_file(spark.read.parquet(folder + "/t")):
        assert tasks() == 12 >= packed
    with file_by_file(spark.range(3).toDF("id")):  # reads no files
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_layouts_come_from_one_join_and_hold_every_month(spark):
    raw = staging.by_month(spark, SF)
    parts = staging.layouts(raw)
    for part in parts:
        text = part._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in text and "Exchange" not in text
    assert sum(part.count() for part in parts) == raw_trips(spark, SF).count()
