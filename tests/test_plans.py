"""Plans stay prunable, pushable and free of Python and of cross joins."""

import datetime as dt

import pytest

from tripmill.operators.additive import ROUTE_GRAIN, rollup, trip_measures
from tripmill.operators.normalize import clean_trips, normalize_trips
from tripmill.plans import models, reports, views
from tripmill.schema import TRIPS
from tripmill.sinks.tables import read_table, write_by_day
from tripmill.sources.derived import raw_trips
from tripmill.sources.files import list_files, read_trips

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Raw trips as files, and a day-partitioned table of a few days of them."""
    raw, days = (str(tmp_path_factory.mktemp(n)) + "/t" for n in ("raw", "days"))
    raw_trips(spark, SF).write.parquet(raw)
    few = clean_trips(normalize_trips(spark.read.parquet(raw))).filter("pickup_date < date'1995-03-01'")
    write_by_day(few, days)
    return raw, days


def test_cleaning_pushes_null_checks_and_prunes_columns(spark, stored):
    trips = read_trips(spark, list_files(spark, stored[0]))
    text = plan(models.agg_pickup_zone(trip_measures(models.stg_trips(trips))))
    assert "PushedFilters: [IsNotNull(tpep_pickup_datetime), IsNotNull(tpep_dropoff_datetime)]" in text
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    columns = scan.split("FileScan parquet [")[1].split("]")[0]
    names = {c.split("#")[0] for c in columns.split(",")}
    assert names == {"tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "PULocationID", "total_amount"}


def test_kpi_prunes_day_partitions(spark, stored):
    trips = read_table(spark, stored[1], TRIPS)
    day = dt.date(1995, 1, 10)
    df = views.v_kpi_daily(trip_measures(models.stg_trips(trips)), day, day)
    assert "PartitionFilters: [isnotnull(pickup_date" in plan(df)
    assert df.count() <= 1


def test_aggregates_combine_before_the_shuffle(spark, stored):
    stg = models.stg_trips(read_table(spark, stored[1], TRIPS))
    text = plan(models.agg_payment_type(trip_measures(stg)))
    assert "partial_sum" in text and text.count("Exchange") == 1


def test_route_aggregate_of_the_build_is_a_projection(spark, stored):
    routes = rollup(trip_measures(models.stg_trips(read_table(spark, stored[1], TRIPS))), ROUTE_GRAIN)
    assert plan(models.agg_route_daily_rolled(routes)).count("Exchange") == 1


def test_zone_dimension_scans_once(spark, stored):
    stg = models.stg_trips(read_table(spark, stored[1], TRIPS))
    assert plan(models.dim_zone(trip_measures(stg))).count("FileScan") == 1


def test_top_zones_sort_only_the_top(spark, stored):
    measured = trip_measures(models.stg_trips(read_table(spark, stored[1], TRIPS)))
    view = views.v_zone_performance(models.agg_pickup_zone(measured), models.dim_zone(measured))
    assert "TakeOrderedAndProject(limit=20" in plan(reports.top_zones(view))


def test_fact_is_numbered_in_one_shuffle_and_stored_by_column(spark, stored):
    """What is left to do after the ranges are written moves a row a range, not trips."""
    stg = models.stg_trips(read_table(spark, stored[1], TRIPS))
    text = plan(models.fct_trip(stg))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line or "Exchange Single" in line]
    assert exchanges and all("(_range" in line or "(_in" in line or "(_group" in line for line in exchanges)
    assert "Sort [pickup_datetime" not in text and "ExistingRDD" not in text and "InArrow" not in text


def test_no_python_and_no_cross_join_anywhere(spark):
    from verification.queries import QUERIES

    writing = {"row_count", "sink_roundtrip", "sink_partitioned", "backfill_months", "catalog_by_day", "catalog_months"}
    for name, query in QUERIES.items():
        if name not in writing:
            text = plan(query(spark, SF))
            assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text, name
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_broadcast_is_only_forced_on_bounded_shifts():
    from pathlib import Path

    package = Path(__file__).resolve().parents[1] / "tripmill"
    users = [p.name for p in package.rglob("*.py") if "F.broadcast(" in p.read_text() and p.parent.name != "llm"]
    assert users == ["numbering.py"]
