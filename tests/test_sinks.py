import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from frames import NOON, trip, trips

from tripmill.__main__ import main
from tripmill.schema import TRIPS
from tripmill.sinks import tables
from tripmill.sinks.backfill import TABLE, backfill, create_table
from tripmill.sources.months import select_months

DAY = dt.timedelta(days=1)


def shifted(days, **changes):
    at = NOON + days * DAY
    return trip(pickup_datetime=at, pickup_date=at.date(), dropoff_datetime=at + dt.timedelta(minutes=10), **changes)


def raw_month(spark, root, month, rows):
    schema = "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, VendorID int"
    df = spark.createDataFrame(rows, schema).coalesce(1)
    df.write.mode("overwrite").parquet(f"{root}/yellow_tripdata_{month}.parquet")


def ride(day, vendor=1):
    at = dt.datetime.fromisoformat(day + " 08:00:00")
    return (at, at + dt.timedelta(minutes=9), vendor)


@pytest.mark.parametrize("files", [None, 3])
def test_plain_files(spark, folder, files):
    df = trips(spark, *[shifted(i) for i in range(30)]).repartition(5)
    assert tables.write_files(df, folder + "/t", files) == 30
    back = tables.read_table(spark, folder + "/t", TRIPS)
    assert back.schema.fieldNames() == TRIPS.fieldNames() and back.count() == 30
    found = list(Path(folder, "t").glob("*.parquet"))
    assert len(found) == (files or 5) and all(f.name.endswith(".snappy.parquet") for f in found)
    assert tables.write_files(df.limit(1), folder + "/t") == 1
    assert tables.read_table(spark, folder + "/t", TRIPS).count() == 1


def test_by_day_layout_is_clustered(spark, folder):
    rows = [shifted(i % 3, pulocation_id=50 - i, vendor_id=i) for i in range(45)]
    assert tables.write_by_day(trips(spark, *rows), folder + "/t") == 45
    days = sorted(p.name for p in Path(folder, "t").glob("pickup_date=*"))
    assert days == ["pickup_date=2023-05-07", "pickup_date=2023-05-08", "pickup_date=2023-05-09"]
    for file in Path(folder, "t").glob("*/*.parquet"):
        zones = pq.ParquetFile(file).read(["pulocation_id"])["pulocation_id"].to_pylist()
        assert zones == sorted(zones)
    back = tables.read_table(spark, folder + "/t", TRIPS)
    key = lambda r: r.vendor_id
    assert sorted(back.collect(), key=key) == sorted(trips(spark, *rows).collect(), key=key)


def test_a_hot_day_is_split(spark, folder):
    """A day beyond the target size goes to several tasks, hence several files."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        hot = spark.range(20_000, numPartitions=8).selectExpr("cast(id as int) vendor_id", "xxhash64(id) noise", "date'2023-05-07' pickup_date", "1 pulocation_id", "1 dolocation_id", "1 payment_type")
        assert tables.write_by_day(hot, folder + "/t") == 20_000
        assert len(list(Path(folder, "t").glob("*/*.parquet"))) > 1
        assert spark.read.parquet(folder + "/t").select("vendor_id").distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_catalog_table_over_a_path(spark, folder):
    df = trips(spark, trip(), shifted(1), shifted(1))
    try:
        for _ in range(2):
            assert tables.save_by_day(df, "trips_placed", folder + "/t") == 3
        assert partitions(spark, "trips_placed") == [("2023-05-07",), ("2023-05-08",)]
        assert spark.table("trips_placed").count() == 3 and len(list(Path(folder, "t").glob("pickup_date=*"))) == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS trips_placed")
    assert tables.read_table(spark, folder + "/t", TRIPS).count() == 3  # the files stay


def test_catalog_table(spark):
    assert tables.save_by_day(trips(spark, trip(), shifted(1)), "trips_saved") == 2
    assert spark.table("trips_saved").filter("pickup_date = date'2023-05-08'").count() == 1
    spark.sql("DROP TABLE trips_saved")


def test_backfill_is_idempotent_and_keeps_stray_trips(spark, folder):
    raw, out = folder + "/raw", folder + "/out"
    raw_month(spark, raw, "2023-01", [ride("2023-01-30"), ride("2023-01-31")])
    raw_month(spark, raw, "2023-02", [ride("2023-01-31", 2), ride("2023-02-01")])
    months = select_months(spark, raw, "yellow", "2022-12", "2023-03")
    for fresh in (True, True, False):
        counts = backfill(spark, months, out, fresh).orderBy("source_month").collect()
        assert [tuple(r) for r in counts] == [("2023-01", 2, 2), ("2023-02", 2, 2)]
    table = tables.read_table(spark, out, TABLE)
    assert table.filter("pickup_date = date'2023-01-31'").count() == 2

    # A corrected month replaces all of that month and nothing else.
    raw_month(spark, raw, "2023-01", [ride("2023-01-02")])
    months = select_months(spark, raw, "yellow", "2023-01", "2023-01")
    backfill(spark, months, out, fresh=False)
    spark.catalog.clearCache()
    days = sorted(str(r.pickup_date) for r in tables.read_table(spark, out, TABLE).collect())
    assert days == ["2023-01-02", "2023-01-31", "2023-02-01"]

    create_table(spark, "trips_backfilled", out)
    assert spark.table("trips_backfilled").count() == 3
    spark.sql("DROP TABLE trips_backfilled")


def partitions(spark, table):
    return sorted(tuple(r) for r in tables.listed_partitions(spark, table).collect())


def test_catalog_partitions_follow_the_months_loaded(spark, folder):
    raw, out = folder + "/raw", folder + "/o'ut"
    for month in ("2023-01", "2023-02"):
        raw_month(spark, raw, month, [ride(f"{month}-05"), ride(f"{month}-06")])
    chosen = lambda a, b: select_months(spark, raw, "yellow", a, b)
    try:
        months = chosen("2023-01", "2023-02")
        backfill(spark, months, out)
        create_table(spark, "trips_listed", out, list(months))
        days = [(m, f"{m}-0{d}") for m in ("2023-01", "2023-02") for d in (5, 6)]
        assert partitions(spark, "trips_listed") == days and spark.table("trips_listed").count() == 4

        # A fresh backfill of one month, one of whose days is gone and another new.
        raw_month(spark, raw, "2023-02", [ride("2023-02-06"), ride("2023-02-07")])
        months = chosen("2023-02", "2023-02")
        backfill(spark, months, out)
        create_table(spark, "trips_listed", out, list(months))
        assert partitions(spark, "trips_listed") == [("2023-02", "2023-02-06"), ("2023-02", "2023-02-07")]
        found = spark.table("trips_listed").where("source_month = '2023-02'")
        assert found.count() == 2 and spark.table("trips_listed").count() == 2
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "CatalogFileIndex" in text or "PartitionFilters: [isnotnull(source_month" in text

        # All folders listed instead give the same.
        create_table(spark, "trips_listed", out)
        assert len(partitions(spark, "trips_listed")) == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS trips_listed")


def test_fresh_backfill_forgets_other_months(spark, folder):
    raw, out = folder + "/raw", folder + "/out"
    for month in ("2023-01", "2023-02"):
        raw_month(spark, raw, month, [ride(f"{month}-05")])
    backfill(spark, select_months(spark, raw, "yellow", "2023-01", "2023-02"), out)
    backfill(spark, select_months(spark, raw, "yellow", "2023-02", "2023-02"), out)
    assert [r.source_month for r in tables.read_table(spark, out, TABLE).collect()] == ["2023-02"]


def test_command_line(spark, folder, capsys, monkeypatch):
    monkeypatch.setattr("tripmill.__main__.build_session", lambda: spark)
    raw, out, root = (f"{folder}/{n}" for n in ("raw", "out", "house"))
    raw_month(spark, raw, "2023-01", [ride("2023-01-02", v) for v in range(5)])
    raw_month(spark, raw, "2023-02", [ride("2023-02-02")])
    main(["backfill", "--raw", raw, "--out", folder + "/months", "--start", "2023-01", "--end", "2023-02"])
    main(["ingest", "--raw", raw, "--out", folder + "/sample", "--sample-rows", "4"])
    main(["ingest", "--raw", raw, "--out", out, "--by-day", "--start", "2023-01", "--end", "2023-01"])
    main(["ingest", "--raw", raw, "--out", out])
    text = capsys.readouterr().out
    assert "2023-01: 5 inserted, 5 stored" in text
    assert [line.split()[0] for line in text.splitlines() if "written" in line] == ["3", "5", "6"]
    with pytest.raises(Exception, match="stg_trips.pulocation_id not_null: 6"):
        main(["build", "--trips", out, "--root", root])
    with pytest.raises(Exception, match="stg_trips.pulocation_id not_null: 6"):
        main(["check", "--trips", out, "--root", root])
