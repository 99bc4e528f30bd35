import datetime as dt

import pytest
from frames import NOON
from pyspark.sql import functions as F

from tripmill.sources import samples
from tripmill.sources.files import (
    count_files,
    external_view,
    list_files,
    read_raw,
    read_trips,
    schema_groups,
    union_by_name,
)
from tripmill.sources.months import check_taxi, month_frame, select_months

END = NOON + dt.timedelta(minutes=5)


def write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def drifting(spark, folder):
    """Three months: passengers change type, a fee changes case, the last month is renamed."""
    old = "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count {}, {} double"
    rows = [(NOON, END, 2, 1.0), (NOON, END, None, None)]
    write(spark, f"{folder}/yellow_tripdata_2023-01.parquet", rows, old.format("bigint", "airport_fee"))
    floats = [(a, b, None if c is None else c + 0.5, d) for a, b, c, d in rows]
    write(spark, f"{folder}/yellow_tripdata_2023-02.parquet", floats, old.format("double", "Airport_fee"))
    new = "lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, extra string"
    write(spark, f"{folder}/yellow_tripdata_2023-04.parquet", [(NOON, END, "x")], new)
    return folder


def test_listing_is_sorted_and_fails_on_nothing(spark, drifting):
    files = list_files(spark, f"{drifting}/*.parquet")
    assert files == sorted(files) and len(files) == 3
    for pattern in (f"{drifting}/none-*.parquet", f"{drifting}/absent"):
        with pytest.raises(FileNotFoundError):
            list_files(spark, pattern)


def test_paths_with_blanks(spark, folder):
    write(spark, f"{folder}/a b/x.parquet", [(1,)], "v int")
    assert read_raw(spark, list_files(spark, f"{folder}/a b/*")).count() == 1


def test_union_by_name_over_drifting_files(spark, drifting):
    raw = read_raw(spark, list_files(spark, f"{drifting}/*.parquet"))
    types = dict(raw.dtypes)
    assert types["passenger_count"] == "double" and types["extra"] == "string"
    row = raw.agg(
        F.count("*").alias("n"), F.sum("passenger_count").alias("p"), F.sum("airport_fee").alias("f"),
        F.count("extra").alias("x"),
    ).first()
    assert (row.n, row.p, row.f, row.x) == (5, 4.5, 2.0, 1)


def test_trips_of_drifting_files(spark, drifting):
    trips = read_trips(spark, list_files(spark, f"{drifting}/*.parquet"))
    assert trips.count() == 5
    assert trips.agg(F.sum("passenger_count")).first()[0] == 4.5


def test_conflicting_types_in_one_folder(spark, folder):
    for i in range(5):
        whole = i % 2
        write(spark, folder, [(i if whole else float(i),)], f"passenger_count {'bigint' if whole else 'double'}")
    files = list_files(spark, folder)
    groups = schema_groups(spark, files)
    assert len(groups) == 2 and sorted(f for _, g in groups for f in g) == files
    assert read_raw(spark, files).agg(F.sum("passenger_count")).first()[0] == 10.0


def test_extra_columns_need_no_second_group(spark, folder):
    write(spark, folder, [(1, 2)], "VendorID int, a int")
    write(spark, folder, [(3, 4)], "VendorID int, b int")
    assert len(schema_groups(spark, list_files(spark, folder))) == 1
    rows = read_raw(spark, list_files(spark, folder)).orderBy("VendorID").collect()
    assert [(r.VendorID, r.a, r.b) for r in rows] == [(1, 2, None), (3, None, 4)]


def test_union_never_parses_foreign_text(spark):
    numbers = spark.createDataFrame([(1, 5)], "flag int, payment_type int")
    texts = spark.createDataFrame([("N", "x")], "flag string, payment_type string")
    out = union_by_name([numbers, texts])
    assert dict(out.dtypes) == {"flag": "string", "payment_type": "int"}
    assert sorted((r.flag, r.payment_type) for r in out.collect()) == [("1", 5), ("N", None)]


def test_month_selection(spark, drifting):
    months = select_months(spark, drifting, "Yellow", "2023-02", "2023-12")
    assert list(months) == ["2023-02", "2023-04"]
    with pytest.raises(FileNotFoundError):
        select_months(spark, drifting, "green", "2023-01", "2023-12")
    with pytest.raises(FileNotFoundError):
        select_months(spark, drifting, "yellow", "2024-01", "2024-12")
    with pytest.raises(ValueError):
        select_months(spark, drifting, "yellow", "2023-13", "2023-12")


def test_taxi_types():
    assert check_taxi(" FHVHV ") == "fhvhv"
    with pytest.raises(ValueError):
        check_taxi("boat")


def test_month_frame(spark):
    months = [r.month for r in month_frame(spark, "2022-11", "2023-02").collect()]
    assert months == ["2022-11", "2022-12", "2023-01", "2023-02"]
    assert month_frame(spark, "2023-02", "2023-01").count() == 0


def write_many(spark, folder, layouts, each):
    """Folders of one file each, ``each`` of every layout, in the order of the layouts."""
    for k, schema in enumerate(layouts):
        for i in range(each):
            values = tuple(1.5 if " double" in c else i for c in schema.split(", "))
            write(spark, f"{folder}/m{k * each + i:03d}", [values], schema)


def jobs_of(spark, work):
    """How many jobs ``work`` runs."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "counted")
    before = len(tracker.getJobIdsForGroup("counted"))
    out = work()
    after = len(tracker.getJobIdsForGroup("counted"))
    spark.sparkContext.setJobGroup("", "")
    return out, after - before


def test_one_layout_is_one_group_of_the_paths_given_in_two_jobs(spark, folder):
    write_many(spark, folder, ["a int"], 40)
    groups, jobs = jobs_of(spark, lambda: schema_groups(spark, [folder]))
    assert [paths for _, paths in groups] == [[folder]] and jobs <= 2
    assert read_raw(spark, [folder]).count() == 40 == count_files(spark, groups)
    groups, jobs = jobs_of(spark, lambda: schema_groups(spark, list_files(spark, folder)))
    assert len(groups) == 1 and jobs <= 3  # one more for the listing


def test_jobs_follow_layout_changes(spark, folder):
    """Three layouts in 30 folders; the second differs from the first by a type, as does the third."""
    write_many(spark, folder, ["a int, b int", "a double, b int", "a double, b double"], 10)
    groups, jobs = jobs_of(spark, lambda: schema_groups(spark, [folder]))
    assert len(groups) == 3 and jobs <= 2 + 2 * 3 * 5  # halvings, each by listing and footers at most
    assert all("part-" not in path for _, paths in groups for path in paths)
    found = read_raw(spark, [folder]).agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    assert (found.n, found.a, found.b) == (30, 45 + 30.0, 90 + 15.0)


def test_layouts_that_mix_in_nested_folders(spark, folder):
    write(spark, f"{folder}/x", [(1,)], "v int")
    write(spark, f"{folder}/x/y", [(2.5,)], "v double")
    write(spark, f"{folder}/x/y", [(3,)], "v int")
    assert read_raw(spark, [folder]).agg(F.sum("v")).first()[0] == 6.5
    groups = schema_groups(spark, [folder])
    assert len(groups) == 2 and sorted(f for _, g in groups for f in g) == list_files(spark, folder)


def test_no_input_fails(spark, folder):
    import os

    os.makedirs(f"{folder}/empty")
    for path in (f"{folder}/none", f"{folder}/empty", f"{folder}/none-*"):
        with pytest.raises(FileNotFoundError):
            read_trips(spark, [path])


def months(spark, folder, *sizes):
    for month, n in enumerate(sizes, 1):
        write(spark, f"{folder}/yellow_tripdata_2023-{month:02d}.parquet", [(NOON, END, i) for i in range(n)],
              "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, VendorID int")


def test_per_file_sample_covers_every_file(spark, folder):
    months(spark, folder, 40, 2, 40)
    sample = samples.sample_per_file(spark, [folder], 28, with_path=True)
    assert sorted(r["count"] for r in sample.groupBy("file_path").count().collect()) == [2, 10, 10]
    assert samples.sample_trips(spark, [folder], 28).count() == 22
    first = samples.sample_per_file(spark, [f"{folder}/*"], 1)
    assert first.count() == 3 and first.columns == ["tpep_pickup_datetime", "tpep_dropoff_datetime", "VendorID"]
    assert {r.VendorID for r in first.collect()} == {0}


def test_sample_plan_does_not_grow_with_files(spark, folder):
    def scans(paths):
        plan = samples.sample_per_file(spark, paths, 28)._jdf.queryExecution().executedPlan().toString()
        return plan.count("FileScan"), plan.count("Exchange")

    months(spark, folder, *range(1, 13))
    files = list_files(spark, folder)
    assert scans(files[:1]) == scans(files) == scans([folder]) == (1, 0)


def test_sampled_rows_do_not_depend_on_splits(spark, folder):
    df = spark.range(0, 5_000, 1, 1).selectExpr("id", "cast(id as string) t")
    df.write.option("parquet.block.size", 4_096).parquet(f"{folder}/t")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found = samples.sample_per_file(spark, [f"{folder}/t"], 700)
        assert found.rdd.getNumPartitions() > 1
        assert sorted(r.id for r in found.collect()) == list(range(700))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_cap_of_trips(spark, folder):
    for i in range(6):
        rows = [(NOON, END, i), (NOON, NOON, i), (NOON, END, i), (None, END, i), (NOON, END, i)]
        write(spark, f"{folder}/f{i}.parquet", rows, "pickup_datetime timestamp, dropoff_datetime timestamp, VendorID int")
    for n in (0, 2, 3, 10, 18, 50):
        found = samples.first_trips(spark, [folder], n)
        # The first files are taken whole, the last one in part.
        assert sorted(r.vendor_id for r in found.collect()) == [k // 3 for k in range(min(n, 18))]


def test_cap_crosses_blocks_and_is_read_by_many_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(samples, "BLOCK", 100)
    rows = F.timestamp_seconds(F.col("id") * 60)
    df = spark.range(0, 3_000, 1, 3).select(
        rows.alias("pickup_datetime"), F.timestamp_seconds(F.col("id") * 60 + F.col("id") % 4).alias("dropoff_datetime")
    )
    df.write.parquet(f"{folder}/t")
    found = samples.first_trips(spark, [f"{folder}/t"], 1_234)
    assert found.count() == 1_234
    valid = [k for k in range(3_000) if k % 4][:1_234]  # files hold the rows in order
    assert [r.pickup_datetime.minute for r in found.orderBy("pickup_datetime").collect()] == [k % 60 for k in valid]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text and "Limit" not in text


def test_external_view_ends_with_its_block(spark, folder):
    write(spark, f"{folder}/o'brien", [(1,), (2,)], "v int")
    with external_view(spark, "ext_v", f"{folder}/o'brien") as df:
        assert df.count() == 2 and spark.sql("SELECT sum(v) AS s FROM ext_v").first().s == 3
        later = spark.sql("SELECT max(v) AS m FROM ext_v")
        with pytest.raises(ValueError), external_view(spark, "ext_v", folder):
            pass
    assert not spark.catalog.tableExists("ext_v") and later.first().m == 2
    with pytest.raises(ZeroDivisionError), external_view(spark, "ext_v", f"{folder}/o'brien"):
        1 / 0
    assert not spark.catalog.tableExists("ext_v")


def test_taxi_type_is_checked_and_used(spark, folder):
    from tripmill.__main__ import arguments, input_files

    for taxi in ("yellow", "green"):
        write(spark, f"{folder}/{taxi}_tripdata_2023-01.parquet", [(NOON, END)], "pickup_datetime timestamp, dropoff_datetime timestamp")
    chosen = lambda *more: input_files(spark, arguments(["ingest", "--raw", folder, "--out", "x", *more]))
    assert chosen() == [folder]
    assert ["green" in f for f in chosen("--taxi", "green")] == [True]
    with pytest.raises(SystemExit):
        chosen("--taxi", "bogus")
