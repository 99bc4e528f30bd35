import datetime as dt

from frames import NOON
from pyspark.sql import functions as F

from tripmill.operators.normalize import clean_trips, normalize_trips
from tripmill.schema import TRIPS


def raw(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_column_contract(spark):
    out = normalize_trips(raw(spark, [(NOON,)], "pickup_datetime timestamp_ntz"))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in TRIPS]


def test_each_spelling_is_found(spark):
    end = NOON + dt.timedelta(minutes=3)
    for p, d, v, pu, do in [
        ("tpep_pickup_datetime", "tpep_dropoff_datetime", "VendorID", "PULocationID", "DOLocationID"),
        ("lpep_pickup_datetime", "lpep_dropoff_datetime", "vendorid", "pu_location_id", "do_location_id"),
        ("Pickup_datetime", "dropOff_datetime", "vendorID", "PUlocationID", "DOlocationID"),
    ]:
        schema = f"{p} timestamp_ntz, {d} timestamp_ntz, {v} bigint, {pu} int, {do} double"
        row = only(clean_trips(normalize_trips(raw(spark, [(NOON, end, 2, 7, 8.0)], schema))))
        assert (row.vendor_id, row.pulocation_id, row.dolocation_id) == (2, 7, 8)
        assert row.trip_duration_min == 3.0


def test_first_non_null_spelling_wins(spark):
    late = NOON + dt.timedelta(hours=1)
    schema = "tpep_pickup_datetime timestamp, lpep_pickup_datetime timestamp"
    out = normalize_trips(raw(spark, [(None, NOON), (late, NOON)], schema))
    assert [r.pickup_hour for r in out.orderBy("pickup_hour").collect()] == [12, 13]


def test_measures_default_to_zero_and_ids_stay_null(spark):
    row = only(normalize_trips(raw(spark, [(None, None)], "passenger_count bigint, payment_type int")))
    assert row.passenger_count == row.trip_distance == row.total_amount == 0.0
    assert row.fare_amount == row.tip_amount == 0.0
    assert row.payment_type is row.vendor_id is row.pulocation_id is None


def test_bad_text_is_null_not_zero(spark):
    schema = "trip_distance string, VendorID string, pickup_datetime string"
    bad = only(normalize_trips(raw(spark, [("far", "x", "soon")], schema)))
    assert (bad.trip_distance, bad.vendor_id, bad.pickup_datetime) == (None, None, None)
    good = only(normalize_trips(raw(spark, [("1.5", "2", "2023-05-07 12:00:00")], schema)))
    assert (good.trip_distance, good.vendor_id, good.pickup_datetime) == (1.5, 2, NOON)


def test_ids_out_of_range_become_null(spark):
    out = normalize_trips(raw(spark, [(3e9, float("nan"))], "VendorID double, payment_type double"))
    assert only(out).vendor_id is None and only(out).payment_type is None


def test_date_parts(spark):
    row = only(normalize_trips(raw(spark, [(NOON,)], "tpep_pickup_datetime timestamp_ntz")))
    assert (row.pickup_date, row.pickup_hour, row.day_of_week) == (NOON.date(), 12, 1)


def test_duration_is_difference_of_whole_seconds(spark):
    start, end = NOON.replace(microsecond=900_000), NOON.replace(second=1, microsecond=100_000)
    row = only(normalize_trips(raw(spark, [(start, end)], "pickup_datetime timestamp, dropoff_datetime timestamp")))
    assert abs(row.trip_duration_min - 1 / 60) < 1e-12


def test_cleaning_drops_incomplete_and_non_positive_trips(spark):
    minute = dt.timedelta(minutes=1)
    rows = [
        (NOON, NOON + minute, 1),
        (NOON, NOON, 2),
        (NOON, NOON - minute, 3),
        (NOON, None, 4),
        (None, NOON, 5),
    ]
    schema = "pickup_datetime timestamp, dropoff_datetime timestamp, VendorID int"
    out = clean_trips(normalize_trips(raw(spark, rows, schema)))
    assert [r.vendor_id for r in out.collect()] == [1]


def test_no_pickup_column_keeps_nothing(spark):
    out = clean_trips(normalize_trips(raw(spark, [(NOON, 1)], "dropoff_datetime timestamp, VendorID int")))
    assert out.count() == 0


def test_unknown_zone_is_kept(spark):
    rows = [(NOON, NOON + dt.timedelta(minutes=1), None)]
    schema = "pickup_datetime timestamp, dropoff_datetime timestamp, PULocationID int"
    assert clean_trips(normalize_trips(raw(spark, rows, schema))).filter(F.col("pulocation_id").isNull()).count() == 1
