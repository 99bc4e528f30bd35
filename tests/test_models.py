import datetime as dt
import hashlib

import pytest
from frames import NOON, trip, trips
from pyspark.sql import functions as F

from tripmill.functions import day_label, payment_label, surrogate_key
from tripmill.functions.keys import timestamp_text
from tripmill.operators.additive import CLOCK_GRAIN, ROUTE_GRAIN, rollup, trip_measures
from tripmill.plans import models, reports, views

NEXT = NOON + dt.timedelta(days=1)


@pytest.fixture
def stg(spark):
    rows = [
        trip(),
        trip(vendor_id=2, payment_type=None, fare_amount=0.0, tip_amount=1.0),
        trip(payment_type=9, pulocation_id=None, total_amount=30.0),
        trip(pickup_date=NEXT.date(), pickup_datetime=NEXT, day_of_week=2, dolocation_id=10, trip_distance=8.0),
    ]
    return models.stg_trips(trips(spark, *rows))


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_staging_types(stg):
    types = dict(stg.dtypes)
    assert types["vendor_id"] == types["pickup_hour"] == types["payment_type"] == "bigint"
    assert types["pickup_date"] == "date" and types["total_amount"] == "double"


def test_unknown_payment_is_a_group_but_no_dimension_row(stg):
    measured = trip_measures(stg)
    aggregate = by(models.agg_payment_type(measured), "payment_type")
    assert set(aggregate) == {1, 9, None}
    assert set(by(models.dim_payment_type(measured), "payment_type")) == {1, 9}
    assert aggregate[None].tip_to_fare_ratio is None
    assert aggregate[1].tip_to_fare_ratio == pytest.approx(0.2)


def test_dim_date(stg):
    rows = by(models.dim_date(trip_measures(stg)), "date_key")
    first, second = rows[NOON.date()], rows[NEXT.date()]
    assert (first.year, first.month, first.day, first.day_of_week) == (2023, 5, 7, 1)
    assert (first.day_name, first.is_weekend) == ("Sunday", True)
    assert (second.day_name, second.is_weekend) == ("Monday", False)


def test_dim_zone_counts_both_ends(stg):
    zones = by(models.dim_zone(trip_measures(stg)), "location_id")
    assert set(zones) == {10, 20}
    ten = zones[10]
    assert (ten.total_trips_touching_zone, ten.pickup_trips, ten.dropoff_trips) == (4, 3, 1)


def test_dim_vendor(stg):
    one = by(models.dim_vendor(trip_measures(stg)), "vendor_id")[1]
    assert (one.first_seen_date, one.last_seen_date) == (NOON.date(), NEXT.date())
    assert (one.total_trips, one.total_revenue, one.avg_trip_revenue) == (3, 54.0, 18.0)


@pytest.mark.parametrize(
    "name,grain",
    [
        ("dim_date", CLOCK_GRAIN),
        ("dim_vendor", CLOCK_GRAIN),
        ("dim_payment_type", CLOCK_GRAIN),
        ("agg_payment_type", CLOCK_GRAIN),
        ("agg_hourly_traffic", CLOCK_GRAIN),
        ("dim_zone", ROUTE_GRAIN),
        ("agg_route_daily", ROUTE_GRAIN),
        ("agg_pickup_zone", ROUTE_GRAIN),
    ],
)
def test_rollups_give_the_same_tables(stg, name, grain):
    stg = stg.union(stg.limit(1).withColumns({c: F.lit(None).cast("double") for c in ("tip_amount", "total_amount")}))
    measured, build = trip_measures(stg), getattr(models, name)
    assert sorted(map(str, build(measured).collect())) == sorted(map(str, build(rollup(measured, grain)).collect()))


def test_equal_trips_are_numbered_not_dropped(spark):
    stg = models.stg_trips(trips(spark, trip(), trip(), trip(total_amount=1.0), trip(pulocation_id=None)))
    numbers = sorted((r.pulocation_id or 0, r.trip_seq, r.total_amount) for r in models.trip_seq(stg).collect())
    assert numbers == [(0, 1, 12.0), (10, 1, 1.0), (10, 2, 12.0), (10, 3, 12.0)]
    assert models.fct_trip(stg).select("event_id").distinct().count() == 4


def test_surrogate_key_text(spark):
    micros = NOON.replace(microsecond=120)
    df = spark.createDataFrame([(1, NOON, None), (1, micros, 5)], "a bigint, t timestamp, b bigint")
    keys = {r.b: r.k for r in df.select("b", surrogate_key(df, ("a", "t", "b")).alias("k")).collect()}
    texts = {None: "1-2023-05-07 12:00:00+00-_dbt_utils_surrogate_key_null_", 5: "1-2023-05-07 12:00:00.000120+00-5"}
    assert keys == {b: hashlib.md5(t.encode()).hexdigest() for b, t in texts.items()}


def test_timestamp_text_before_1970(spark):
    df = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 59, 5000),)], "t timestamp")
    assert df.select(timestamp_text(F.col("t"))).first()[0] == "1969-12-31 23:59:59.005+00"


def test_labels(spark):
    df = spark.createDataFrame([(1,), (6,), (0,), (9,), (None,)], "c bigint")
    payments = {r.c: r.n for r in df.select("c", payment_label(F.col("c")).alias("n")).collect()}
    assert payments == {1: "Credit card", 6: "Voided trip", 0: "Type 0", 9: "Type 9", None: None}
    days = {r.c: r.n for r in df.select("c", day_label(F.col("c")).alias("n")).collect()}
    assert days == {1: "Sunday", 6: "Friday", 0: "Unknown", 9: "Unknown", None: "Unknown"}


def test_kpi_span_is_inclusive(stg):
    view = views.v_kpi_daily(trip_measures(stg), NOON.date(), NOON.date())
    assert [(r.pickup_date, r.total_trips, r.avg_ticket) for r in view.collect()] == [(NOON.date(), 3, 18.0)]


def test_zone_view_keeps_unknown_zone(stg):
    measured = trip_measures(stg)
    zones = by(views.v_zone_performance(models.agg_pickup_zone(measured), models.dim_zone(measured)), "pulocation_id")
    assert zones[None].total_trips_touching_zone is None and zones[None].total_trips == 1
    assert zones[10].total_trips_touching_zone == 4


def test_scorecards_average_days_and_trips(stg):
    kpi = views.v_kpi_daily(trip_measures(stg))
    row = reports.scorecards(kpi).first()
    assert (row.total_trips, row.total_revenue) == (4, 66.0)
    assert row.avg_ticket == pytest.approx((18 + 12) / 2)
    assert row.weighted_avg_ticket == pytest.approx(66 / 4)


def test_heatmap_has_all_hours(stg):
    traffic = views.v_hourly_traffic(models.agg_hourly_traffic(trip_measures(stg)))
    table = by(reports.heatmap(traffic), "day_name")
    assert len(table["Sunday"]) == 25 and table["Sunday"].hour_12 == 3 and table["Monday"].hour_0 is None
    weekend = reports.filtered_traffic(traffic, ["Sunday"])
    assert [r.total_trips for r in weekend.collect()] == [3]


def test_route_filters(stg):
    routes = views.v_route_performance(models.agg_route_daily(trip_measures(stg)))
    count = lambda **f: reports.filtered_routes(routes, **f).count()
    assert (count(), count(start=NEXT.date()), count(end=NOON.date())) == (3, 1, 2)
    assert (count(pickup_zones=[10]), count(dropoff_zones=[10]), count(pickup_zones=[99])) == (2, 1, 0)


def test_top_zones_break_ties_by_zone(spark):
    stg = models.stg_trips(trips(spark, *[trip(pulocation_id=z) for z in (5, 3, 4)]))
    measured = trip_measures(stg)
    view = views.v_zone_performance(models.agg_pickup_zone(measured), models.dim_zone(measured))
    assert [r.pulocation_id for r in reports.top_zones(view, 2).collect()] == [3, 4]
