import pytest
from frames import NOON, trip, trips

from tripmill.plans.build import STORED, build, reopen
from tripmill.plans.catalog import publish
from tripmill.plans.views import VIEWS

SPAN = (NOON.date(), NOON.date())


def contents(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def database(spark):
    yield "prod"
    spark.sql("DROP DATABASE IF EXISTS prod CASCADE")


def test_catalog_tables_and_views_equal_those_of_the_session(spark, folder, database):
    rows = [trip(), trip(payment_type=None), trip(payment_type=0, pulocation_id=None, tip_amount=7.0)]
    house = build(spark, trips(spark, *rows), folder, *SPAN)
    for _ in range(2):  # publishing again replaces the declarations
        publish(house, database, *SPAN)
    for name in (*STORED, *VIEWS):
        published = spark.table(f"prod.{name}")
        assert contents(published) == contents(house[name]), name


def test_a_table_that_owns_its_files_is_not_dropped(spark, folder, database):
    house = build(spark, trips(spark, trip()), folder, *SPAN)
    spark.sql("CREATE DATABASE prod")
    house["fct_trip"].write.saveAsTable("prod.fct_trip")
    with pytest.raises(ValueError, match="managed"):
        publish(house, database, *SPAN)
    assert spark.table("prod.fct_trip").count() == 1


def test_no_trips_can_be_built_and_reopened(spark, folder):
    none = trips(spark, trip()).limit(0)
    house = build(spark, none, folder, *SPAN)
    again = reopen(spark, none, folder, *SPAN)
    for name in (*STORED, *VIEWS):
        assert house[name].count() == 0 and again[name].columns == house[name].columns
    assert house["fct_trip"].columns[:2] == ["event_id", "vendor_id"]
