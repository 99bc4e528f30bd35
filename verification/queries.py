"""One query per operator, over whole tables.

Sums of floating numbers depend on the order of addition, so money and averages are rounded here;
the library itself never rounds.
"""

import datetime as dt
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions import safe_ratio, surrogate_key
from tripmill.operators.additive import CLOCK_GRAIN, ROUTE_GRAIN, rollup, trip_measures
from tripmill.operators.checks import relationship_counts
from tripmill.operators.numbering import number_rows
from tripmill.operators.normalize import (
    clean_trips,
    default_fill,
    derive_date_parts,
    normalize_trips,
)
from tripmill.plans import models, quality, reports, views
from tripmill.plans.models import serve
from tripmill.schema import TRIP_KEY, TRIPS, staged
from tripmill.session import configure, scratch_folder
from tripmill.sinks.backfill import backfill, create_table
from tripmill.sinks.tables import listed_partitions, read_table, save_by_day, write_by_day, write_files
from tripmill.sources.derived import raw_trips
from tripmill.sources.files import external_view, list_files, read_raw, read_trips, scan
from tripmill.sources.months import month_frame, select_months
from tripmill.sources.samples import first_trips, rows_per_file, sample_per_file
from verification.staging import PATTERN, TAXI, built_warehouse, staged_months

Query = Callable[[SparkSession, str], DataFrame]

# The test tables lie inside this span; it stands in for the dashboards' default year.
START, END = dt.date(1995, 1, 1), dt.date(2001, 12, 31)
FIRST_MONTH, LAST_MONTH = "1994-11", "2001-12"
SAMPLE_ROWS = 4_000
CAP_ROWS = 1_000

# Decimals kept. Averages often lie exactly between two rounded values, where the last bit of a
# sum would decide; a fixed small offset, the same in the SQL, moves them off that edge.
SUMS = {"total_revenue": 2, "tip_to_fare_ratio": 10}
AVERAGES = {
    "avg_trip_revenue": 4,
    "avg_total_amount": 4,
    "avg_tip_amount": 4,
    "avg_ticket": 4,
    "weighted_avg_ticket": 4,
    "avg_trip_duration_min": 6,
    "weighted_avg_trip_duration_min": 6,
    "avg_trip_distance": 6,
}
OFFSETS = {4: 3.3e-6, 6: 3.3e-8}


def rounded(df: DataFrame) -> DataFrame:
    def shown(name: str) -> Column:
        if name in AVERAGES:
            scale = AVERAGES[name]
            return F.round(F.col(name) + OFFSETS[scale], scale).alias(name)
        return F.round(name, SUMS[name]).alias(name) if name in SUMS else F.col(name)

    return df.select([shown(name) for name in df.columns])


# --- shared inputs -----------------------------------------------------------------------------


def trips(spark: SparkSession, sf_dir: str, coarse: bool = False) -> DataFrame:
    return clean_trips(normalize_trips(raw_trips(spark, sf_dir, coarse)))


def stg(spark: SparkSession, sf_dir: str, coarse: bool = False) -> DataFrame:
    return models.stg_trips(trips(spark, sf_dir, coarse))


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged trips with additive measures. The fact has the same rows, so it is not numbered."""
    return trip_measures(stg(spark, sf_dir))


def months_root(spark: SparkSession, sf_dir: str) -> list[str]:
    """The folder of the monthly files, which their readers take as it is."""
    return [staged_months(configure(spark), sf_dir)]


def month_of(path: str) -> Column:
    return F.regexp_extract(path, r"tripdata=(\d{4}-\d{2})", 1)


# --- sources and cleaning ----------------------------------------------------------------------


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = scan(spark, f"{sf_dir}/lineitem.parquet")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("l_quantity"), 2).alias("sum_quantity")
    )


def scan_multi_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_trips(spark, months_root(spark, sf_dir))
    return found.groupBy(F.date_format("pickup_datetime", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.sum("total_amount"), 2).alias("total_amount"),
        F.sum("pulocation_id").alias("sum_pickup_zone"),
        F.sum("passenger_count").alias("sum_passengers"),
    )


def union_by_name_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_raw(spark, months_root(spark, sf_dir), with_place=True)
    return raw.groupBy(month_of("file_path").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("tpep_pickup_datetime").alias("tpep_pickups"),
        F.count("lpep_pickup_datetime").alias("lpep_pickups"),
        F.sum("passenger_count").alias("sum_passengers"),
        F.sum("payment_type").alias("sum_payment_type"),
        F.round(F.sum("airport_fee"), 2).alias("sum_airport_fee"),
        F.round(F.sum("congestion_surcharge"), 2).alias("sum_surcharge"),
    )


def month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of a range, which of them have files, and the raw rows of those."""
    root = staged_months(configure(spark), sf_dir)
    chosen = select_months(spark, root, TAXI, FIRST_MONTH, LAST_MONTH, PATTERN)
    raw = read_raw(spark, sum(chosen.values(), []), with_place=True)
    counts = raw.groupBy(month_of("file_path").alias("month")).agg(F.count(F.lit(1)).alias("rows"))
    return (
        month_frame(spark, FIRST_MONTH, LAST_MONTH)
        .join(counts, "month", "left")
        .select("month", F.col("rows").isNotNull().alias("has_file"), "rows")
    )


def external_view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables read by SQL through views that are gone when the query is made."""
    lines, orders = f"{sf_dir}/lineitem.parquet", f"{sf_dir}/orders.parquet"
    with external_view(spark, "ext_lineitem", lines), external_view(spark, "ext_orders", orders):
        return spark.sql(
            """
            SELECT o_orderpriority, count(*) AS rows, round(sum(l_extendedprice), 2) AS total_price
            FROM ext_lineitem JOIN ext_orders ON l_orderkey = o_orderkey
            GROUP BY o_orderpriority
            """
        )


def normalize_trips_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_trips(raw_trips(spark, sf_dir))


def derive_date_parts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = scan(configure(spark), f"{sf_dir}/events.parquet")
    stamped = events.select("event_id", F.to_timestamp("ts").alias("pickup_datetime"))
    return derive_date_parts(stamped)


def trip_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = normalize_trips(raw_trips(spark, sf_dir))
    minutes = F.col("trip_duration_min")
    return found.groupBy(F.signum(minutes).cast("int").alias("sign")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.min(minutes), 9).alias("shortest"),
        F.round(F.max(minutes), 9).alias("longest"),
        F.round(F.sum(minutes), 2).alias("sum_minutes"),
    )


def default_fill_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_trips(spark, sf_dir)
    filled = raw.select(
        F.col("passenger_count").isNull().alias("was_missing"),
        default_fill(raw, "passenger_count").alias("passenger_count"),
        default_fill(raw.drop("tip_amount"), "tip_amount").alias("absent_tip"),
    )
    return filled.groupBy("was_missing", "passenger_count", "absent_tip").agg(F.count(F.lit(1)).alias("rows"))


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted while writing beside rows found in the written files."""
    folder = scratch_folder(spark, "row-count")
    written = write_files(trips(spark, sf_dir), folder)
    stored = read_table(spark, folder, TRIPS).agg(F.count(F.lit(1)).alias("stored_rows"))
    return stored.select(F.lit(written).cast("bigint").alias("written_rows"), "stored_rows")


def sample_per_file_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows sampled from each month, whose folder holds one or more files."""
    root = months_root(spark, sf_dir)
    sample = sample_per_file(spark, root, SAMPLE_ROWS, with_path=True)
    share = F.lit(rows_per_file(SAMPLE_ROWS, len(list_files(spark, *root)))).cast("bigint")
    per_file = sample.groupBy("file_path").agg(F.count(F.lit(1)).alias("rows"))
    return per_file.groupBy(month_of("file_path").alias("month")).agg(
        F.max("rows").alias("rows_per_file"), F.first(share).alias("share")
    )


def limit_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many trips of each month a cap takes, which goes by the order of files."""
    sample = first_trips(spark, months_root(spark, sf_dir), CAP_ROWS)
    valid = (F.col("trip_duration_min") > 0) & F.col("pickup_date").isNotNull()
    return sample.groupBy(F.date_format("pickup_datetime", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~valid).alias("invalid_rows")
    )


# --- dimensions and fact -----------------------------------------------------------------------


def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    touches = models.zone_touches(measured(spark, sf_dir))
    return touches.groupBy("zone_role", "location_id").agg(F.count(F.lit(1)).alias("touches"))


def trip_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.trip_seq(stg(spark, sf_dir, coarse=True))


def trip_seq_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a third of all trips under one key."""
    frame = stg(spark, sf_dir, coarse=True)
    hot = F.col("passenger_count") <= 2
    keys = {name: F.when(~hot, F.col(name)).alias(name) for name in TRIP_KEY}
    return models.trip_seq(frame.select([keys.get(name, F.col(name)) for name in frame.columns]))


def surrogate_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of events, whose times have microseconds."""
    events = scan(configure(spark), f"{sf_dir}/events.parquet")
    events = events.withColumn("ts", F.to_timestamp("ts"))
    events = events.withColumn("user_id", F.when(F.col("event_type") != "click", F.col("user_id")))
    key = surrogate_key(events, ("event_id", "ts", "user_id", "event_type"))
    return events.select("event_id", key.alias("event_key"))


def fct_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.fct_trip(stg(spark, sf_dir, coarse=True))


# --- aggregates and views ----------------------------------------------------------------------


def model(name: str) -> Query:
    """A dimension or aggregate straight from trips, in serving order."""
    return lambda spark, sf_dir: rounded(serve(name, getattr(models, name)(measured(spark, sf_dir))))


def rolled_up(name: str, grain: tuple[str, ...]) -> Query:
    """The same through a rollup, as the build does it."""
    return lambda spark, sf_dir: rounded(
        serve(name, getattr(models, name)(rollup(measured(spark, sf_dir), grain)))
    )


def safe_ratio_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net refunds over a sum that is zero for some groups."""
    found = stg(spark, sf_dir)
    zero_some = F.sum(F.when(F.col("payment_type") >= 3, F.col("fare_amount")).otherwise(0.0))
    return found.groupBy("payment_type").agg(
        F.round(safe_ratio(F.sum("tip_amount"), zero_some), 10).alias("ratio")
    )


def kpi_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.v_kpi_daily(measured(spark, sf_dir), START, END)


def hourly_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.v_hourly_traffic(models.agg_hourly_traffic(measured(spark, sf_dir)))


def payment_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.v_payment_performance(models.agg_payment_type(measured(spark, sf_dir)))


def zone_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Each side combines its trips to a row a zone and task before it shuffles.
    found = measured(spark, sf_dir)
    return views.v_zone_performance(models.agg_pickup_zone(found), models.dim_zone(found))


def route_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.v_route_performance(models.agg_route_daily(measured(spark, sf_dir)))


def over(view: Query, name: str = "", report: Callable[..., DataFrame] | None = None, **options) -> Query:
    """A view, or a report over one, rounded."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = view(spark, sf_dir)
        return rounded(serve(name, df) if report is None else report(df, **options))

    return query


def built(name: str) -> Query:
    """A table or view of the finished build."""
    return lambda spark, sf_dir: rounded(serve(name, tables(spark, sf_dir)[name]))


# --- quality -----------------------------------------------------------------------------------


def tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The stored tables of a finished build, as checks run after it."""
    return built_warehouse(configure(spark), sf_dir).tables


# Trips from this day on were loaded after the dimensions had been built.
LATE = "pickup_date >= DATE'1998-01-01'"


def late_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The stored tables with a fact newer than its dimensions: late trips bring a vendor and zones
    that these do not have."""
    checked = tables(spark, sf_dir)
    late = checked["fct_trip"].withColumns(
        {
            "vendor_id": F.expr(f"CASE WHEN {LATE} AND pickup_hour % 11 = 0 THEN 9 ELSE vendor_id END"),
            "pulocation_id": F.expr(f"CASE WHEN {LATE} AND pulocation_id % 13 = 0 THEN pulocation_id + 1000 ELSE pulocation_id END"),
        }
    )
    return {**checked, "fct_trip": late}


def relationships(column: str) -> Query:
    """Orphans of a foreign key beside the rows that were checked."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        checked = late_tables(spark, sf_dir)
        parent, parent_column = quality.PARENTS["fct_trip", column]
        return relationship_counts(quality.fact_keys(checked), column, checked[parent], parent_column)

    return query


# --- sinks -------------------------------------------------------------------------------------


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "roundtrip")
    write_files(trips(spark, sf_dir), folder)
    return read_table(spark, folder, TRIPS)


def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "by-day")
    write_by_day(stg(spark, sf_dir), folder)
    return read_table(spark, folder, staged())


def backfill_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = staged_months(configure(spark), sf_dir)
    months = select_months(spark, root, TAXI, FIRST_MONTH, LAST_MONTH, PATTERN)
    return backfill(spark, months, scratch_folder(spark, "backfill"), at_a_time=8)


def table_name(purpose: str) -> str:
    """A catalog table of its own for every run."""
    return f"{purpose}_{uuid.uuid4().hex}"


def catalog_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips saved as a day-partitioned catalog table: rows per day, beside the catalog's own days."""
    name = table_name("trips_by_day")
    save_by_day(stg(spark, sf_dir), name, scratch_folder(spark, "catalog-by-day"))
    listed = listed_partitions(spark, name).select(F.to_date("pickup_date").alias("pickup_date"), F.lit(1).alias("listed"))
    days = spark.table(name).groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("total_amount"), 2).alias("total_revenue")
    )
    return days.join(listed, "pickup_date", "full").select("pickup_date", "rows", "total_revenue", "listed")


def catalog_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfilled catalog table after a second, fresh backfill without its first year: days that
    the catalog knows and rows that it finds, by month."""
    root, name = staged_months(configure(spark), sf_dir), table_name("trips_by_month")
    folder = scratch_folder(spark, "catalog-months")
    for first in ("1996-11", "1997-01"):
        months = select_months(spark, root, TAXI, first, "1997-03", PATTERN)
        backfill(spark, months, folder, at_a_time=8)
        create_table(spark, name, folder, list(months))
    listed = listed_partitions(spark, name).groupBy("source_month").agg(F.count(F.lit(1)).alias("days"))
    rows = spark.table(name).groupBy("source_month").agg(F.count(F.lit(1)).alias("rows"))
    return listed.join(rows, "source_month", "full").select("source_month", "days", "rows")


# --- served order ------------------------------------------------------------------------------


def positioned(df: DataFrame) -> DataFrame:
    """Rows with their place in the order in which they are served, numbered in Spark."""
    placed = df.withColumns({"_all": F.lit(1), "_place": F.monotonically_increasing_id()})
    return number_rows(placed, ["_all"], ["_place"], "position").drop("_all", "_place")


def served(name: str, columns: tuple[str, ...]) -> Query:
    """The keys of a served table of the build, with their position."""
    return lambda spark, sf_dir: positioned(tables(spark, sf_dir)[name]).select(*columns, "position")


def served_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positioned(kpi_daily(spark, sf_dir)).select("pickup_date", "position")


def served_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = reports.filtered_routes(
        route_performance(spark, sf_dir), dt.date(1996, 1, 1), dt.date(2000, 12, 31), range(1, 132), range(1, 61)
    )
    return positioned(routes).select("pickup_date", "pulocation_id", "dolocation_id", "position")


QUERIES: dict[str, Query] = {
    "scan_parquet": scan_parquet,
    "scan_multi_file": scan_multi_file,
    "union_by_name_drift": union_by_name_drift,
    "month_range": month_range,
    "external_view": external_view_query,
    "normalize_trips": normalize_trips_query,
    "derive_date_parts": derive_date_parts_query,
    "trip_duration": trip_duration,
    "default_fill": default_fill_query,
    "clean_trips": trips,
    "stg_trips": stg,
    "row_count": row_count,
    "sample_per_file": sample_per_file_query,
    "limit_rows": limit_rows_query,
    "dim_date": model("dim_date"),
    "dim_zone": model("dim_zone"),
    "union_all": union_all,
    "dim_vendor": model("dim_vendor"),
    "dim_payment_type": model("dim_payment_type"),
    "trip_seq": trip_seq,
    "trip_seq_hot": trip_seq_hot,
    "surrogate_key": surrogate_key_query,
    "fct_trip": fct_trip,
    "agg_payment_type": model("agg_payment_type"),
    "safe_ratio": safe_ratio_query,
    "agg_route_daily": model("agg_route_daily"),
    "agg_pickup_zone": model("agg_pickup_zone"),
    "agg_hourly_traffic": model("agg_hourly_traffic"),
    "dim_vendor_rollup": rolled_up("dim_vendor", CLOCK_GRAIN),
    "dim_zone_rollup": rolled_up("dim_zone", ROUTE_GRAIN),
    "agg_payment_type_rollup": rolled_up("agg_payment_type", CLOCK_GRAIN),
    "built_fct_trip": lambda spark, sf_dir: tables(spark, sf_dir)["fct_trip"],
    "built_dim_date": built("dim_date"),
    "built_dim_payment_type": built("dim_payment_type"),
    "built_agg_route_daily": built("agg_route_daily"),
    "built_v_hourly_traffic": built("v_hourly_traffic"),
    "built_v_zone_performance": built("v_zone_performance"),
    "v_kpi_daily": over(kpi_daily, "v_kpi_daily"),
    "v_hourly_traffic": over(hourly_traffic),
    "v_payment_performance": over(payment_performance),
    "v_zone_performance": over(zone_performance),
    "v_route_performance": over(route_performance),
    "report_scorecards": over(kpi_daily, report=reports.scorecards),
    "report_monthly": over(kpi_daily, report=reports.monthly),
    "report_heatmap": over(hourly_traffic, report=reports.heatmap),
    "report_by_hour": over(hourly_traffic, report=reports.by_hour),
    "report_payment": over(payment_performance, report=reports.payments),
    "report_top_zones": over(zone_performance, report=reports.top_zones),
    "report_filtered_routes": over(
        route_performance,
        report=reports.filtered_routes,
        start=dt.date(1996, 1, 1),
        end=dt.date(2000, 12, 31),
        pickup_zones=range(1, 132),
        dropoff_zones=range(1, 61),
    ),
    "report_filtered_traffic": over(
        hourly_traffic, report=reports.filtered_traffic, day_names=("Saturday", "Sunday")
    ),
    "dq_not_null": lambda spark, sf_dir: quality.not_null_report(tables(spark, sf_dir)),
    "dq_unique": lambda spark, sf_dir: quality.unique_report(tables(spark, sf_dir)),
    "dq_relationships_zone": relationships("pulocation_id"),
    "dq_relationships_vendor": relationships("vendor_id"),
    "dq_expression": lambda spark, sf_dir: quality.expression_report(tables(spark, sf_dir)),
    "dq_report": lambda spark, sf_dir: quality.quality_report(tables(spark, sf_dir)),
    "dq_report_late": lambda spark, sf_dir: quality.quality_report(late_tables(spark, sf_dir)),
    "sink_roundtrip": sink_roundtrip,
    "sink_partitioned": sink_partitioned,
    "backfill_months": backfill_months,
    "catalog_by_day": catalog_by_day,
    "catalog_months": catalog_months,
    "served_agg_payment_type": served("served_agg_payment_type", ("payment_type",)),
    "served_agg_route_daily": served("served_agg_route_daily", ("pickup_date", "pulocation_id", "dolocation_id")),
    "served_agg_pickup_zone": served("served_agg_pickup_zone", ("pulocation_id",)),
    "served_agg_hourly_traffic": lambda spark, sf_dir: positioned(
        serve("agg_hourly_traffic", tables(spark, sf_dir)["agg_hourly_traffic"])
    ).select("day_of_week", "pickup_hour", "position"),
    "served_v_kpi_daily": served_kpi,
    "served_report_filtered_routes": served_routes,
}
