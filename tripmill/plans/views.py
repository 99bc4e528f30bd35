"""Dashboard views over the models: one SQL text each, for frames, the session and the catalog."""

import datetime as dt

from pyspark.sql import DataFrame

from tripmill.plans.models import SERVING_ORDER
from tripmill.schema import DAY_NAMES, OTHER_PAYMENT_PREFIX, PAYMENT_NAMES, UNKNOWN_DAY

# The span the dashboards show unless told otherwise.
DEFAULT_START = dt.date(2023, 1, 1)
DEFAULT_END = dt.date(2023, 12, 31)


def _label(names: dict[int, str], code: str, otherwise: str) -> str:
    entries = ", ".join(f"{number}, '{name}'" for number, name in names.items())
    return f"coalesce(map({entries})[int({code})], {otherwise})"


def _mean(measure: str) -> str:
    return f"try_divide(sum({measure}_sum), sum({measure}_known))"


DAY = _label(DAY_NAMES, "day_of_week", f"'{UNKNOWN_DAY}'")
PAYMENT = _label(PAYMENT_NAMES, "payment_type", f"'{OTHER_PAYMENT_PREFIX}' || string(payment_type)")

# Names in braces stand for the tables a view reads.
VIEWS = {
    "v_kpi_daily": f"""
        SELECT pickup_date, sum(trips) AS total_trips, sum(total_amount_sum) AS total_revenue,
          {_mean("total_amount")} AS avg_ticket,
          {_mean("trip_duration_min")} AS avg_trip_duration_min,
          {_mean("trip_distance")} AS avg_trip_distance
        FROM {{rollup_route}}
        WHERE pickup_date >= DATE '{{start}}' AND pickup_date <= DATE '{{end}}'
        GROUP BY pickup_date
        ORDER BY pickup_date""",
    "v_hourly_traffic": f"""
        SELECT day_of_week, {DAY} AS day_name, pickup_hour, total_trips, avg_trip_duration_min,
          avg_trip_distance, total_revenue
        FROM {{agg_hourly_traffic}}""",
    "v_payment_performance": f"""
        SELECT payment_type, {PAYMENT} AS payment_type_name, total_trips, total_revenue,
          avg_total_amount, avg_tip_amount, tip_to_fare_ratio
        FROM {{agg_payment_type}}""",
    # Both sides are one row per zone; zones without any touch stay.
    "v_zone_performance": """
        SELECT perf.pulocation_id, zone.total_trips_touching_zone, zone.pickup_trips,
          zone.dropoff_trips, perf.total_trips, perf.avg_trip_distance, perf.avg_total_amount,
          perf.total_revenue
        FROM {agg_pickup_zone} perf
        LEFT JOIN {dim_zone} zone ON zone.location_id = perf.pulocation_id""",
    "v_route_performance": """
        SELECT pickup_date, pulocation_id, dolocation_id, total_trips, total_revenue,
          avg_total_amount, avg_trip_duration_min
        FROM {agg_route_daily}""",
}
# The aggregates in the order in which they are shown.
SERVED = {f"served_{name}": name for name in SERVING_ORDER}
VIEWS |= {view: f"SELECT * FROM {{{name}}} ORDER BY {SERVING_ORDER[name]}" for view, name in SERVED.items()}
READS = {
    "v_kpi_daily": ("rollup_route",),
    "v_hourly_traffic": ("agg_hourly_traffic",),
    "v_payment_performance": ("agg_payment_type",),
    "v_zone_performance": ("agg_pickup_zone", "dim_zone"),
    "v_route_performance": ("agg_route_daily",),
    **{view: (name,) for view, name in SERVED.items()},
}


def view_sql(name: str, prefix: str, start: dt.date = DEFAULT_START, end: dt.date = DEFAULT_END) -> str:
    """The view as SQL over tables ``prefix`` + name."""
    return VIEWS[name].format(start=start, end=end, **{table: prefix + table for table in READS[name]})


def _over(name: str, **values) -> DataFrame:
    frame = next(v for v in values.values() if isinstance(v, DataFrame))
    spans = {k: v for k, v in values.items() if not isinstance(v, DataFrame)}
    text = VIEWS[name]
    for word, value in spans.items():
        text = text.replace("{" + word + "}", str(value))
    return frame.sparkSession.sql(text, **{k: v for k, v in values.items() if k not in spans})


def v_kpi_daily(measured: DataFrame, start: dt.date = DEFAULT_START, end: dt.date = DEFAULT_END) -> DataFrame:
    """Key figures per day of an inclusive span, in order. On a day-partitioned table the span prunes."""
    return _over("v_kpi_daily", rollup_route=measured, start=start, end=end)


def v_hourly_traffic(agg_hourly_traffic: DataFrame) -> DataFrame:
    """Hourly traffic with weekday names."""
    return _over("v_hourly_traffic", agg_hourly_traffic=agg_hourly_traffic)


def v_payment_performance(agg_payment_type: DataFrame) -> DataFrame:
    """Payment performance with payment names."""
    return _over("v_payment_performance", agg_payment_type=agg_payment_type)


def v_zone_performance(agg_pickup_zone: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Pickup-zone performance beside the zone's touches.

    Adaptive execution broadcasts the dimension if it measures small enough, and joins by shuffle
    if not.
    """
    return _over("v_zone_performance", agg_pickup_zone=agg_pickup_zone, dim_zone=dim_zone)


def v_route_performance(agg_route_daily: DataFrame) -> DataFrame:
    """Routes per day, as the dashboards read them."""
    return _over("v_route_performance", agg_route_daily=agg_route_daily)
