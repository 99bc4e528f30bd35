"""The declared checks of the warehouse and the report over them."""

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Row

from tripmill.operators.checks import (
    ERROR,
    WARN,
    key_counts,
    relationship_check,
    row_checks,
    row_counts,
    row_lines,
    unique_checks,
)
from tripmill.session import store

# What each table promises.
NOT_NULL_COLUMNS = {
    "stg_trips": (
        "pickup_datetime",
        "pickup_date",
        "pulocation_id",
        "dolocation_id",
        "total_amount",
    ),
    "dim_zone": ("location_id",),
    "dim_vendor": ("vendor_id",),
    "dim_payment_type": ("payment_type",),
    "dim_date": ("date_key",),
    "fct_trip": ("event_id", "pickup_date"),
    "agg_pickup_zone": ("pulocation_id", "total_trips"),
    "agg_payment_type": ("payment_type",),
    "agg_hourly_traffic": ("pickup_hour", "day_of_week"),
    "agg_route_daily": ("pickup_date",),
}
UNIQUE_COLUMNS = {
    "dim_zone": "location_id",
    "dim_vendor": "vendor_id",
    "dim_payment_type": "payment_type",
    "dim_date": "date_key",
    "fct_trip": "event_id",
    "agg_payment_type": "payment_type",
}
PARENTS = {
    ("fct_trip", "pulocation_id"): ("dim_zone", "location_id"),
    ("fct_trip", "vendor_id"): ("dim_vendor", "vendor_id"),
}
TRIP_RULES = (
    ("trip_duration_min > 0", ERROR),
    ("trip_distance >= 0", ERROR),
    ("fare_amount >= 0", WARN),
    ("tip_amount >= 0", WARN),
    ("total_amount >= 0", WARN),
)
RULES = {"fct_trip": TRIP_RULES}

Tables = Mapping[str, DataFrame]


class CheckFailure(Exception):
    """Raised when checks of severity ``error`` have failures."""


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def not_null_report(tables: Tables) -> DataFrame:
    return _union([row_checks(tables[m], m, not_null=c) for m, c in NOT_NULL_COLUMNS.items()])


def unique_report(tables: Tables) -> DataFrame:
    return unique_checks([(tables[m], m, column) for m, column in UNIQUE_COLUMNS.items()])


def expression_report(tables: Tables) -> DataFrame:
    return _union([row_checks(tables[m], m, expressions=rules) for m, rules in RULES.items()])


def fact_keys(tables: Tables) -> DataFrame:
    """Rows per combination of the fact's foreign keys: one scan for all of them."""
    return key_counts(tables["fct_trip"], [column for _, column in PARENTS])


def relationship_report(tables: Tables, column: str, counts: DataFrame | None = None) -> DataFrame:
    """Line of the fact's foreign key ``column``."""
    parent, parent_column = PARENTS["fct_trip", column]
    counts = fact_keys(tables) if counts is None else counts
    return relationship_check(counts, "fct_trip", column, tables[parent], parent_column)


def quality_report(tables: Tables) -> DataFrame:
    """Every declared check as one line.

    The fact is scanned once for its null checks, rules and foreign keys together: their counts per
    combination of foreign keys are written down, and all lines come from those few rows. It is
    scanned once more for the hashes of its key, and again only where hashes repeat.
    """
    declared = {m: (columns, RULES.get(m, ())) for m, columns in NOT_NULL_COLUMNS.items()}
    fact = tables["fct_trip"]
    counts = key_counts(fact, [c for _, c in PARENTS], *row_counts(*declared["fct_trip"]))
    with ThreadPoolExecutor(2) as pool:  # two scans side by side
        unique = pool.submit(unique_report, tables)
        profile = store(counts, "fact-profile")
    parts = [row_checks(tables[m], m, *checks) for m, checks in declared.items() if m != "fct_trip"]
    parts.append(row_lines(profile, "fct_trip", *declared["fct_trip"]))
    parts.append(unique.result())
    parts += [relationship_report(tables, column, profile) for _, column in PARENTS]
    return _union(parts)


def enforce(lines: Iterable[Row]) -> None:
    """Raise if a check of severity ``error`` failed. Takes the collected report: a line a check."""
    failed = [r for r in lines if r.status == ERROR]
    if failed:
        texts = [f"{r.model}.{r.target} {r.check_name}: {r.failing_rows}" for r in failed]
        raise CheckFailure("; ".join(sorted(texts)))
