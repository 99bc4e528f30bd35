"""SQL for DuckDB that states what each query must return."""

# --- shared fragments --------------------------------------------------------------------------


def raw_cte(coarse: bool = False) -> str:
    """``raw``: trips in raw layout, one per order line."""
    zones = 5 if coarse else 263
    offset = (
        "to_hours(l_linenumber % 3 + 6)"
        if coarse
        else "to_hours(l_partkey % 24) + to_minutes(l_linenumber)"
    )
    return f"""
    lines AS (
      SELECT *, o_orderdate + {offset} AS pickup
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    ),
    raw AS (
      SELECT
        l_suppkey % 4 + 1 AS VendorID,
        pickup AS tpep_pickup_datetime,
        CASE WHEN l_suppkey % 37 <> 0
          THEN pickup + to_minutes((l_partkey * 7 + l_suppkey) % 90 - 10) + to_seconds(l_quantity)
        END AS tpep_dropoff_datetime,
        CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS DOUBLE) END AS passenger_count,
        l_quantity AS trip_distance,
        CASE WHEN l_partkey % 101 <> 0 THEN l_partkey % {zones} + 1 END AS PULocationID,
        l_suppkey % {zones} + 1 AS DOLocationID,
        CAST(l_linenumber - 1 AS BIGINT) AS payment_type,
        CASE WHEN l_returnflag = 'R' AND l_linenumber = 6 THEN -l_extendedprice ELSE l_extendedprice END
          AS fare_amount,
        l_tax * 100 AS tip_amount,
        l_extendedprice + l_tax * 100 AS total_amount
      FROM lines
    )"""


NORMAL = """
    normal AS (
      SELECT
        CAST(VendorID AS INTEGER) AS vendor_id,
        tpep_pickup_datetime AS pickup_datetime,
        tpep_dropoff_datetime AS dropoff_datetime,
        CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
        CAST(extract(hour FROM tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
        CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS day_of_week,
        coalesce(passenger_count, 0.0) AS passenger_count,
        coalesce(trip_distance, 0.0) AS trip_distance,
        CAST(PULocationID AS INTEGER) AS pulocation_id,
        CAST(DOLocationID AS INTEGER) AS dolocation_id,
        CAST(payment_type AS INTEGER) AS payment_type,
        coalesce(fare_amount, 0.0) AS fare_amount,
        coalesce(tip_amount, 0.0) AS tip_amount,
        coalesce(total_amount, 0.0) AS total_amount,
        CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE) / 60.0
          AS trip_duration_min
      FROM raw
    )"""

TRIPS = """
    trips AS (
      SELECT * FROM normal
      WHERE pickup_date IS NOT NULL AND dropoff_datetime IS NOT NULL AND trip_duration_min > 0
    )"""

STG = """
    stg AS (
      SELECT * REPLACE (
        CAST(vendor_id AS BIGINT) AS vendor_id, CAST(pickup_hour AS BIGINT) AS pickup_hour,
        CAST(day_of_week AS BIGINT) AS day_of_week, CAST(pulocation_id AS BIGINT) AS pulocation_id,
        CAST(dolocation_id AS BIGINT) AS dolocation_id, CAST(payment_type AS BIGINT) AS payment_type)
      FROM trips
    )"""

SEQ = """
    seq AS (
      SELECT *, CAST(row_number() OVER (
        PARTITION BY vendor_id, pickup_datetime, pulocation_id, dolocation_id
        ORDER BY dropoff_datetime NULLS FIRST, total_amount NULLS FIRST, fare_amount NULLS FIRST,
          tip_amount NULLS FIRST, trip_distance NULLS FIRST, passenger_count NULLS FIRST,
          payment_type NULLS FIRST) AS INTEGER) AS trip_seq
      FROM stg
    )"""

# The same with a third of all trips under one key, of nulls; ties by the remaining columns.
HOT = """
    hot AS (
      SELECT * REPLACE (
        CASE WHEN passenger_count > 2 THEN vendor_id END AS vendor_id,
        CASE WHEN passenger_count > 2 THEN pickup_datetime END AS pickup_datetime,
        CASE WHEN passenger_count > 2 THEN pulocation_id END AS pulocation_id,
        CASE WHEN passenger_count > 2 THEN dolocation_id END AS dolocation_id)
      FROM stg
    )"""
HOT_SEQ = SEQ.replace("seq AS", "hot_seq AS").replace("FROM stg", "FROM hot").replace(
    "payment_type NULLS FIRST)", "payment_type NULLS FIRST, pickup_date, pickup_hour, day_of_week, trip_duration_min)"
)

NULL_KEY = "'_dbt_utils_surrogate_key_null_'"


def stamp(ts: str) -> str:
    """Timestamp text with 0, 3 or 6 fraction digits."""
    return f"""(strftime({ts}, '%Y-%m-%d %H:%M:%S') || CASE
        WHEN microsecond({ts}) % 1000000 = 0 THEN ''
        WHEN microsecond({ts}) % 1000 = 0 THEN strftime({ts}, '.%g')
        ELSE strftime({ts}, '.%f') END || '+00')"""


def md5_key(*texts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce({t}, {NULL_KEY})" for t in texts) + ")"


TRIP_KEY = md5_key(
    "CAST(vendor_id AS VARCHAR)",
    stamp("pickup_datetime"),
    "CAST(pulocation_id AS VARCHAR)",
    "CAST(dolocation_id AS VARCHAR)",
    "CAST(trip_seq AS VARCHAR)",
)
FACT = f"fact AS (SELECT {TRIP_KEY} AS event_id, * EXCLUDE (trip_seq) FROM seq)"


def over(select: str, *more: str, coarse: bool = False) -> str:
    """``select`` over the trip fragments and any further ones."""
    return "WITH " + ",".join([raw_cte(coarse), NORMAL, TRIPS, STG, *more]) + "\n" + select


# Averages are moved off rounding edges by a fixed offset, as in the queries.
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
SUMS = {"total_revenue": 2, "tip_to_fare_ratio": 10}
OFFSETS = {4: "3.3e-6", 6: "3.3e-8"}


def shown(value: str, name: str) -> str:
    if name in SUMS:
        return f"round({value}, {SUMS[name]}) AS {name}"
    scale = AVERAGES[name]
    return f"round({value} + {OFFSETS[scale]}, {scale}) AS {name}"


def mean(column: str, name: str) -> str:
    return shown(f"avg({column})", name)


REVENUE = "round(sum(total_amount), 2) AS total_revenue"
COUNT = "count(*) AS total_trips"

# --- dimensions --------------------------------------------------------------------------------

DIM_DATE = """
    SELECT date_key,
      CAST(extract(year FROM date_key) AS BIGINT) AS year,
      CAST(extract(month FROM date_key) AS BIGINT) AS month,
      CAST(extract(day FROM date_key) AS BIGINT) AS day,
      CAST(dayofweek(date_key) + 1 AS BIGINT) AS day_of_week,
      dayname(date_key) AS day_name,
      dayofweek(date_key) IN (0, 6) AS is_weekend
    FROM (SELECT DISTINCT pickup_date AS date_key FROM stg)"""

TOUCHES = """
    touches AS (
      SELECT pulocation_id AS location_id, 'pickup' AS zone_role FROM stg WHERE pulocation_id IS NOT NULL
      UNION ALL
      SELECT dolocation_id, 'dropoff' FROM stg WHERE dolocation_id IS NOT NULL
    )"""

DIM_ZONE = """
    SELECT location_id, count(*) AS total_trips_touching_zone,
      count(*) FILTER (zone_role = 'pickup') AS pickup_trips,
      count(*) FILTER (zone_role = 'dropoff') AS dropoff_trips
    FROM touches GROUP BY location_id"""

DIM_VENDOR = f"""
    SELECT vendor_id, min(pickup_date) AS first_seen_date, max(pickup_date) AS last_seen_date,
      {COUNT}, {REVENUE}, {mean('total_amount', 'avg_trip_revenue')},
      {mean('trip_duration_min', 'avg_trip_duration_min')}
    FROM stg WHERE vendor_id IS NOT NULL GROUP BY vendor_id"""

DIM_PAYMENT = f"""
    SELECT payment_type, {COUNT}, {REVENUE}, {mean('total_amount', 'avg_total_amount')},
      {mean('tip_amount', 'avg_tip_amount')}, {mean('trip_duration_min', 'avg_trip_duration_min')}
    FROM stg WHERE payment_type IS NOT NULL GROUP BY payment_type"""

# --- aggregates, exact and as fragments for the views ------------------------------------------

AGG_PAYMENT = """
    SELECT payment_type, count(*) AS total_trips, sum(total_amount) AS total_revenue,
      avg(total_amount) AS avg_total_amount, avg(tip_amount) AS avg_tip_amount,
      sum(tip_amount) / nullif(sum(fare_amount), 0) AS tip_to_fare_ratio
    FROM stg GROUP BY payment_type"""
AGG_ROUTE = """
    SELECT pickup_date, pulocation_id, dolocation_id, count(*) AS total_trips,
      sum(total_amount) AS total_revenue, avg(total_amount) AS avg_total_amount,
      avg(trip_duration_min) AS avg_trip_duration_min
    FROM stg GROUP BY ALL"""
AGG_ZONE = """
    SELECT pulocation_id, count(*) AS total_trips, avg(trip_distance) AS avg_trip_distance,
      avg(total_amount) AS avg_total_amount, sum(total_amount) AS total_revenue
    FROM stg GROUP BY pulocation_id"""
AGG_HOURLY = """
    SELECT pickup_hour, day_of_week, count(*) AS total_trips,
      avg(trip_duration_min) AS avg_trip_duration_min, avg(trip_distance) AS avg_trip_distance,
      sum(total_amount) AS total_revenue
    FROM stg GROUP BY pickup_hour, day_of_week"""
KPI = """
    SELECT pickup_date, count(*) AS total_trips, sum(total_amount) AS total_revenue,
      avg(total_amount) AS avg_ticket, avg(trip_duration_min) AS avg_trip_duration_min,
      avg(trip_distance) AS avg_trip_distance
    FROM stg WHERE pickup_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
    GROUP BY pickup_date"""

DAY_LABEL = """CASE day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday'
      WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' WHEN 7 THEN 'Saturday'
      ELSE 'Unknown' END"""
PAYMENT_LABEL = """CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
      WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
      ELSE 'Type ' || CAST(payment_type AS VARCHAR) END"""

V_HOURLY = f"SELECT {DAY_LABEL} AS day_name, * FROM ({AGG_HOURLY})"
V_PAYMENT = f"SELECT {PAYMENT_LABEL} AS payment_type_name, * FROM ({AGG_PAYMENT})"
V_ZONE = f"""
    SELECT a.*, z.* EXCLUDE (location_id)
    FROM ({AGG_ZONE}) a LEFT JOIN ({DIM_ZONE}) z ON a.pulocation_id = z.location_id"""

def rounded(select: str, *floats: str) -> str:
    """``select`` with its floating columns rounded as the queries round them."""
    replaced = ", ".join(shown(c, c) for c in floats)
    return f"SELECT * REPLACE ({replaced}) FROM ({select})"


PAYMENT_FLOATS = ("total_revenue", "avg_total_amount", "avg_tip_amount", "tip_to_fare_ratio")
ROUTE_FLOATS = ("total_revenue", "avg_total_amount", "avg_trip_duration_min")
ZONE_FLOATS = ("total_revenue", "avg_total_amount", "avg_trip_distance")
HOURLY_FLOATS = ("total_revenue", "avg_trip_duration_min", "avg_trip_distance")
KPI_FLOATS = ("total_revenue", "avg_ticket", "avg_trip_duration_min", "avg_trip_distance")

# --- checks ------------------------------------------------------------------------------------


def line(model: str, check: str, target: str, failures: str, severity: str = "error") -> str:
    text = target.replace("'", "''")
    return f"""
    SELECT '{model}' AS model, '{check}' AS check_name, '{text}' AS target, '{severity}' AS severity,
      n AS failing_rows, CASE WHEN n = 0 THEN 'pass' ELSE '{severity}' END AS status
    FROM (SELECT CAST(({failures}) AS BIGINT) AS n)"""


CHECKED = {
    "stg_trips": "stg",
    "fct_trip": "fact",
    "dim_zone": f"({DIM_ZONE})",
    "dim_vendor": "(SELECT DISTINCT vendor_id FROM stg WHERE vendor_id IS NOT NULL)",
    "dim_payment_type": "(SELECT DISTINCT payment_type FROM stg WHERE payment_type IS NOT NULL)",
    "dim_date": f"({DIM_DATE})",
    "agg_pickup_zone": f"({AGG_ZONE})",
    "agg_payment_type": f"({AGG_PAYMENT})",
    "agg_hourly_traffic": f"({AGG_HOURLY})",
    "agg_route_daily": f"({AGG_ROUTE})",
}


def null_line(model: str, column: str) -> str:
    return line(model, "not_null", column, f"SELECT count(*) FROM {CHECKED[model]} WHERE {column} IS NULL")


def unique_line(model: str, column: str) -> str:
    return line(
        model,
        "unique",
        column,
        f"""SELECT count(*) FROM (SELECT {column} FROM {CHECKED[model]} WHERE {column} IS NOT NULL
            GROUP BY {column} HAVING count(*) > 1)""",
    )


def rule_line(rule: str, severity: str) -> str:
    return line("fct_trip", "expression_is_true", rule, f"SELECT count(*) FROM fact WHERE NOT ({rule})", severity)


def lost(column: str, parent: str, parent_column: str, fact: str = "fact") -> str:
    return f"""SELECT count(*) FROM {fact} f WHERE {column} IS NOT NULL AND NOT EXISTS
        (SELECT 1 FROM {CHECKED[parent]} p WHERE p.{parent_column} = f.{column})"""


NOT_NULL = [
    null_line(model, column)
    for model, column in [
        ("stg_trips", "pickup_datetime"),
        ("stg_trips", "pickup_date"),
        ("stg_trips", "pulocation_id"),
        ("stg_trips", "dolocation_id"),
        ("stg_trips", "total_amount"),
        ("dim_zone", "location_id"),
        ("dim_vendor", "vendor_id"),
        ("dim_payment_type", "payment_type"),
        ("dim_date", "date_key"),
        ("fct_trip", "event_id"),
        ("fct_trip", "pickup_date"),
        ("agg_pickup_zone", "pulocation_id"),
        ("agg_pickup_zone", "total_trips"),
        ("agg_payment_type", "payment_type"),
        ("agg_hourly_traffic", "pickup_hour"),
        ("agg_hourly_traffic", "day_of_week"),
        ("agg_route_daily", "pickup_date"),
    ]
]
UNIQUE = [
    unique_line(model, column)
    for model, column in [
        ("dim_zone", "location_id"),
        ("dim_vendor", "vendor_id"),
        ("dim_payment_type", "payment_type"),
        ("dim_date", "date_key"),
        ("fct_trip", "event_id"),
        ("agg_payment_type", "payment_type"),
    ]
]
RULES = [
    rule_line("trip_duration_min > 0", "error"),
    rule_line("trip_distance >= 0", "error"),
    rule_line("fare_amount >= 0", "warn"),
    rule_line("tip_amount >= 0", "warn"),
    rule_line("total_amount >= 0", "warn"),
]
RELATIONS = [
    line("fct_trip", "relationships", "pulocation_id", lost("pulocation_id", "dim_zone", "location_id")),
    line("fct_trip", "relationships", "vendor_id", lost("vendor_id", "dim_vendor", "vendor_id")),
]


# Late trips with a vendor and zones that the dimensions do not have.
LATE_FACT = """
    late AS (
      SELECT * REPLACE (
        CASE WHEN pickup_date >= DATE '1998-01-01' AND pickup_hour % 11 = 0 THEN 9 ELSE vendor_id END AS vendor_id,
        CASE WHEN pickup_date >= DATE '1998-01-01' AND pulocation_id % 13 = 0 THEN pulocation_id + 1000 ELSE pulocation_id END
          AS pulocation_id)
      FROM fact
    )"""
LATE_RELATIONS = [
    line("fct_trip", "relationships", "pulocation_id", lost("pulocation_id", "dim_zone", "location_id", "late")),
    line("fct_trip", "relationships", "vendor_id", lost("vendor_id", "dim_vendor", "vendor_id", "late")),
]


def report(lines: list[str], *more: str) -> str:
    return over(" UNION ALL ".join(lines), SEQ, FACT, TOUCHES, *more)


def relation(column: str, parent: str, parent_column: str) -> str:
    checked = f"SELECT CAST(count({column}) AS BIGINT) FROM late"
    failing = f"SELECT CAST(({lost(column, parent, parent_column, 'late')}) AS BIGINT)"
    return over(f"SELECT ({checked}) AS checked_rows, ({failing}) AS failing_rows", SEQ, FACT, TOUCHES, LATE_FACT)


def positions(select: str, order: str, *columns: str) -> str:
    """The keys of a result with their position in the order in which it is served."""
    return over(f"SELECT {', '.join(columns)}, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position FROM ({select})")


CENTS = "round(total_revenue, 2) DESC"
FILTERED = f"""SELECT * FROM ({AGG_ROUTE}) WHERE pickup_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
    AND pulocation_id BETWEEN 1 AND 131 AND dolocation_id BETWEEN 1 AND 60"""
ROUTE_ORDER = f"{CENTS}, pickup_date, pulocation_id NULLS LAST, dolocation_id NULLS LAST"
ROUTE_KEYS = ("pickup_date", "pulocation_id", "dolocation_id")

RAW_MONTHS = "months AS (SELECT *, strftime(tpep_pickup_datetime, '%Y-%m') AS month FROM raw)"
TRIPS_ONLY = "SELECT * FROM trips"
STG_ONLY = "SELECT * FROM stg"

ORACLES: dict[str, str] = {
    "scan_parquet": """
        SELECT l_returnflag, l_linestatus, count(*) AS rows, round(sum(l_quantity), 2) AS sum_quantity
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "scan_multi_file": over(
        """SELECT strftime(pickup_datetime, '%Y-%m') AS month, count(*) AS rows,
          round(sum(total_amount), 2) AS total_amount,
          CAST(sum(pulocation_id) AS BIGINT) AS sum_pickup_zone, sum(passenger_count) AS sum_passengers
        FROM stg GROUP BY 1"""
    ),
    "union_by_name_drift": over(
        """SELECT month, count(*) AS rows,
          count(*) FILTER (month < '1999-01') AS tpep_pickups,
          count(*) FILTER (month >= '1999-01') AS lpep_pickups,
          sum(passenger_count) AS sum_passengers,
          CAST(sum(payment_type) AS BIGINT) AS sum_payment_type,
          round(sum(CASE WHEN month < '1999-01' THEN trip_distance / 4 END), 2) AS sum_airport_fee,
          round(sum(CASE WHEN month >= '1999-01' THEN trip_distance / 4 END), 2) AS sum_surcharge
        FROM months GROUP BY month""",
        RAW_MONTHS,
    ),
    "month_range": over(
        """SELECT span.month, n.rows IS NOT NULL AS has_file, n.rows
        FROM (SELECT strftime(m, '%Y-%m') AS month
              FROM range(TIMESTAMP '1994-11-01', TIMESTAMP '2002-01-01', INTERVAL 1 MONTH) r(m)) span
        LEFT JOIN (SELECT month, count(*) AS rows FROM months GROUP BY month) n ON n.month = span.month""",
        RAW_MONTHS,
    ),
    "external_view": """
        SELECT o_orderpriority, count(*) AS rows, round(sum(l_extendedprice), 2) AS total_price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""",
    "normalize_trips": over("SELECT * FROM normal"),
    "derive_date_parts": """
        SELECT event_id, ts AS pickup_datetime, CAST(ts AS DATE) AS pickup_date,
          CAST(extract(hour FROM ts) AS INTEGER) AS pickup_hour,
          CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week
        FROM events""",
    "trip_duration": over(
        """SELECT CAST(sign(trip_duration_min) AS INTEGER) AS sign, count(*) AS rows,
          round(min(trip_duration_min), 9) AS shortest, round(max(trip_duration_min), 9) AS longest,
          round(sum(trip_duration_min), 2) AS sum_minutes
        FROM normal GROUP BY 1"""
    ),
    "default_fill": over(
        """SELECT passenger_count IS NULL AS was_missing, coalesce(passenger_count, 0.0) AS passenger_count,
          CAST(0.0 AS DOUBLE) AS absent_tip, count(*) AS rows
        FROM raw GROUP BY ALL"""
    ),
    "clean_trips": over(TRIPS_ONLY),
    "stg_trips": over(STG_ONLY),
    "row_count": over("SELECT count(*) AS written_rows, count(*) AS stored_rows FROM trips"),
    "sample_per_file": over(
        """SELECT month, least(count(*), max(share)) AS rows_per_file, max(share) AS share
        FROM months, (SELECT CAST(ceil(4000 / count(DISTINCT month)) AS BIGINT) AS share FROM months)
        GROUP BY month""",
        RAW_MONTHS,
    ),
    "limit_rows": over(
        """SELECT month, CAST(least(n, 1000 - before) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS invalid_rows
        FROM (
          SELECT *, coalesce(sum(n) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM (SELECT strftime(pickup_datetime, '%Y-%m') AS month, count(*) AS n FROM trips GROUP BY 1))
        WHERE before < 1000"""
    ),
    "dim_date": over(DIM_DATE),
    "dim_zone": over(DIM_ZONE, TOUCHES),
    "union_all": over(
        "SELECT zone_role, location_id, count(*) AS touches FROM touches GROUP BY ALL", TOUCHES
    ),
    "dim_vendor": over(DIM_VENDOR),
    "dim_payment_type": over(DIM_PAYMENT),
    "trip_seq": over("SELECT * FROM seq", SEQ, coarse=True),
    "trip_seq_hot": over("SELECT * FROM hot_seq", HOT, HOT_SEQ, coarse=True),
    "surrogate_key": "SELECT event_id, "
    + md5_key(
        "CAST(event_id AS VARCHAR)",
        stamp("ts"),
        "CASE WHEN event_type <> 'click' THEN CAST(user_id AS VARCHAR) END",
        "event_type",
    )
    + " AS event_key FROM events",
    "fct_trip": over("SELECT * FROM fact", SEQ, FACT, coarse=True),
    "agg_payment_type": over(rounded(AGG_PAYMENT, *PAYMENT_FLOATS)),
    "safe_ratio": over(
        """SELECT payment_type, round(sum(tip_amount) / nullif(
          sum(CASE WHEN payment_type >= 3 THEN fare_amount ELSE 0.0 END), 0), 10) AS ratio
        FROM stg GROUP BY payment_type"""
    ),
    "agg_route_daily": over(rounded(AGG_ROUTE, *ROUTE_FLOATS)),
    "agg_pickup_zone": over(rounded(AGG_ZONE, *ZONE_FLOATS)),
    "agg_hourly_traffic": over(rounded(AGG_HOURLY, *HOURLY_FLOATS)),
    "dim_vendor_rollup": over(DIM_VENDOR),
    "dim_zone_rollup": over(DIM_ZONE, TOUCHES),
    "agg_payment_type_rollup": over(rounded(AGG_PAYMENT, *PAYMENT_FLOATS)),
    "built_fct_trip": over("SELECT * FROM fact", SEQ, FACT),
    "built_dim_date": over(DIM_DATE),
    "built_dim_payment_type": over(DIM_PAYMENT),
    "built_agg_route_daily": over(rounded(AGG_ROUTE, *ROUTE_FLOATS)),
    "built_v_hourly_traffic": over(rounded(V_HOURLY, *HOURLY_FLOATS)),
    "built_v_zone_performance": over(rounded(V_ZONE, *ZONE_FLOATS), TOUCHES),
    "v_kpi_daily": over(rounded(KPI, *KPI_FLOATS)),
    "v_hourly_traffic": over(rounded(V_HOURLY, *HOURLY_FLOATS)),
    "v_payment_performance": over(rounded(V_PAYMENT, *PAYMENT_FLOATS)),
    "v_zone_performance": over(rounded(V_ZONE, *ZONE_FLOATS), TOUCHES),
    "v_route_performance": over(rounded(AGG_ROUTE, *ROUTE_FLOATS)),
    "report_scorecards": over(
        f"""SELECT CAST(sum(total_trips) AS BIGINT) AS total_trips,
          {shown("sum(total_revenue)", "total_revenue")}, {mean("avg_ticket", "avg_ticket")},
          {mean("avg_trip_duration_min", "avg_trip_duration_min")},
          {shown("sum(avg_ticket * total_trips) / sum(total_trips)", "weighted_avg_ticket")},
          {shown("sum(avg_trip_duration_min * total_trips) / sum(total_trips)", "weighted_avg_trip_duration_min")}
        FROM ({KPI})"""
    ),
    "report_monthly": over(
        f"""SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS pickup_month,
          CAST(sum(total_trips) AS BIGINT) AS total_trips, round(sum(total_revenue), 2) AS total_revenue
        FROM ({KPI}) GROUP BY 1"""
    ),
    "report_heatmap": over(
        "SELECT day_name, "
        + ", ".join(
            f"CAST(sum(total_trips) FILTER (pickup_hour = {h}) AS BIGINT) AS hour_{h}" for h in range(24)
        )
        + f" FROM ({V_HOURLY}) GROUP BY day_name"
    ),
    "report_by_hour": over(
        f"""SELECT pickup_hour, round(sum(total_revenue), 2) AS total_revenue,
          {mean("avg_trip_duration_min", "avg_trip_duration_min")}
        FROM ({V_HOURLY}) GROUP BY pickup_hour"""
    ),
    "report_payment": over(
        f"SELECT * EXCLUDE (payment_type, avg_total_amount) FROM ({rounded(V_PAYMENT, *PAYMENT_FLOATS)})"
    ),
    "report_top_zones": over(
        rounded(f"{AGG_ZONE} ORDER BY total_revenue DESC, pulocation_id NULLS FIRST LIMIT 20", *ZONE_FLOATS)
    ),
    "report_filtered_routes": over(
        f"""SELECT pickup_date, pulocation_id, dolocation_id, total_trips,
          round(total_revenue, 2) AS total_revenue
        FROM ({AGG_ROUTE})
        WHERE pickup_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
          AND pulocation_id BETWEEN 1 AND 131 AND dolocation_id BETWEEN 1 AND 60"""
    ),
    "report_filtered_traffic": over(
        f"SELECT * FROM ({rounded(V_HOURLY, *HOURLY_FLOATS)}) WHERE day_name IN ('Saturday', 'Sunday')"
    ),
    "dq_not_null": report(NOT_NULL),
    "dq_unique": report(UNIQUE),
    "dq_relationships_zone": relation("pulocation_id", "dim_zone", "location_id"),
    "dq_relationships_vendor": relation("vendor_id", "dim_vendor", "vendor_id"),
    "dq_expression": report(RULES),
    "dq_report": report(NOT_NULL + RULES + UNIQUE + RELATIONS),
    "dq_report_late": report(NOT_NULL + RULES + UNIQUE + LATE_RELATIONS, LATE_FACT),
    "sink_roundtrip": over(TRIPS_ONLY),
    "sink_partitioned": over(STG_ONLY),
    "backfill_months": over(
        """SELECT month AS source_month, count(*) AS inserted_rows, count(*) AS stored_rows
        FROM (SELECT strftime(pickup_datetime, '%Y-%m') AS month FROM trips) GROUP BY month"""
    ),
    "catalog_by_day": over(
        """SELECT pickup_date, count(*) AS rows, round(sum(total_amount), 2) AS total_revenue, 1 AS listed
        FROM stg GROUP BY pickup_date"""
    ),
    "catalog_months": over(
        """SELECT month AS source_month, count(DISTINCT pickup_date) AS days, count(*) AS rows
        FROM (SELECT *, strftime(pickup_datetime, '%Y-%m') AS month FROM trips)
        WHERE month BETWEEN '1997-01' AND '1997-03' GROUP BY month"""
    ),
    "served_agg_payment_type": positions(AGG_PAYMENT, f"{CENTS}, payment_type NULLS LAST", "payment_type"),
    "served_agg_route_daily": positions(AGG_ROUTE, ROUTE_ORDER, *ROUTE_KEYS),
    "served_agg_pickup_zone": positions(AGG_ZONE, "total_trips DESC, pulocation_id NULLS LAST", "pulocation_id"),
    "served_agg_hourly_traffic": positions(AGG_HOURLY, "day_of_week, pickup_hour", "day_of_week", "pickup_hour"),
    "served_v_kpi_daily": positions(KPI, "pickup_date", "pickup_date"),
    "served_report_filtered_routes": positions(FILTERED, ROUTE_ORDER, *ROUTE_KEYS),
}
