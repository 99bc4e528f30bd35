"""Raw trip files of any taxi type to canonical trips."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions import duration_minutes, zero_filled
from tripmill.schema import RAW_NAMES, TRIP_COLUMNS, TRIPS, ZERO_FILLED


def convert(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that yields null for values the target cannot hold.

    Between numbers or timestamps a plain cast cannot fail, and it keeps null checks pushable to
    the scan; text and narrowing to an integer id can fail, so they use ``try_cast``.
    """
    fallible = isinstance(source, T.StringType) or isinstance(target, T.IntegerType)
    return column.try_cast(target) if fallible else column.cast(target)


def raw_value(df: DataFrame, name: str, target: T.DataType | None = None) -> Column:
    """First non-null among the spellings of a canonical column that ``df`` has, else null."""
    present = {field.name.lower(): field for field in df.schema.fields}
    found = [present[s.lower()] for s in RAW_NAMES[name] if s.lower() in present]
    columns = [
        F.col(f"`{f.name}`") if target is None else convert(F.col(f"`{f.name}`"), f.dataType, target)
        for f in found
    ]
    if not columns:
        return F.lit(None).cast(target or "void")
    return columns[0] if len(columns) == 1 else F.coalesce(*columns)


def default_fill(df: DataFrame, name: str) -> Column:
    """A measure as double, 0 where the file has no value or no such column."""
    return zero_filled(raw_value(df, name), raw_value(df, name, T.DoubleType()))


def derive_date_parts(df: DataFrame) -> DataFrame:
    """Add calendar parts of the pickup time; weekday 1 is Sunday."""
    pickup = F.col("pickup_datetime")
    return df.withColumns(
        {
            "pickup_date": F.to_date(pickup),
            "pickup_hour": F.hour(pickup),
            "day_of_week": F.dayofweek(pickup),
        }
    )


def normalize_trips(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project a raw frame to the canonical columns and those to ``keep``, without dropping rows."""
    columns = [F.col(name) for name in keep]
    for name in RAW_NAMES:
        target = TRIPS[name].dataType
        value = default_fill(raw, name) if name in ZERO_FILLED else raw_value(raw, name, target)
        columns.append(value.alias(name))
    trips = derive_date_parts(raw.select(*columns))
    duration = duration_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return trips.withColumn("trip_duration_min", duration).select(*TRIP_COLUMNS, *keep)


def clean_trips(trips: DataFrame) -> DataFrame:
    """Keep completed trips: known pickup and dropoff and a positive duration."""
    return trips.filter(
        F.col("pickup_date").isNotNull()
        & F.col("dropoff_datetime").isNotNull()
        & (F.col("trip_duration_min") > 0)
    )
