"""Surrogate keys."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schema import KEY_NULL, KEY_SEPARATOR


def timestamp_text(ts: Column) -> Column:
    """Timestamp text as the warehouse prints it: 0, 3 or 6 fraction digits, then ``+00``.

    The session zone must be UTC.
    """
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return (
        F.when(micros == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss'+00'"))
        .when(micros % 1000 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS'+00'"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS'+00'"))
    )


def surrogate_key(df: DataFrame, columns: tuple[str, ...]) -> Column:
    """MD5 over the text of ``columns``, null parts replaced by a marker."""
    parts = []
    for name in columns:
        is_timestamp = isinstance(df.schema[name].dataType, T.TimestampType)
        text = timestamp_text(F.col(name)) if is_timestamp else F.col(name).cast("string")
        parts.append(F.coalesce(text, F.lit(KEY_NULL)))
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
