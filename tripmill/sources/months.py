"""Month ranges and the monthly files they select."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.schema import TAXI_TYPES
from tripmill.sources.files import list_files

# Fixed value: published name of a monthly file.
MONTH_FILE = "{taxi}_tripdata_{month}.parquet"
MONTH = re.compile(r"\d{4}-(0[1-9]|1[0-2])")


def check_taxi(taxi: str) -> str:
    taxi = taxi.strip().lower()
    if taxi not in TAXI_TYPES:
        raise ValueError(f"unknown taxi type {taxi!r}; expected one of {', '.join(TAXI_TYPES)}")
    return taxi


def check_month(month: str) -> str:
    if not MONTH.fullmatch(month):
        raise ValueError(f"expected a month as YYYY-MM, got {month!r}")
    return month


def month_frame(spark: SparkSession, start: str, end: str) -> DataFrame:
    """All months from ``start`` to ``end``, both included, as ``month`` text."""
    first, last = (F.to_date(F.lit(check_month(m) + "-01")) for m in (start, end))
    step = F.expr("interval 1 month")
    months = F.when(first <= last, F.sequence(first, last, step)).otherwise(F.array().cast("array<date>"))
    return spark.range(1).select(F.explode(months).alias("day")).select(
        F.date_format("day", "yyyy-MM").alias("month")
    )


def select_months(
    spark: SparkSession, root: str, taxi: str, start: str, end: str, pattern: str = MONTH_FILE
) -> dict[str, list[str]]:
    """Existing files of each month in an inclusive range, by month; absent months are left out.

    A month may be one file or a folder of part files. Listing is one call for the whole root.
    """
    taxi, start, end = check_taxi(taxi), check_month(start), check_month(end)
    name = re.compile(re.escape(pattern).replace(r"\{taxi\}", taxi).replace(r"\{month\}", f"({MONTH.pattern})"))
    found: dict[str, list[str]] = {}
    for file in list_files(spark, f"{root.rstrip('/')}/{pattern.format(taxi=taxi, month='*')}"):
        for part in file.split("/"):
            match = name.fullmatch(part)
            if match and start <= match.group(1) <= end:
                found.setdefault(match.group(1), []).append(file)
    if not found:
        raise FileNotFoundError(f"no {taxi} files from {start} to {end} under {root}")
    return dict(sorted(found.items()))
