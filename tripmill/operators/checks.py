"""Data checks. Each yields a count of failures; none of them collects rows."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.session import store

ERROR, WARN, PASS = "error", "warn", "pass"

NOT_NULL, UNIQUE = "not_null", "unique"
RELATIONSHIPS, EXPRESSION = "relationships", "expression_is_true"


def result_row(model: str, check: str, target: str, failures: Column, severity: str = ERROR) -> Column:
    """One line of a report as a struct."""
    failures = F.coalesce(failures, F.lit(0)).cast("bigint")
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(check).alias("check_name"),
        F.lit(target).alias("target"),
        F.lit(severity).alias("severity"),
        failures.alias("failing_rows"),
        F.when(failures == 0, F.lit(PASS)).otherwise(F.lit(severity)).alias("status"),
    )


def row_counts(not_null: Sequence[str] = (), expressions: Sequence[tuple[str, str]] = ()) -> list[Column]:
    """Failures of each null check and rule, as aggregates ``_0``, ``_1`` and so on.

    ``expressions`` are pairs of SQL condition and severity. A null condition passes.
    """
    counts = [F.count_if(F.col(c).isNull()) for c in not_null]
    counts += [F.count_if(~F.expr(rule)) for rule, _ in expressions]
    return [count.alias(f"_{i}") for i, count in enumerate(counts)]


def row_lines(
    counted: DataFrame,
    model: str,
    not_null: Sequence[str] = (),
    expressions: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Report lines of ``row_counts``, which may come in several rows to add up."""
    lines = [result_row(model, NOT_NULL, c, F.col(f"_{i}")) for i, c in enumerate(not_null)]
    lines += [
        result_row(model, EXPRESSION, rule, F.col(f"_{i}"), severity)
        for i, (rule, severity) in enumerate(expressions, start=len(not_null))
    ]
    totals = counted.agg(*[F.sum(f"_{i}").alias(f"_{i}") for i in range(len(lines))])
    return totals.select(F.inline(F.array(*lines)))


def row_checks(
    df: DataFrame,
    model: str,
    not_null: Sequence[str] = (),
    expressions: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """All null checks and rules of a table in one scan."""
    return row_lines(df.agg(*row_counts(not_null, expressions)), model, not_null, expressions)


def unique_checks(columns: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Report lines for (table, model, key column): values that occur more than once, nulls aside.

    The keys of all tables go through one aggregation by table and 8-byte hash, which shuffles a
    fraction of the bytes of text keys. Its repeats are written down; they are few, so the keys
    that have them are found by a join of a small side, and only those are compared as they are.
    """
    keys = [
        df.filter(F.col(column).isNotNull()).select(
            F.lit(k).alias("_table"), F.xxhash64(F.col(column).cast("string")).alias("_hash"), F.col(column).cast("string").alias("_value")
        )
        for k, (df, _, column) in enumerate(columns)
    ]
    every = reduce(DataFrame.unionAll, keys)
    repeated = F.col("_rows") > 1
    suspects = every.groupBy("_table", "_hash").agg(F.count(F.lit(1)).alias("_rows")).filter(repeated)
    suspects = store(suspects.select("_table", "_hash"), "repeated-keys")
    again = every.join(suspects, ["_table", "_hash"], "left_semi").groupBy("_table", "_value")
    found = again.agg(F.count(F.lit(1)).alias("_rows")).filter(repeated)
    counts = found.agg(*[F.count_if(F.col("_table") == k).alias(f"_{k}") for k in range(len(columns))])
    lines = [result_row(model, UNIQUE, column, F.col(f"_{k}")) for k, (_, model, column) in enumerate(columns)]
    return counts.select(F.inline(F.array(*lines)))


def key_counts(child: DataFrame, columns: Sequence[str], *more: Column) -> DataFrame:
    """Rows per combination of foreign keys, and ``more`` aggregates, which all checks can share."""
    return child.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"), *more)


def relationship_counts(
    counts: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows with a value, and those among them without a parent, from ``key_counts``.

    A hot value meets the join as one row.
    """
    parents = parent.select(F.col(parent_column).alias(column)).distinct()
    values = counts.groupBy(column).agg(F.sum("rows").alias("rows"))
    known = values.join(parents.withColumn("_known", F.lit(True)), column, "left")
    given = F.when(F.col(column).isNotNull(), F.col("rows")).otherwise(0)
    lost = F.when(F.col("_known").isNull(), given).otherwise(0)
    return known.agg(
        F.coalesce(F.sum(given), F.lit(0)).alias("checked_rows"),
        F.coalesce(F.sum(lost), F.lit(0)).alias("failing_rows"),
    )


def relationship_check(
    counts: DataFrame, model: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Report line: number of child rows without a parent."""
    count = relationship_counts(counts, column, parent, parent_column)
    line = result_row(model, RELATIONSHIPS, column, F.col("failing_rows"))
    return count.select(F.inline(F.array(line)))
