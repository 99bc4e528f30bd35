"""Packing by optimal length buckets.

The histogram of all lengths, a row for each distinct length, is counted in Spark. Dynamic
programming over it picks the bucket bounds with the least padding. Distinct lengths come to the
driver, never rows: d of them need at least d * d / 2 tokens in the table. Inside a bucket every batch has the same padded length, so its number
of rows is the token budget divided by that length, and a row's batch follows from its number.

Defined results: a null or blank text has length 0 and goes to the first bucket; a text longer than
the budget is a batch of its own, marked ``over_budget`` and never cut; equal lengths are ordered by
id and a hash of the row, so repeated rows get places of their own; an empty table gives no rows.
Other columns pass through; one with an output column's name is replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tripmill.llm.shared import split_words, whole_text

BUCKETS = 12
BUDGET = 16_384
SHARD_ROWS = 20_000

OUTPUT = ("length", "bucket", "bucket_length", "batch", "slot", "over_budget")


def token_count(text: str = "text") -> Column:
    """Words of the whole text; any other whole number column can be packed as well."""
    return F.size(split_words(whole_text(F.col(f"`{text}`")))).cast("long")


def histogram(lengths: DataFrame, length: str = "length") -> DataFrame:
    """The rows of every length, shortest first. Partial sums are combined before the shuffle."""
    return lengths.groupBy(F.col(length).alias("length")).agg(F.count("*").alias("n")).orderBy("length")


def optimal_bounds(lengths: np.ndarray, n: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets that pad the least.

    ``lengths`` ascend. A bucket over lengths i..j pads every row to ``lengths[j]``; the tokens
    themselves are constant, so the cost to minimise is rows times upper length. Products are exact
    up to 2 ** 64.
    """
    different = len(lengths)
    if not different:
        return []
    rows = np.concatenate([[0], np.cumsum(n, dtype=np.int64)]).astype(np.longdouble)
    upper = lengths.astype(np.longdouble)
    best = upper * rows[1:]
    choice = [np.zeros(different, dtype=np.int64)]
    for _ in range(1, min(buckets, different)):
        best, cut_at = _with_one_more(np.concatenate([[0], best]), rows, upper)
        choice.append(cut_at)
    bounds, j = [], different - 1
    for cut_at in reversed(choice):
        if j < 0:
            break
        bounds.append(int(lengths[j]))
        j = int(cut_at[j]) - 1
    return bounds[::-1]


def _with_one_more(before: np.ndarray, rows: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least costs up to every length with one more bucket, and where that bucket begins.

    ``before[i]`` is the cost of all below length i. A longer last length never moves the best
    beginning down, so the middle of a range bounds the search of both halves.
    """
    now, begin = np.empty(len(upper), dtype=np.longdouble), np.empty(len(upper), dtype=np.int64)
    ranges = [(0, len(upper), 0, len(upper) - 1)]
    while ranges:
        low, high, first, last = ranges.pop()
        if low >= high:
            continue
        j = (low + high) // 2
        end = min(last, j) + 1
        cost = before[first:end] + (rows[j + 1] - rows[first:end]) * upper[j]
        begin[j] = first + int(np.argmin(cost))
        now[j] = cost[begin[j] - first]
        ranges += [(low, j, first, int(begin[j])), (j + 1, high, int(begin[j]), last)]
    return now, begin


def plan_buckets(lengths: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> list[tuple[int, int, int]]:
    """(upper length, rows per batch, shards) of each bucket, shortest first.

    Only the histogram, a number per distinct length, comes to the driver.
    """
    bins = histogram(lengths).toPandas()
    found = optimal_bounds(bins["length"].to_numpy(dtype=np.int64), bins["n"].to_numpy(dtype=np.int64), buckets)
    plan, low = [], -1
    for upper in found:
        inside = (bins["length"] > low) & (bins["length"] <= upper)
        count = int(bins.loc[inside, "n"].sum())
        plan.append((upper, max(1, budget // max(upper, 1)), max(1, -(-count // SHARD_ROWS))))
        low = upper
    return plan


def pack(
    docs: DataFrame,
    length: Column | None = None,
    key: str = "doc_id",
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """Add bucket, batch and slot to every row.

    Rows of a bucket are numbered inside shards of about SHARD_ROWS rows, so a bucket that holds
    most of the rows is numbered by many tasks; each shard ends with at most one short batch.
    """
    kept = [c for c in docs.columns if c not in OUTPUT]
    length = token_count() if length is None else length
    rows = docs.withColumn("__length", F.coalesce(length.cast("long"), F.lit(0)))
    rows = rows.select(*(F.col(f"`{c}`") for c in kept), F.col("__length").alias("length"))
    plan = plan_buckets(rows.select("length"), buckets, budget)
    if not plan:
        plan = [(0, 1, 1)]
    packed = place(rows, plan, key, budget)
    return packed.select(*(F.col(f"`{c}`") for c in kept), *OUTPUT)


def place(rows: DataFrame, plan: list[tuple[int, int, int]], key: str, budget: int) -> DataFrame:
    def by_bucket(values: list[int]) -> Column:
        chosen = F.lit(values[-1])
        for (upper, _, _), value in reversed(list(zip(plan[:-1], values[:-1]))):
            chosen = F.when(F.col("length") <= upper, F.lit(value)).otherwise(chosen)
        return chosen

    # The row number in the input spreads a repeated or null id over the shards as well.
    salt = F.xxhash64(F.col(f"`{key}`"), F.col("length"), F.monotonically_increasing_id())
    rows = rows.withColumns(
        {
            "bucket": by_bucket(list(range(len(plan)))).cast("int"),
            "bucket_length": by_bucket([p[0] for p in plan]).cast("long"),
            "__size": by_bucket([p[1] for p in plan]),
            "__tie": salt,
        }
    )
    rows = rows.withColumn("__shard", F.pmod("__tie", by_bucket([p[2] for p in plan])))
    number = F.row_number().over(Window.partitionBy("bucket", "__shard").orderBy("length", F.col(f"`{key}`"), "__tie")) - 1
    return rows.withColumn("__row", number).withColumns(
        {
            "batch": F.concat_ws("-", F.col("bucket"), F.col("__shard"), F.floor(F.col("__row") / F.col("__size"))),
            "slot": F.pmod("__row", "__size").cast("int"),
            "over_budget": F.col("length") > budget,
        }
    )
