"""Row numbers within groups, without putting a huge group into one task.

A window sends every group to a single task. Here rows are range partitioned by keys, order and a
row number of their own, so a group of any size, equal rows included, is spread over ranges. Every
range is sorted, numbers its rows while they pass and is written down: one shuffle. A group that
reaches over several ranges is then shifted by its rows in the earlier ones. Those come from one row a
range, with its first group, its last group and how often it holds that one, summed in the order of
the ranges. There is one path for every size.
"""

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.session import on_workers, store


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add ``row_number()`` over ``keys`` ordered by ``order`` (ascending, nulls first).

    Ties are settled by the other columns, then by the place in the input. Values are not touched.
    The ranges are written down, because they must not change between their uses, also when
    executors are lost.
    """
    columns = df.columns
    rest = [c for c in columns if c not in keys and c not in order]
    sorting = [*keys, *order, *rest, "_row"]
    ranged = (
        df.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*sorting)
        .sortWithinPartitions(*sorting)
        .select(*columns, F.spark_partition_id().alias("_range"))
    )
    on_workers(df.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    numbered = ranged.mapInArrow(_count_runs([columns.index(k) for k in keys]), f"{schema}, _range int, _number bigint")
    stored = store(numbered, "numbered")

    group = F.struct(*keys)
    here = (F.col("_range") == F.col("_in")) & group.eqNullSafe(F.col("_group"))
    number = F.col("_number") + F.coalesce("_shift", F.lit(0))
    return stored.join(F.broadcast(_shifts(stored, keys)), here, "left").select(*columns, number.cast("int").alias(name))


def _count_runs(keys: Sequence[int]):
    """Number the rows of each run of equal keys in a sorted partition, across its batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, reached = None, 0  # the keys of the last row, and its number
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [batch.column(k) for k in keys]
            starts = _run_starts(own)
            if last is None or not all(_same(a, b.slice(0, 1)).to_pylist()[0] for a, b in zip(last, own)):
                reached = 0
            place = pa.array(range(1, batch.num_rows + 1), pa.int64())
            # Rows before the first start go on from the last batch; others count from their start.
            first = pc.fill_null(pc.fill_null_forward(pc.if_else(starts, pc.subtract(place, 1), pa.scalar(None, pa.int64()))), -reached)
            number = pc.subtract(place, first)
            yield pa.RecordBatch.from_arrays([*batch.columns, number], names=[*batch.schema.names, "_number"])
            last, reached = [column.slice(batch.num_rows - 1) for column in own], number[-1].as_py()

    return run


def _same(a: pa.Array, b: pa.Array) -> pa.Array:
    """Equality in which nulls equal nulls and NaN equals NaN, as in a group."""
    equal = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(a.type):
        equal = pc.or_(equal, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return equal


def _run_starts(columns: Sequence[pa.Array]) -> pa.Array:
    """Whether a row's keys differ from those of the row before; false for the first row."""
    n = len(columns[0])
    equal = pa.array([True] * (n - 1), pa.bool_())
    for column in columns:
        equal = pc.and_(equal, _same(column.slice(1), column.slice(0, n - 1)))
    return pa.concat_arrays([pa.array([False]), pc.invert(equal)])


def _shifts(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_in, _group, _shift): rows of the first group of a range in earlier ranges; a row a range at most.

    Only the keys and numbers of the written rows are read. Of every range two groups count: its
    last, which may go on in the next range, and its first, which may have come from the one before.
    """
    group = F.struct(*keys)
    ends = stored.groupBy("_range").agg(F.min(group).alias("first"), F.max(F.struct(group.alias("group"), "_number")).alias("last"))
    one = F.col("first").eqNullSafe(F.col("last.group"))
    seen = ends.select(
        F.col("_range").alias("_in"),
        F.explode(
            F.array(
                F.struct(F.col("first").alias("_group"), F.when(one, F.col("last._number")).otherwise(0).alias("rows")),
                F.struct(F.col("last.group").alias("_group"), F.when(one, 0).otherwise(F.col("last._number")).alias("rows")),
            )
        ).alias("end"),
    ).select("_in", "end.*")
    seen = seen.groupBy("_in", "_group").agg(F.sum("rows").alias("rows"))
    earlier = Window.partitionBy("_group").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    return seen.withColumn("_shift", F.sum("rows").over(earlier)).filter("_shift > 0").select("_in", "_group", "_shift")
