import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tripmill.operators.numbering import number_rows

KEYS, ORDER = ("k", "j"), ("a", "b")
SCHEMA = "k int, j string, a double, b int, c string"


def frame(spark, rows=3_000, seed=0):
    """One group holds more than a third of the rows, with many equal rows and nulls."""
    rng = random.Random(seed)
    data = []
    for _ in range(rows):
        k = 1 if rng.random() < 0.4 else rng.choice([None, *range(2, 40)])
        data.append((k, rng.choice(["x", None]), rng.choice([None, 0.5, 1.0, 7.0]), rng.randrange(3), "c"))
    return spark.createDataFrame(data, SCHEMA)


def plain(df):
    window = Window.partitionBy(*KEYS).orderBy(*ORDER)
    return df.withColumn("n", F.row_number().over(window))


def contents(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_numbers_equal_those_of_a_window(spark):
    df = frame(spark)
    assert contents(number_rows(df, KEYS, ORDER, "n")) == contents(plain(df))


def test_empty_input(spark):
    assert number_rows(frame(spark, 0), KEYS, ORDER, "n").count() == 0


def test_values_are_not_changed(spark):
    values = [-0.0, 0.0, float("nan"), 1.0, None]
    df = spark.createDataFrame([(1, "x", v, 1, "c") for v in values], SCHEMA)
    found = {str(r.a) for r in number_rows(df, KEYS, ORDER, "n").collect()}
    assert found == {"-0.0", "0.0", "nan", "1.0", "None"}


def test_runs_go_on_across_batches_and_ranges(spark):
    """Small batches, so that groups cross their borders; groups of one range, of several, and of all."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for hot in (0.0, 0.4, 1.0):
            rng = random.Random(4)
            data = [(1 if rng.random() < hot else rng.randrange(60), None, rng.random(), 1, "c") for _ in range(2_000)]
            df = spark.createDataFrame(data, SCHEMA)
            assert contents(number_rows(df, KEYS, ORDER, "n")) == contents(plain(df))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_keys_of_every_type(spark):
    """Groups of floats, of which NaN is one and both zeros are one, times, decimals and bytes."""
    rows = [(v, f"2023-01-0{k % 3 + 1}", k) for v in (0.0, -0.0, float("nan"), None, 1.5) for k in range(6)]
    df = spark.createDataFrame(rows, "f double, d string, k int").selectExpr(
        "f", "to_timestamp(d) t", "cast(k % 2 as decimal(9, 2)) m", "cast(d as binary) b", "k"
    )
    keys = ["f", "t", "m", "b"]
    plain_rows = df.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("k")))
    # Equal keys of both zeros may come in either order.
    shown = lambda d: sorted(str((r.t, r.m, r.b, r.k if r.f != 0 else None, r.n)) for r in d.collect())
    assert shown(number_rows(df, keys, ["k"], "n")) == shown(plain_rows)


def test_scratch_is_removed_with_its_block(spark):
    from tripmill.session import _folders, scratch

    outside = number_rows(frame(spark, 20), KEYS, ORDER, "n")
    with scratch(spark):
        assert number_rows(frame(spark, 50), KEYS, ORDER, "n").count() == 50
        inside = _folders[spark.sparkContext.applicationId][-1]
    path = spark._jvm.org.apache.hadoop.fs.Path(inside)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    assert inside not in _folders[spark.sparkContext.applicationId] and outside.count() == 20


def test_one_group_of_equal_rows_is_numbered_by_several_tasks(spark):
    df = spark.range(0, 20_000, 1, 4).select(
        F.lit(1).alias("k"), F.lit("x").alias("j"), F.lit(0.5).alias("a"), F.lit(1).alias("b"), F.lit("c").alias("c")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = number_rows(df, KEYS, ORDER, "n").withColumn("task", F.spark_partition_id()).cache()
        assert out.select("task").distinct().count() > 1
        assert sorted(r.n for r in out.collect()) == list(range(1, 20_001))
        out.unpersist()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
