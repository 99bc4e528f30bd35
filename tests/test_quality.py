import pytest
from frames import trip, trips

from tripmill.operators import checks
from tripmill.plans import quality
from tripmill.plans.build import build, reopen


def failing(df):
    return {(r.check_name, r.target): (r.failing_rows, r.severity, r.status) for r in df.collect()}


def failing_by_model(df):
    return {r.model: (r.failing_rows, r.status) for r in df.collect()}


def test_row_checks_count_nulls_and_rules(spark):
    df = spark.createDataFrame([(1, -1.0), (None, 2.0), (None, None)], "a int, b double")
    found = failing(checks.row_checks(df, "t", ["a", "b"], [("b >= 0", checks.WARN), ("b < 9", checks.ERROR)]))
    assert found == {
        ("not_null", "a"): (2, "error", "error"),
        ("not_null", "b"): (1, "error", "error"),
        ("expression_is_true", "b >= 0"): (1, "warn", "warn"),
        ("expression_is_true", "b < 9"): (0, "error", "pass"),
    }


def test_row_checks_on_an_empty_table(spark):
    df = spark.createDataFrame([], "a int")
    assert failing(checks.row_checks(df, "t", ["a"])) == {("not_null", "a"): (0, "error", "pass")}


def test_repeated_keys_of_several_tables(spark):
    frames = {
        "numbers": spark.createDataFrame([(v,) for v in [1, 1, 2, 3, 3, 3, None, None]], "v int"),
        "texts": spark.createDataFrame([(v,) for v in [*"aabccc", "1", None]], "v string"),
        "days": spark.sql("SELECT explode(sequence(date'2023-01-01', date'2023-03-01')) AS v"),
        "none": spark.createDataFrame([], "v string"),
    }
    found = failing_by_model(checks.unique_checks([(df, m, "v") for m, df in frames.items()]))
    assert found == {"numbers": (2, "error"), "texts": (2, "error"), "days": (0, "pass"), "none": (0, "pass")}


def test_equal_hashes_of_different_keys_are_no_repeats(spark, monkeypatch):
    """A hash of the length alone collides all the time."""
    monkeypatch.setattr(checks.F, "xxhash64", lambda c: checks.F.length(c).cast("long"))
    df = spark.createDataFrame([(v,) for v in ["aa", "bb", "cc", "cc", "d"]], "v string")
    assert failing_by_model(checks.unique_checks([(df, "t", "v"), (df.distinct(), "u", "v")])) == {"t": (1, "error"), "u": (0, "pass")}


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    keys = checks.key_counts(child, ["k"])
    counts = checks.relationship_counts(keys, "k", parent, "id").first()
    assert (counts.checked_rows, counts.failing_rows) == (3, 2)
    line = failing(checks.relationship_check(keys, "c", "k", parent, "id"))
    assert line == {("relationships", "k"): (2, "error", "error")}


def test_thirty_checks_are_declared():
    null = sum(map(len, quality.NOT_NULL_COLUMNS.values()))
    rules = sum(map(len, quality.RULES.values()))
    assert (null, len(quality.UNIQUE_COLUMNS), len(quality.PARENTS), rules) == (17, 6, 2, 5)


def test_clean_build_passes_with_warnings(spark, folder):
    house = build(spark, trips(spark, trip(), trip(fare_amount=-5.0)), folder)
    report = quality.quality_report(house.tables).collect()
    assert len(report) == 30
    assert [r.target for r in report if r.status != "pass"] == ["fare_amount >= 0"]
    quality.enforce(report)
    again = quality.quality_report(reopen(spark, trips(spark, trip()), folder).tables)
    assert sorted(map(str, again.collect())) == sorted(map(str, report))


def test_unknown_payment_and_zone_fail_the_run(spark, folder):
    rows = [trip(), trip(payment_type=None, pulocation_id=None)]
    house = build(spark, trips(spark, *rows), folder)
    report = quality.quality_report(house.tables).collect()
    failed = {(r.model, r.target) for r in report if r.status == "error"}
    assert failed == {
        ("agg_payment_type", "payment_type"),
        ("stg_trips", "pulocation_id"),
        ("agg_pickup_zone", "pulocation_id"),
    }
    with pytest.raises(quality.CheckFailure, match="agg_payment_type.payment_type not_null: 1"):
        quality.enforce(report)


def test_report_scans_the_fact_three_times_at_most(spark, folder, monkeypatch):
    """Once for rules and foreign keys, twice for its key; counted over everything that is run."""
    house = build(spark, trips(spark, trip(), trip(vendor_id=None), trip(fare_amount=-1.0)), folder)
    scans = []
    plans = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    plain = quality.store

    def counting(df, purpose):
        scans.append(plans(df).count("event_id#"))
        return plain(df, purpose)

    for module in (quality, checks):
        monkeypatch.setattr(module, "store", counting)
    report = quality.quality_report(house.tables)
    fact = f"{folder}/fct_trip"
    text = report._jdf.queryExecution().executedPlan().toString()
    assert len(scans) == 2 and text.count("fct_trip]") + text.count(fact + ",") <= 1
    assert report.count() == 30
