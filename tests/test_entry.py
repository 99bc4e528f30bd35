import subprocess
import sys
from pathlib import Path

import __spark_entry__ as contract
import pytest
from oracle import compare, duck_connection, type_names
from verification.oracles import ORACLES
from verification.queries import QUERIES

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("absent", ["public_tokenizers", "tripmill.llm", "corpus_pipeline"])
def test_the_rest_works_without_the_text_operators(absent):
    """In a process of its own, where the module cannot be imported."""
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; print(len(set(e.queries()) & set({list(QUERIES)!r})), set(e.oracle_sql()) <= set(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.stdout.split() == [str(len(QUERIES)), "True"]


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "pickup_date" and df.count() > 0


def test_late_facts_lose_their_parents(duck):
    for name in ("dq_relationships_zone", "dq_relationships_vendor"):
        row = dict(zip(*(lambda r: (r.columns, r.fetchall()[0]))(duck.sql(ORACLES[name]))))
        assert 0 < row["failing_rows"] < row["checked_rows"]


def test_a_wrong_order_turns_a_row_red(spark, duck, monkeypatch):
    """Served tables are compared by position, so their order is part of the result."""
    from tripmill.plans import models

    name = "served_agg_hourly_traffic"
    monkeypatch.setitem(models.SERVING_ORDER, "agg_hourly_traffic", "day_of_week DESC, pickup_hour")
    with pytest.raises(AssertionError):
        compare(contract.queries()[name](spark, SF), duck, contract.oracle_sql()[name])


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df, sql = contract.queries()[name](spark, SF), contract.oracle_sql()[name]
    assert type_names(df, duck, sql) == []
    assert compare(df, duck, sql) > 0
