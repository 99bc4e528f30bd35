import __spark_entry__ as contract
import corpus_pipeline
import duckdb
import pytest
from oracle import compare, type_names

from tripmill.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(name.split("_")[0][2:]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14)) and {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert type_names(df, duck, ORACLES[name]) == []
    assert compare(df, duck, ORACLES[name]) > 0


def test_pipeline_stages(spark, documents, hard_rows, folder):
    words = "the house with many windows stands near the river and shines in the morning while others sleep".split()
    clean = [(100 + i, " ".join(words[(i * k) % len(words)] + ("" if k % 3 else f"x{i}") for k in range(1, 40)), "en") for i in range(1, 13)]
    copy = (200, clean[0][1] + " indeed", "en")
    mail = (201, clean[3][1].replace("house", "home") + " write to boss@corp.example now and then for a while longer than that", "en")
    docs = documents(*hard_rows, *clean, copy, mail, clash=True)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    found = {r.doc_id: r.text for r in docs.collect()}
    assert len(found) == docs.count() and 101 in found and 200 not in found and not {1, 2, 3, 4, 5} & set(found)
    assert "boss@corp.example" not in found[201] and "[EMAIL]" in found[201]


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() == rows.select("doc_id").distinct().count() > 700
