"""``run`` over whole tables of hard rows, and over none."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tripmill.llm import packing


@pytest.fixture
def ran(spark, folder):
    def run(docs):
        docs.write.parquet(f"{folder}/documents.parquet")
        return corpus_pipeline.run(spark, folder)

    return run


def test_hard_rows(documents, hard_rows, ran):
    words = "the house with many windows stands near the river and shines in the morning while others sleep".split()
    clean = [(100 + i, " ".join(words[(i * k) % len(words)] + ("" if k % 3 else f"x{i}") for k in range(1, 40)), "en") for i in range(1, 13)]
    without_id = [(None, clean[0][1].replace("house", f"barn{k // 2} number"), "en") for k in range(4)]
    docs = documents(*hard_rows, *clean, clean[0], *without_id, clash=True).withColumn("batch", F.lit("mine"))
    out = ran(docs)
    assert set(out.columns) == {*docs.columns, *packing.OUTPUT} and len(out.columns) == len(set(out.columns))
    ids = [r.doc_id for r in out.collect()]
    # Null, empty, blank and one-word texts go; a repeated row stays once.
    assert not {1, 2, 3, 4, 5} & set(ids) and ids.count(101) == 1
    assert all(ids.count(k) == 1 for k, *_ in clean)


def test_empty_table(documents, ran):
    out = ran(documents((1, "a")).limit(0))
    assert out.count() == 0 and set(packing.OUTPUT) <= set(out.columns)
