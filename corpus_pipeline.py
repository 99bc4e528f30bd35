"""From raw documents to packed batches: rules, language, near duplicates, personal data, packing.

Every stage works on all that the one before it kept, and all but the last return the columns of
``documents``. Inside a stage the columns have neutral names, so no column of the input can clash
with what an operator adds.

Defined results: null, empty and blank texts, and those too short, fail the rules and go; a null id is
no reason to go, and a group of near duplicates without ids keeps one row as well; of repeated rows
one stays; texts of any length are read whole; columns of the input stay, but for those named in
packing.OUTPUT, which the last stage replaces; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import jaccard, language, packing, pii, quality_rules
from tripmill.llm.shared import discard, source, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# SQL has neither the language model nor the disclosure statistics. Tests compare the rows of near_duplicates, personal_data and
# packing with brute force, those of language with its operator; the SQL of the rules is their operator's.
ORACLE_SQL = None


def _neutral(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    names = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _named(rows: DataFrame, names: dict[str, str], *more: str) -> DataFrame:
    return rows.select(*(F.col(own).alias(name) for name, own in names.items()), *more)


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the current policy over the rule ledger keeps."""
    rows, names = _neutral(docs)
    return _named(quality_rules.judge(quality_rules.ledger(rows, names["text"])).where("kept"), names)


def languages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents near enough to some language; the model is learned from this stage's input."""
    rows, names = _neutral(docs)
    key, text, lang = (names[c] for c in ("doc_id", "text", "lang"))
    model = language.fit(rows, key, text, lang)
    found = language.predict(rows, model, list(names.values()), text)
    return _named(found.where(~F.col("rejected")), names)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every group of near duplicates: five-word shingles, similarity 0.8."""
    rows, names = _neutral(docs)
    kept = jaccard.one_of_each(rows, names["doc_id"], names["text"], words=5, percent=80)
    return _named(kept, names)


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, personal data and disclosing terms replaced."""
    rows, names = _neutral(docs)
    return _named(pii.sanitise(rows, names["doc_id"], names["text"]), names)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents with their length bucket, batch and slot; these replace columns of their names."""
    rows, names = _neutral(docs)
    names = {name: own for name, own in names.items() if name not in packing.OUTPUT}
    packed = packing.pack(rows, packing.token_count(names["text"]), names["doc_id"])
    return _named(packed, names, *packing.OUTPUT)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("language", languages),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs, made = source(spark, folder, "documents"), []
    for name, stage in STAGES[:-1]:
        docs, place = stored(stage(spark, docs, folder), name)
        made.append(place)
    for place in made[:-1]:
        discard(spark, place)
    return STAGES[-1][1](spark, docs, folder)
