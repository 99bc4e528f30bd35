"""The registered query of each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import bpe, chat, hard_negatives, jaccard, language, lexical_search, pii, secret_scan, vector_dedup, weak_labels
from tripmill.llm.oracles import ORACLES  # noqa: F401
from tripmill.llm.packing import pack, token_count
from tripmill.llm.quality_rules import ablations, judge, ledger
from tripmill.llm.shared import source
from tripmill.llm.url_graph import judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(source(spark, folder, "conversations"))


def op2_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    docs = source(spark, folder, "documents").select("doc_id", token_count().alias("n_tokens"))
    return pack(docs, docs["n_tokens"])


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(source(spark, folder, "documents"), vocabulary, public_tokenizers.PATTERN)


def op4_language_centroids(spark: SparkSession, folder: str) -> DataFrame:
    docs = source(spark, folder, "documents")
    found = language.predict(docs, language.fit(docs))
    return found.withColumn("held_out", language.held_out())


def op5_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge(ledger(source(spark, folder, "documents").select("doc_id", "text")))
    return judged.drop("text")


def quality_ablations(spark: SparkSession, folder: str) -> DataFrame:
    return ablations(ledger(source(spark, folder, "documents").select("doc_id", "text")))


def op6_sorted_projections(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_duplicates(source(spark, folder, "embeddings"))


def op7_weak_labels(spark: SparkSession, folder: str) -> DataFrame:
    docs = source(spark, folder, "documents")
    return weak_labels.score(docs, weak_labels.fit(docs))


def op8_disclosing_terms(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(source(spark, folder, "documents"))


def op9_url_graph(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(source(spark, folder, "pages"))


def op10_shingle_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(source(spark, folder, "documents"))


def op11_k2_treap(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search_documents(source(spark, folder, "documents"), source(spark, folder, "benchmark"))


def op12_anchor_tree(spark: SparkSession, folder: str) -> DataFrame:
    # Fixed rule of the table: the label of every seventh vector counts as the next one.
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(source(spark, folder, "embeddings"), label=label)


def op13_secret_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(source(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_chat_repair": op1_chat_repair,
    "op2_length_buckets": op2_length_buckets,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_language_centroids": op4_language_centroids,
    "op5_quality_ledger": op5_quality_ledger,
    "quality_ablations": quality_ablations,
    "op6_sorted_projections": op6_sorted_projections,
    "op7_weak_labels": op7_weak_labels,
    "op8_disclosing_terms": op8_disclosing_terms,
    "op9_url_graph": op9_url_graph,
    "op10_shingle_tiles": op10_shingle_tiles,
    "op11_k2_treap": op11_k2_treap,
    "op12_anchor_tree": op12_anchor_tree,
    "op13_secret_automaton": op13_secret_automaton,
}
