"""From documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm.bpe import bpe_ids
from linkrank.llm.jaccard import Similarity, keep_firsts
from linkrank.llm.langid import UNKNOWN, identify, learn
from linkrank.llm.lines import dedup_lines
from linkrank.llm.mixing import mixed_documents
from linkrank.llm.queries import RANKS
from linkrank.llm.text import documents, packed, unpacked
from linkrank.plans.workspace import Workspace


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned from the labelled ones; texts without a
    letter go."""
    names = ("text",)
    found = identify(packed(docs, *names), learn(docs), "__lang", "__score")
    return unpacked(found.where(F.col("__lang") != UNKNOWN), docs.columns, names)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of lines that occurred before. One of which no line stays
    goes; ``n_chars`` follows the text."""
    cut = dedup_lines(Workspace(spark), docs).where(F.col("text") != "")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its shingles of five words."""
    return keep_firsts(Workspace(spark), docs, Similarity(5, 80))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(Workspace(spark), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids, n_tokens, ids_sha256, decoded_sha256)`` of the mix."""
    return bpe_ids(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("language", known_language),
    ("lines", without_repeated_lines),
    ("near duplicates", without_near_duplicates),
    ("mix", mixed),
    ("tokens", encoded),
]

#: Cross-parsing and merges are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    tables = Workspace(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = tables.save(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
