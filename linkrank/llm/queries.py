"""The thin queries over ``documents``, one for each operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm.bpe import Tables, bpe_ids
from linkrank.llm.conversations import damaged, repair_conversations, turns_digest
from linkrank.llm.exact import exact_duplicates
from linkrank.llm.jaccard import Similarity, near_duplicates
from linkrank.llm.langid import detect_languages
from linkrank.llm.lines import line_report
from linkrank.llm.main_text import main_text
from linkrank.llm.mixing import mix_sources
from linkrank.llm.pii import find_personal_data, span_digest
from linkrank.llm.quality import quality_rules
from linkrank.llm.sharding import shard_rows
from linkrank.llm.spelling import group_variants, vocabulary
from linkrank.llm.suffix import remove_repeats
from linkrank.llm.text import documents
from linkrank.plans.workspace import Workspace

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# What a worker keeps where encoding is all it does: some 550 MB.
KEPT = Tables(transitions=300_000, pieces=1_500_000)


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(find_personal_data(Workspace(spark), documents(spark, sf_dir)))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(Workspace(spark), documents(spark, sf_dir), Similarity(3, 90))
    return found.select("doc_id", "n_shingles", "component_id")


def op3_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(Workspace(spark), documents(spark, sf_dir))


def op4_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(Workspace(spark), documents(spark, sf_dir))


def op5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_languages(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(Workspace(spark), documents(spark, sf_dir))


def op7_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = line_report(Workspace(spark), documents(spark, sf_dir))
    return report.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(Workspace(spark), documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(Workspace(spark), documents(spark, sf_dir), 8)


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    encoded = bpe_ids(docs, RANKS, public_tokenizers.PATTERN, KEPT)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = main_text(Workspace(spark), spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    repaired = repair_conversations(Workspace(spark), damaged(turns))
    digests = turns_digest(repaired.pieces).withColumnRenamed("conv_id", "hashed")
    reports = repaired.reports.withColumnRenamed("conv_id", "repaired")
    zeros = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ids = turns.select("conv_id").distinct()
    return (
        ids.join(reports, F.col("conv_id").eqNullSafe(F.col("repaired")), "left")
        .join(digests, F.col("conv_id").eqNullSafe(F.col("hashed")), "left")
        .select(
            "conv_id",
            *(F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in zeros),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(Workspace(spark), vocabulary(documents(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_personal_data,
        op2_near_duplicates,
        op3_exact_duplicates,
        op4_repeated_strings,
        op5_languages,
        op6_quality_rules,
        op7_repeated_lines,
        op8_mix_sources,
        op9_shards,
        op10_token_ids,
        op11_main_text,
        op12_conversation_repair,
        op13_spelling_variants,
    )
}
