"""Readers for what the sinks write.

Text forms separate fields by white space; titles that hold white space, and empty ones, are
escaped there and read back as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.functions.tokens import from_token

PARQUET = "parquet"
TEXT = "text"


def _tokens(spark: SparkSession, path: str) -> DataFrame:
    words = F.array_remove(F.split("value", r"\s+"), F.lit(""))
    return spark.read.text(path).select(words.alias("t")).where(F.size("t") > 0)


def _title(position: int) -> Column:
    return from_token(F.get("t", F.lit(position)))


def _from(position: int) -> Column:
    return F.transform(F.slice("t", position, F.size("t")), from_token)


def _read_lists(spark: SparkSession, path: str, name: str, format: str) -> DataFrame:
    if format == PARQUET:
        return spark.read.parquet(path)
    return _tokens(spark, path).select(_title(0).alias("page"), _from(2).alias(name))


def read_outlinks(spark: SparkSession, path: str, format: str = PARQUET) -> DataFrame:
    """``(page, outlinks)``; a long page may take several rows."""
    return _read_lists(spark, path, "outlinks", format)


def read_inlinks(spark: SparkSession, path: str, format: str = PARQUET) -> DataFrame:
    """``(page, inlinks)``; a long page may take several rows."""
    return _read_lists(spark, path, "inlinks", format)


def read_count(spark: SparkSession, path: str) -> int:
    """The number after ``N=``."""
    number = F.regexp_extract("value", r"^N=(\d+)", 1)
    return int(spark.read.text(path).where(F.startswith("value", F.lit("N="))).select(number).first()[0])


def read_rank_matrix(spark: SparkSession, path: str, format: str = PARQUET) -> DataFrame:
    """``(page, pr, outlinks)``."""
    if format == PARQUET:
        return spark.read.parquet(path)
    return _tokens(spark, path).select(
        _title(0).alias("page"),
        F.get("t", F.lit(1)).cast("double").alias("pr"),
        _from(3).alias("outlinks"),
    )


def read_ranks(spark: SparkSession, path: str, format: str = PARQUET) -> DataFrame:
    """``(page, pr)``, from ranks, sorted ranks or a rank matrix; one row per page."""
    ranks = spark.read.parquet(path) if format == PARQUET else read_rank_matrix(spark, path, TEXT)
    if "part" in ranks.columns:
        return ranks.where("part = 0").select("page", "pr")
    # A long page's rows in text repeat its rank digit by digit.
    ranks = ranks.select("page", "pr")
    return ranks.distinct() if format == TEXT else ranks
