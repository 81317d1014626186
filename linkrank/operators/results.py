"""From ranks to the published result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD_FACTOR = 5.0


def page_ranks(state: DataFrame) -> DataFrame:
    """Drop everything but page and rank."""
    return state.select("page", "pr")


def above_threshold(ranks: DataFrame, n: int, factor: float = THRESHOLD_FACTOR) -> DataFrame:
    """Ranks of at least ``factor / n``, the bound included."""
    return ranks.where(F.col("pr") >= F.lit(factor / max(n, 1)))


def sorted_ranks(ranks: DataFrame) -> DataFrame:
    """Highest rank first, ties by page: range-partitioned, no single-task sort."""
    return ranks.orderBy(F.desc("pr"), "page")
