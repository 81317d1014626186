"""Rank operators: one iteration is a join, a sum per target and a damped update.

State is ``pages(page, deg, pr)``. Dangling pages send nothing and their rank is not
handed to anyone, so the ranks sum to less than one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.functions import score
from linkrank.operators.skew import SALT, join_keys, replicated

# Rows a task may hash for a join.
BUILD_ROWS = 4_000_000


@dataclass(frozen=True)
class RankGraph:
    """Tables an iteration reads again and again.

    ``edges(src, dst, copies)`` and ``pages(page, deg, title)`` name pages by id and are
    bucketed: edges by ``src`` (and by salt when some sources are hot), pages by ``page``.
    ``buckets`` is the number of buckets and of tasks that shuffles use.
    """

    edges: DataFrame
    pages: DataFrame
    n: int
    buckets: int
    hot_sources: DataFrame | None = None

    def titled(self, state: DataFrame) -> DataFrame:
        """``(page, pr)`` of a state, by title."""
        titles = self.pages.select("page", "title")
        named = self.per_page(state.select("page", "pr")).join(titles, "page")
        return named.select(F.col("title").alias("page"), "pr")

    def with_titles(self, df: DataFrame, *columns: str) -> DataFrame:
        """Replace ids in these columns by titles."""
        for name in columns:
            titles = self.pages.select(F.col("page").alias(name), F.col("title").alias("_title"))
            others = [F.col("_title").alias(name) if c == name else F.col(c) for c in df.columns]
            df = df.join(titles, name).select(*others)
        return df

    def per_page(self, df: DataFrame) -> DataFrame:
        """A table with one row per page, as the build side of a partition-wise join.

        Such rows spread evenly by hash, so the number of pages bounds what a partition
        builds. Where that is little, hashing spares both sides a sort per iteration;
        beyond it the join sorts and can spill.
        """
        small = self.n <= self.buckets * BUILD_ROWS
        return df.hint("shuffle_hash") if small else df


def init_ranks(pages: DataFrame, n: int) -> DataFrame:
    """The state before the first iteration."""
    return pages.select("page", "deg", score.initial_rank(n).alias("pr"))


def start_ranks(graph: RankGraph, ranks: DataFrame) -> DataFrame:
    """The state that ranks computed earlier, by title, stand for."""
    known = ranks.select(F.col("page").alias("title"), "pr")
    return graph.pages.join(known, "title").select("page", "deg", "pr")


def contributions(graph: RankGraph, state: DataFrame) -> DataFrame:
    """``(src, dst, copies, c)``: what each edge carries in this iteration."""
    shares = state.where(F.col("deg") > 0).select(F.col("page").alias("src"), "deg", "pr")
    shares = replicated(shares, graph.hot_sources, "src")
    sent = score.contribution(F.col("pr"), F.col("deg"), F.col("copies"))
    return graph.edges.join(graph.per_page(shares), join_keys(graph.hot_sources, "src")).select(
        "src", "dst", "copies", sent.alias("c")
    )


def contribution_sums(contribs: DataFrame) -> DataFrame:
    """``(dst, s)``: sum received per target, summed per task before the shuffle."""
    return contribs.groupBy("dst").agg(F.sum("c").alias("s"))


def rank_step(
    graph: RankGraph, state: DataFrame, damping: float = score.DAMPING
) -> DataFrame:
    """The state after one more iteration; every page keeps a row."""
    received = contribution_sums(contributions(graph, state)).withColumnRenamed("dst", "page")
    return graph.pages.join(graph.per_page(received), "page", "left").select(
        "page", "deg", score.damped_rank(F.col("s"), graph.n, damping).alias("pr")
    )


def rank_matrix(ranks: DataFrame, lists: DataFrame) -> DataFrame:
    """``(page, part, pr, outlinks)``: each page's rank beside its outlink rows.

    A page whose outlinks take several rows meets them by part, not all at once; the
    outlink operator bounds how many such pages there are.
    """
    parts = (
        lists.where("part > 0").groupBy("page").agg((F.max("part") + 1).alias("shares"))
    )
    by_part = replicated(ranks.select("page", "pr"), parts, "page").withColumnRenamed(SALT, "part")
    return lists.join(by_part, ["page", "part"]).select("page", "part", "pr", "outlinks")
