"""Graph build and rank iterations over written tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.functions.score import DAMPING
from linkrank.operators import graph as g
from linkrank.operators import ranks as r
from linkrank.operators.pages import page_links
from linkrank.operators.skew import (
    HOT_ROWS,
    counted_hot_keys,
    hot_keys,
    hot_limit,
    join_keys,
    salted,
)
from linkrank.plans.workspace import Workspace, shuffle_tasks, shuffled_into

ITERATIONS = 8
# Links one task should take: at most this many, whatever the session's number of shuffle
# partitions, and not fewer than these where the session has partitions to spare.
TASK_LINKS = 4_000_000
SPARE_TASK_LINKS = 50_000
# What a session allows of buckets.
MAX_BUCKETS = "spark.sql.sources.bucketing.maxBuckets"
# Iterations planned as one job before the state is written.
STEPS_PER_WRITE = 4


@dataclass(frozen=True)
class Layout:
    """When to split keys, and how much a task takes; the defaults suit a large cluster."""

    hot_rows: int = HOT_ROWS
    task_links: int = TASK_LINKS
    steps_per_write: int = STEPS_PER_WRITE


@dataclass(frozen=True)
class LinkGraph:
    """Written tables ``links(src, dst, copies, dst_id)``, by the source's id and the
    target's title and id, and ``nodes(page, records, links, id)``.

    ``limit`` is the number of rows a key may hold before it is split, ``longest`` the
    largest number of links behind one source, red ones included.
    """

    links: DataFrame
    nodes: DataFrame
    n: int
    total: int
    longest: int
    limit: int
    tasks: int

    def hot_sources(self, name: str = "id") -> DataFrame | None:
        """Sources to split, by id or by page, as ``(src, shares)``: bounded by the limit."""
        if self.longest <= self.limit:
            return None
        return hot_keys(self.nodes, name, "links", self.limit).withColumnRenamed(name, "src")

    @property
    def edges(self) -> DataFrame:
        """``(src, dst, copies)`` by title."""
        links = self.links.select("src", "dst", "copies")
        return g.source_titles(links, self.nodes, self.hot_sources())

    def outlinks(self, row_links: int = g.ROW_LINKS) -> DataFrame:
        """``(page, part, outlinks)``: grouped by id, titles of the pages joined last."""
        ids = self.nodes.select(F.col("id").alias("page"))
        lists = g.outlinks(self.links.select("src", "dst", "copies"), ids, row_links)
        titles = self.nodes.select(F.col("id").alias("of"), F.col("page").alias("title"))
        return lists.join(titles, lists.page == titles["of"]).select(
            F.col("title").alias("page"), "part", "outlinks"
        )

    def inlinks(self, row_links: int = g.ROW_LINKS) -> DataFrame:
        """``(page, part, inlinks)``."""
        return g.inlinks(self.edges, self.nodes, row_links)


def link_graph_from_pages(
    ws: Workspace, pages: DataFrame, layout: Layout = Layout()
) -> LinkGraph:
    """Pages to graph. The markup is read once; all later steps read the link table."""
    own = ws.private()
    number = F.monotonically_increasing_id().alias("record")
    linked = own.save(lambda: page_links(pages).select("title", "links", number), "linked")
    return link_graph_from_records(ws, linked, layout)


def link_graph_from_records(
    ws: Workspace, linked: DataFrame, layout: Layout = Layout()
) -> LinkGraph:
    """A written table ``linked(record, title, links)`` to graph.

    Links cross the network by title once, to look their targets up.
    """
    ws = ws.private()
    nodes = ws.save(lambda: g.page_nodes(linked), "nodes")
    size = _size(ws, nodes)

    def links(limit: int) -> DataFrame:
        if size["records"] <= 1:
            return g.record_links(linked)
        shared = ws.save(lambda: g.shared_titles(linked, nodes), "shared")
        return g.record_links(linked, shared, shared.count())

    targets = linked.select(F.explode("links").alias("dst"))
    return _link_graph(ws, links, targets, nodes, size, layout)


def link_graph_from_pairs(
    ws: Workspace, pairs: DataFrame, nodes: DataFrame, layout: Layout = Layout()
) -> LinkGraph:
    """Link pairs and ``nodes(page, records, links)`` to graph.

    Every ``src`` must be a page; pairs may only repeat where a page has several records.
    Pairs name their source by title, so it is looked up as well. Pass pairs of a written
    table: they may be read twice.
    """
    ws, numbered = ws.private(), g.numbered_pages(nodes)
    nodes = ws.save(lambda: numbered, "nodes")
    size = _size(ws, nodes)

    def links(limit: int) -> DataFrame:
        merged = g.merge_copies(pairs) if size["records"] > 1 else g.single_copies(pairs)
        hot = None
        if size["longest"] > limit:
            hot = hot_keys(nodes, "page", "links", limit).withColumnRenamed("page", "src")
        return g.source_ids(merged, nodes, hot)

    return _link_graph(ws, links, pairs.select("dst"), nodes, size, layout)


def _size(ws: Workspace, nodes: DataFrame) -> dict[str, int]:
    counted = nodes.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.max("records"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("links"), F.lit(0)).alias("links"),
        F.coalesce(F.max("links"), F.lit(0)).alias("longest"),
    )
    return ws.value("size", lambda: counted.first().asDict())


def _link_graph(
    ws: Workspace,
    links: Callable[[int], DataFrame],
    targets: DataFrame,
    nodes: DataFrame,
    size: dict[str, int],
    layout: Layout,
) -> LinkGraph:
    tasks = ws.value("tasks", lambda: _tasks(shuffle_tasks(ws.spark), size["links"], layout))
    limit = hot_limit(size["links"], tasks, layout.hot_rows)

    def existing() -> DataFrame:
        hot_targets = counted_hot_keys(targets, "dst", size["links"], limit)
        return g.existing_links(links(limit), nodes, hot_targets)

    with shuffled_into(ws.spark, tasks):
        found = ws.save(existing, "edges")
    return LinkGraph(found, nodes, size["n"], size["links"], size["longest"], limit, tasks)


def _tasks(session: int, links: int, layout: Layout) -> int:
    """The session's number of shuffle partitions, unless the graph is far off it."""
    useful = min(session, math.ceil(links / SPARE_TASK_LINKS))
    return max(1, useful, math.ceil(links / layout.task_links))


def rank_graph(ws: Workspace, graph: LinkGraph) -> r.RankGraph:
    """Lay the graph out for iterations.

    It is bucketed by id: each iteration shuffles an id and a number per target and task
    instead of a title, and shuffles the edges themselves never. There are as many buckets as
    tasks, up to what the session allows of them; beyond that a bucket holds more.
    """
    ws = ws.private()
    most = int(ws.spark.conf.get(MAX_BUCKETS))
    buckets = ws.value("buckets", lambda: min(graph.tasks, most))
    hot = graph.hot_sources()
    if hot is not None:
        hot = ws.save(hot, "hot_sources")

    def edges() -> DataFrame:
        ids = graph.links.select("src", F.col("dst_id").alias("dst"), "copies")
        return salted(ids, hot, "src", F.col("dst"))

    def pages() -> DataFrame:
        titles = graph.nodes.select(F.col("id").alias("page"), F.col("page").alias("title"))
        return g.page_degrees(titles, laid_out)

    with shuffled_into(ws.spark, buckets):
        laid_out = ws.save_bucketed(edges, "edges_by_source", join_keys(hot, "src"), buckets)
        by_page = ws.save_bucketed(pages, "pages", ["page"], buckets)
    return r.RankGraph(laid_out, by_page, graph.n, buckets, hot)


def graph_from_pages(ws: Workspace, pages: DataFrame, layout: Layout = Layout()) -> r.RankGraph:
    """Pages to the graph the iterations run on."""
    return rank_graph(ws, link_graph_from_pages(ws, pages, layout))


def graph_from_pairs(
    ws: Workspace, pairs: DataFrame, nodes: DataFrame, layout: Layout = Layout()
) -> r.RankGraph:
    """Link pairs and nodes to the graph the iterations run on."""
    return rank_graph(ws, link_graph_from_pairs(ws, pairs, nodes, layout))


def rank_pages(
    ws: Workspace,
    graph: r.RankGraph,
    iterations: int = ITERATIONS,
    damping: float = DAMPING,
    keep: Collection[int] = (),
    start: DataFrame | None = None,
    done: int = 0,
    layout: Layout = Layout(),
) -> dict[int, DataFrame]:
    """Run iterations ``done + 1`` to ``iterations``; ``(page, pr)`` by iteration kept.

    ``start`` holds the ranks after iteration ``done``. The kept iterations (the last
    one always) are written, and so is the state every few steps: the plan stays short
    and a lost executor costs at most those steps.
    """
    ws = ws.private()
    if start is None:
        state = r.init_ranks(graph.pages, graph.n)
    else:
        state = r.start_ranks(graph, ws.save(start, "start"))
    kept = {}
    planned = 0
    for i in range(done + 1, iterations + 1):
        state = r.rank_step(graph, state, damping)
        planned += 1
        if i in keep or i == iterations or planned == layout.steps_per_write:
            with shuffled_into(ws.spark, graph.buckets):
                state = ws.save_bucketed(state, f"ranks_{i}", ["page"], graph.buckets)
            planned = 0
        if i in keep or i == iterations:
            kept[i] = graph.titled(state)
    return kept


def snapshots(kept: dict[int, DataFrame]) -> DataFrame:
    """The kept iterations as one table with an ``iteration`` column."""
    tables = [df.select(F.lit(i).alias("iteration"), "*") for i, df in sorted(kept.items())]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result
