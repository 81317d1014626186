from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from linkrank import sinks, sources
from linkrank.operators import graph as g
from linkrank.operators import ranks as r
from linkrank.operators.results import above_threshold, sorted_ranks
from linkrank.plans.ranking import (
    Layout,
    graph_from_pages,
    graph_from_pairs,
    link_graph_from_pages,
    rank_graph,
    rank_pages,
    snapshots,
)
from tests import brute
from tests.test_graph import pages_of

GOLDEN = {"A": "[[B]] [[C]]", "B": "[[C]]", "C": "[[A]] [[E]]", "D": "[[C]]", "E": ""}
GOLDEN_RANKS = {
    1: {"A": 0.115, "B": 0.115, "C": 0.455, "D": 0.03, "E": 0.115},
    2: {"A": 0.223375, "B": 0.078875, "C": 0.202125, "D": 0.03, "E": 0.223375},
    8: {
        "A": 0.10164099921,
        "B": 0.074554555209,
        "C": 0.163244976397,
        "D": 0.03,
        "E": 0.10164099921,
    },
}

PLAIN = Layout()
BUCKETED = Layout(task_links=3)
SALTED = Layout(hot_rows=20, task_links=50)


def as_dict(ranks):
    return {row.page: row.pr for row in ranks.collect()}


@pytest.fixture
def golden(spark, ws):
    return graph_from_pages(ws, pages_of(spark, list(GOLDEN.items())))


def test_golden_graph(ws, golden):
    kept = rank_pages(ws, golden, keep=(1, 2))
    assert sorted(kept) == [1, 2, 8]
    for i, expected in GOLDEN_RANKS.items():
        assert {p: round(pr, 12) for p, pr in as_dict(kept[i]).items()} == expected
    table = snapshots(kept)
    assert table.columns == ["iteration", "page", "pr"] and table.count() == 15


def test_one_step(spark, ws):
    links = link_graph_from_pages(ws, pages_of(spark, list(GOLDEN.items())))
    golden = rank_graph(ws, links)
    state = r.init_ranks(golden.pages, golden.n)
    assert {row.pr for row in state.collect()} == {0.2}
    by_id = r.contributions(golden, state)
    sent = {(x.src, x.dst): x.c for x in golden.with_titles(by_id, "src", "dst").collect()}
    assert sent["A", "B"] == 0.1 and sent["B", "C"] == 0.2
    by_target = golden.with_titles(r.contribution_sums(by_id), "dst")
    sums = {x.dst: x.s for x in by_target.collect()}
    assert sums["C"] == pytest.approx(0.5) and "D" not in sums
    step = as_dict(golden.titled(r.rank_step(golden, state)))
    assert step == pytest.approx(GOLDEN_RANKS[1])


def test_duplicate_titles_weigh_per_record(spark, ws):
    graph = graph_from_pages(
        ws, pages_of(spark, [("A", "[[B]] [[B]]"), ("A", "[[B]]"), ("B", "[[A]]")])
    )
    assert graph.n == 2
    assert {row.title: row.deg for row in graph.pages.collect()} == {"A": 2, "B": 1}
    assert as_dict(rank_pages(ws, graph, 3)[3]) == pytest.approx({"A": 0.5, "B": 0.5})


def random_records(pages, links, seed):
    """Random records with a source and a target that hold about a third of the links."""
    rng = random.Random(seed)
    title = [f"Page {i}" for i in range(pages)]
    records = []
    for name in title:
        targets = rng.sample(title, rng.randrange(links)) + ["Page 1"] * rng.randrange(2)
        records.append((name, " ".join(f"[[{t}]]" for t in targets + [f"Red {name}"])))
    records.append((title[2], " ".join(f"[[{t}]]" for t in title)))
    records += [(title[5], "[[Page 6]] [[Page 1]]")] * (pages // 2)
    records += [(title[7], None)]
    return records


@pytest.fixture(scope="module")
def records():
    return random_records(250, 8, seed=3)


@pytest.mark.parametrize("layout", [PLAIN, BUCKETED, SALTED], ids=["plain", "bucketed", "salted"])
def test_layouts_agree_with_brute_force(spark, ws, records, layout):
    links = link_graph_from_pages(ws, pages_of(spark, records), layout)
    graph = rank_graph(ws, links)
    assert (graph.hot_sources is not None) == (layout is SALTED)
    pages, edges = brute.graph(records)
    assert {(x.src, x.dst): x.copies for x in links.edges.collect()} == dict(edges)
    assert graph.edges.count() == len(edges)
    kept = rank_pages(ws, graph, keep=(1,), layout=layout)
    for i in (1, 8):
        assert as_dict(kept[i]) == pytest.approx(brute.ranks(pages, edges, i), rel=1e-12)


def test_hot_sources_spread_over_salts(spark, ws, records):
    graph = graph_from_pages(ws, pages_of(spark, records), SALTED)
    sizes = graph.edges.groupBy("src", "salt").count()
    largest = sizes.agg(F.max("count")).first()[0]
    whole = g.out_degree(graph.edges).agg(F.max("deg")).first()[0]
    assert whole > 200 and largest < whole / 3


@pytest.mark.parametrize("steps", [1, 3, 100])
def test_state_writes_do_not_change_ranks(spark, ws, records, steps):
    layout = Layout(steps_per_write=steps)
    graph = graph_from_pages(ws, pages_of(spark, records[:120]), layout)
    pages, edges = brute.graph(records[:120])
    ranks = as_dict(rank_pages(ws, graph, 5, layout=layout)[5])
    assert ranks == pytest.approx(brute.ranks(pages, edges, 5), rel=1e-12)


@pytest.mark.parametrize("layout", [PLAIN, BUCKETED], ids=["plain", "bucketed"])
def test_resume_from_a_snapshot(spark, ws, records, layout):
    graph = graph_from_pages(ws, pages_of(spark, records), layout)
    whole = as_dict(rank_pages(ws, graph, 6, layout=layout)[6])
    sinks.write_ranks(rank_pages(ws, graph, 2, layout=layout)[2], ws.path("snapshot"))
    start = sources.read_ranks(spark, ws.path("snapshot"))
    resumed = rank_pages(ws, graph, 6, start=start, done=2, layout=layout)
    assert as_dict(resumed[6]) == pytest.approx(whole, rel=1e-12)


def test_invariants(spark, ws, records):
    graph = graph_from_pages(ws, pages_of(spark, records))
    kept = rank_pages(ws, graph, 4, keep=(1, 2, 3))
    total = 1.0
    for i in range(1, 5):
        row = kept[i].agg(
            F.count("page").alias("n"), F.sum("pr").alias("s"), F.min("pr").alias("low")
        ).first()
        assert row.n == graph.n and row.low >= 0.15 / graph.n - 1e-15
        assert row.s <= total + 1e-12
        total = row.s


def test_pairs_api_damping_and_empty_graph(spark, ws):
    pairs = spark.createDataFrame([("a", "b"), ("a", "gone")], "src string, dst string")
    nodes = spark.createDataFrame(
        [("a", 1, 2), ("b", 1, 0)], "page string, records int, links int"
    )
    graph = graph_from_pairs(ws, pairs, nodes)
    assert as_dict(rank_pages(ws, graph, 1, damping=0.5)[1]) == {"a": 0.25, "b": 0.5}
    empty = graph_from_pages(ws.__class__(spark, ws.folder), pages_of(spark, [("x", None)]))
    assert empty.n == 0


def test_threshold_is_inclusive_and_order_descends(spark):
    ranks = spark.createDataFrame(
        [("a", 0.5), ("b", 0.7), ("c", 0.5), ("d", 0.4999)], "page string, pr double"
    )
    top = above_threshold(ranks, 10)
    assert [row.page for row in sorted_ranks(top).collect()] == ["b", "a", "c"]
    assert above_threshold(ranks, 5).count() == 0
    assert above_threshold(ranks, 10, factor=1).count() == 4


def test_rank_matrix_with_split_lists(spark, ws, records):
    links = link_graph_from_pages(ws, pages_of(spark, records))
    ranks = rank_pages(ws, rank_graph(ws, links), 1)[1]
    expected = as_dict(ranks)
    lists = ws.save(g.outlinks(links.edges, links.nodes, row_links=10), "lists")
    rows = r.rank_matrix(ranks, lists).collect()
    assert len(rows) == lists.count() > links.n
    assert all(row.pr == expected[row.page] for row in rows)
