"""What the plans must look like for the work to scale."""

from __future__ import annotations

import re
from contextlib import redirect_stdout
from io import StringIO

import pytest
from pyspark.sql import functions as F

from linkrank.operators import graph as g
from linkrank.operators import ranks as r
from linkrank.operators.pages import page_links, parse_pages
from linkrank.operators.results import above_threshold, page_ranks, sorted_ranks
from linkrank.plans import workspace
from linkrank.plans.ranking import Layout, graph_from_pages
from tests import brute
from tests.test_graph import RECORDS, pages_of


BUCKETED = Layout(task_links=2)


def plan(df) -> str:
    out = StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_one_exchange_and_no_sort_per_iteration(spark, ws, no_broadcast):
    graph = graph_from_pages(ws, pages_of(spark, RECORDS), BUCKETED)
    state = r.init_ranks(graph.pages, graph.n)
    for steps in range(1, 4):
        state = r.rank_step(graph, state)
        with workspace.shuffled_into(state.sparkSession, graph.buckets):
            text = plan(state)
        assert len(re.findall(r"\bExchange\b", text)) == steps
        assert not re.search(r"\bSort\b|SortMergeJoin|Broadcast", text)


def test_large_page_tables_are_sorted_not_hashed(spark, ws, no_broadcast, monkeypatch):
    monkeypatch.setattr(r, "BUILD_ROWS", 0)
    graph = graph_from_pages(ws, pages_of(spark, RECORDS), BUCKETED)
    with workspace.shuffled_into(graph.pages.sparkSession, graph.buckets):
        text = plan(r.rank_step(graph, r.init_ranks(graph.pages, graph.n)))
    assert "ShuffledHashJoin" not in text and "SortMergeJoin" in text
    assert len(re.findall(r"\bExchange\b", text)) == 1


def test_sums_are_partial_before_the_shuffle(spark, ws, no_broadcast):
    graph = graph_from_pages(ws, pages_of(spark, RECORDS))
    sums = plan(r.contribution_sums(r.contributions(graph, r.init_ranks(graph.pages, graph.n))))
    assert sums.index("sum(c") < sums.index("Exchange") < sums.index("partial_sum")
    assert "partial_count" in plan(g.merge_copies(graph.edges))


def test_parsing_needs_no_shuffle_and_no_python(spark):
    records = spark.createDataFrame([(brute.page("a", "[[b]]"),)], "xml string")
    text = plan(g.link_pairs(page_links(parse_pages(records))))
    assert "Exchange" not in text and "Python" not in text


def test_ranks_read_only_their_columns(spark, ws):
    graph = graph_from_pages(ws, pages_of(spark, RECORDS))
    state = ws.save(r.init_ranks(graph.pages, graph.n), "state")
    text = plan(sorted_ranks(above_threshold(page_ranks(state), graph.n)))
    assert "ReadSchema: struct<page:bigint,pr:double>" in text
    assert "GreaterThanOrEqual(pr" in text and "rangepartitioning(pr" in text


def test_shuffle_setting_is_restored(spark):
    names = (workspace.SHUFFLE_PARTITIONS, workspace.INITIAL_PARTITIONS)
    before = [spark.conf.get(name, None) for name in names]
    with pytest.raises(ZeroDivisionError), workspace.shuffled_into(spark, 37):
        assert workspace.shuffle_tasks(spark) == 37
        assert spark.range(9).groupBy("id").count().rdd.getNumPartitions() <= 37
        1 / 0
    assert [spark.conf.get(name, None) for name in names] == before
    spark.conf.set(workspace.INITIAL_PARTITIONS, "11")
    try:
        assert workspace.shuffle_tasks(spark) == 11
    finally:
        spark.conf.unset(workspace.INITIAL_PARTITIONS)


def test_workspace_follows_the_session_setting(spark):
    folder = spark.conf.get(workspace.CHECKPOINT_DIR, None)
    found = workspace.Workspace(spark).folder
    assert folder is None or found.startswith(folder.rstrip("/"))


def test_shuffles_fit_the_graph(spark, ws):
    small = graph_from_pages(ws, pages_of(spark, RECORDS))
    assert small.buckets == 1
    graph = graph_from_pages(ws, pages_of(spark, RECORDS), Layout(task_links=1))
    assert graph.buckets == 12
    files = graph.edges.select(F.input_file_name()).distinct().count()
    assert files > 1
