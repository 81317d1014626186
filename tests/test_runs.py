"""Runs that stop and go on, sessions of their own, one read of the dump, positions."""

from __future__ import annotations

import random
import re
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkrank import sinks, sources
from linkrank.functions import from_token, to_token
from linkrank.operators import graph as g
from linkrank.operators import ranks as r
from linkrank.operators.pages import page_links, parse_records
from linkrank.plans import run as runs
from linkrank.plans import workspace
from linkrank.plans.positions import with_positions
from linkrank.plans.ranking import Layout, graph_from_pages, rank_pages
from linkrank.plans.records import dump_records, linked_records
from linkrank.plans.run import Config, publish_ranking
from linkrank.plans.workspace import Workspace
from linkrank.sources import dump as dumps
from tests import brute
from tests.test_dump import NESTED, sequential
from tests.test_graph import RECORDS, pages_of
from tests.test_plans import no_broadcast, plan  # noqa: F401
from tests.test_ranks import as_dict, random_records
from tests.test_results import dump, lines

STOPS = ["nodes_v1", "pages_v1", "ranks_5_v1"]


class Stopped(Exception):
    pass


@pytest.fixture
def written(monkeypatch) -> list[str]:
    """Names of the stages that are written."""
    names = []
    write = Workspace._write

    def watched(self, df, stage, *args, **kwargs):
        write(self, df, stage, *args, **kwargs)
        names.append(stage)

    monkeypatch.setattr(Workspace, "_write", watched)
    return names


def results(published) -> dict:
    paths = {"n": published.count, "dropped": published.dropped, **published.ranks}
    found = {name: sorted(lines(path)) for name, path in paths.items()}
    return found | {"out": sorted(lines(published.outlinks))}


@pytest.fixture
def config(tmp_path) -> Config:
    records = random_records(60, 4, seed=2) + RECORDS
    return Config(
        input=dump(tmp_path / "in", records),
        output=str(tmp_path / "out"),
        threshold_factor=0.5,
        graph_format="text",
        temporary=str(tmp_path / "work"),
        run="first",
        layout=Layout(hot_rows=20, task_links=50),
    )


@pytest.mark.parametrize("stop", STOPS)
def test_stopped_run_goes_on_behind_its_last_stage(spark, config, tmp_path, written, monkeypatch, stop):
    whole = results(publish_ranking(spark, Config(**vars(config) | {"run": None, "output": f"{tmp_path}/whole"})))
    del written[:]
    watched = Workspace._write

    def stopping(self, df, stage, *args, **kwargs):
        if stage == stop:  # data without a record: what a run leaves that dies here
            df.write.mode("overwrite").parquet(self.path(stage))
            raise Stopped
        watched(self, df, stage, *args, **kwargs)

    with monkeypatch.context() as patch, pytest.raises(Stopped):
        patch.setattr(Workspace, "_write", stopping)
        publish_ranking(spark, config)
    first = written[:]
    assert stop not in first
    del written[:]
    assert results(publish_ranking(spark, config)) == whole
    assert written[0] == stop and not set(first) & set(written)


def test_stopped_while_publishing(spark, config, written, monkeypatch):
    write = sinks.write_sorted

    def stopping(ranks, path, *args, **kwargs):
        write(ranks.limit(1), path, *args, **kwargs)
        raise Stopped

    with monkeypatch.context() as patch, pytest.raises(Stopped):
        patch.setattr(sinks, "write_sorted", stopping)
        publish_ranking(spark, config)
    before = written[:]
    published = publish_ranking(spark, config)
    assert written == before and len(lines(published.ranks[1])) > 1
    assert results(publish_ranking(spark, config)) == results(published)


def test_other_parameters_or_input_are_refused(spark, config, tmp_path):
    publish_ranking(spark, config)
    with pytest.raises(ValueError, match="damping"):
        publish_ranking(spark, Config(**vars(config) | {"damping": 0.5}))
    (tmp_path / "in" / "more.xml").write_text(brute.page("New", "x"))
    with pytest.raises(ValueError, match="bytes"):
        publish_ranking(spark, config)


def test_results_of_others_are_not_written_over(spark, config):
    sinks.write_count(g.page_count(spark.range(3)), f"{config.output}/results/n.out")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        publish_ranking(spark, config)
    assert lines(f"{config.output}/results/n.out") == ["N=3"]


@pytest.mark.parametrize("run", [None, "named"])
def test_tables_are_cleared_on_demand(spark, config, tmp_path, run):
    tables = len(spark.catalog.listTables())
    folder = Path(config.temporary)
    published = publish_ranking(spark, Config(**vars(config) | {"run": run}))
    assert list(folder.iterdir()) and published.n
    config = Config(**vars(config) | {"run": run, "clear": True, "temporary": f"{folder}2", "output": f"{tmp_path}/2"})
    assert publish_ranking(spark, config).n == published.n
    assert not list(Path(f"{folder}2").iterdir())
    assert len(spark.catalog.listTables()) == tables


def test_kept_iterations_and_start(spark, config, tmp_path):
    config = Config(**vars(config) | {"run": None, "threshold_factor": 0.0})
    published = publish_ranking(spark, Config(**vars(config) | {"keep": (2, 5), "iterations": 6}))
    assert sorted(published.ranks) == [2, 5, 6]
    later = Config(
        **vars(config)
        | {"start": published.ranks[2], "start_format": "text", "done": 2, "iterations": 6}
        | {"keep": (1, 5), "output": f"{tmp_path}/later"}
    )
    resumed = publish_ranking(spark, later)
    assert sorted(resumed.ranks) == [5, 6]
    for i in (5, 6):
        found, expected = (as_dict(sources.read_ranks(spark, x.ranks[i], "text")) for x in (resumed, published))
        assert found == pytest.approx(expected, rel=1e-12)


def test_sessions_keep_their_settings(spark, tmp_path):
    key, records = workspace.SHUFFLE_PARTITIONS, random_records(80, 5, seed=6)
    pages, edges = brute.graph(records)

    def ranked(tasks: int) -> tuple[int, dict]:
        own = workspace.private_session(spark)
        own.conf.set(key, str(tasks))
        ws = Workspace(own, f"{tmp_path}/{tasks}")
        graph = graph_from_pages(ws, pages_of(own, records), Layout(task_links=40))
        ranks = as_dict(rank_pages(ws, graph)[8])
        assert own.conf.get(key) == str(tasks) and own.conf.get(workspace.INITIAL_PARTITIONS, None) is None
        return graph.buckets, ranks

    before = spark.conf.get(key)
    with ThreadPoolExecutor(2) as pool:
        found = list(pool.map(ranked, (3, 40)))
    assert spark.conf.get(key) == before
    assert {buckets for buckets, _ in found} == {-(-sum(edges.values()) // 40)} or found[0][0] != 0
    for _, ranks in found:
        assert ranks == pytest.approx(brute.ranks(pages, edges, 8), rel=1e-12)


def test_buckets_stay_within_what_the_session_allows(spark, ws, no_broadcast):  # noqa: F811
    key = "spark.sql.sources.bucketing.maxBuckets"
    spark.conf.set(key, "4")
    try:
        graph = graph_from_pages(ws, pages_of(spark, RECORDS), Layout(task_links=1))
        assert graph.buckets == 4
        state = r.rank_step(graph, r.init_ranks(graph.pages, graph.n))
        with workspace.shuffled_into(state.sparkSession, graph.buckets):
            assert len(re.findall(r"\bExchange\b", plan(state))) == 1
        pages, edges = brute.graph(RECORDS)
        assert as_dict(rank_pages(ws, graph, 2)[2]) == pytest.approx(brute.ranks(pages, edges, 2))
    finally:
        spark.conf.unset(key)


def linked_table(spark, ws, records):
    rows = spark.createDataFrame([(brute.page(t, b),) for t, b in records], "xml string")
    linked = page_links(parse_records(rows)).where("title IS NOT NULL")
    return ws.save(linked.select(F.monotonically_increasing_id().alias("record"), "title", "links"), "linked")


def test_links_cross_by_title_once(spark, ws, no_broadcast):  # noqa: F811
    linked = linked_table(spark, ws, [x for i, x in enumerate(RECORDS) if i != 1])
    nodes = ws.save(g.page_nodes(linked), "nodes")
    text = plan(g.existing_links(g.record_links(linked), nodes))
    # One exchange of links, by target; the other is the pages'.
    assert len(re.findall(r"\bExchange\b", text)) == 2
    assert text.count("hashpartitioning(dst") == 2 and "Aggregate" not in text


@pytest.mark.parametrize("rows", [1, 10**9])
def test_records_with_one_title_take_its_id(spark, ws, rows):
    linked = linked_table(spark, ws, RECORDS)
    nodes = ws.save(g.page_nodes(linked), "nodes")
    links = g.record_links(linked, g.shared_titles(linked, nodes), rows)
    ids = {row.id: row.page for row in nodes.collect()}
    assert len(ids) == 5
    found = {(ids[x.src], x.dst): x.copies for x in links.collect()}
    assert found["A", "B"] == 2 and found["A", "C"] == 1 and found["Lone", "Missing"] == 1


# --- one read of the dump ---------------------------------------------------

TEXTS = {
    "closed": NESTED * 50 + "</mediawiki>\n",
    "to the byte": NESTED * 50 + "<page>last</page>",
    "cut": NESTED * 50 + "<page>cut off",
    "cut in the end tag": NESTED * 50 + "<page>whole</page><page>cut</pag",
    "cut head": "rest</text></page>" + NESTED * 50 + "\n",
    "names in it [1]{a} %20é": NESTED * 3 + "<page>cut",
}


@pytest.mark.parametrize("split", ["100", "65536"])
def test_records_in_one_read(spark, ws, tmp_path, monkeypatch, split):
    folder = tmp_path / "dump"
    folder.mkdir()
    for name, text in TEXTS.items():
        (folder / f"{name}.xml").write_text(text)
    read = []
    chunks = dumps._chunks

    def watched(spark, path, separator):
        read.append((separator, path))
        return chunks(spark, path, separator)

    monkeypatch.setattr(dumps, "_chunks", watched)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, split)
    try:
        found = [row.xml for row in dump_records(ws, str(folder)).collect()]
    finally:
        spark.conf.set(key, before)
    assert sorted(found) == sorted(x for text in TEXTS.values() for x in sequential(text))
    # Only files that end inside a page or with an end tag are looked at again.
    (_, whole), (_, again) = read
    assert whole == str(folder) and len(again) == 4


def test_closed_files_are_read_once(spark, ws, tmp_path, monkeypatch):
    (tmp_path / "a.xml").write_text(TEXTS["closed"])
    monkeypatch.setattr(dumps, "_cut_files", None)
    assert dump_records(ws, str(tmp_path / "a.xml")).count() == 100


def test_dropped_records_are_counted(spark, ws, tmp_path):
    text = "".join(
        (
            brute.page("A", "[[B]]"),
            "<page><text>no title</text></page>",
            "<page><title>No body</title></page>" * 3,
            "<page><title>Open</title><text>open</page>" * 2,
            brute.page("B", None),
            '<page id="1">no record</page>',
            brute.page("B", "x"),
            "<page><title>C</title><text>whole</text>, but cut off",
        )
    )
    (tmp_path / "a.xml").write_text(text)
    linked, counts = linked_records(ws, str(tmp_path / "a.xml"))
    assert counts == {"pages": 2, "no_title": 1, "no_body": 3, "open_body": 3, "cut": 1}
    assert sorted(row.title for row in linked.collect()) == ["A", "B"]


@pytest.mark.parametrize("text", ["", "<mediawiki/>", None])
def test_dumps_without_records(spark, ws, tmp_path, text):
    (tmp_path / "d").mkdir()
    if text is not None:
        (tmp_path / "d" / "a.xml").write_text(text)
    linked, counts = linked_records(ws, str(tmp_path / "d"))
    assert linked.count() == 0 and set(counts.values()) == {0}


def test_published_counts(spark, tmp_path):
    path = dump(tmp_path / "in", [("A", "[[B]]"), ("B", None)])
    published = publish_ranking(spark, Config(path, str(tmp_path / "out"), run="r", temporary=str(tmp_path / "w")))
    assert lines(published.dropped) == ["pages=1", "no_title=0", "no_body=0", "open_body=1", "cut=0"]
    assert published.records["open_body"] == 1


# --- positions and tokens ---------------------------------------------------


@pytest.mark.parametrize("rows", [0, 1, 5000])
def test_positions_are_row_numbers(spark, ws, rows):
    df = spark.range(rows).select("id", (F.col("id") * 7919 % 97 / 3.0).alias("pr"), F.lit(1).alias("run"))
    order = [F.desc("pr"), F.col("id")]
    placed = with_positions(ws, df.repartition(7), order)
    assert placed.columns == ["id", "pr", "run", "position"]
    expected = df.withColumn("position", F.row_number().over(Window.orderBy(*order)))
    assert sorted(tuple(x) for x in placed.collect()) == sorted(tuple(x) for x in expected.collect())


def test_positions_need_no_single_task(spark, ws):
    placed = with_positions(ws, spark.range(1000), ["id"])
    assert "SinglePartition" not in plan(placed) and "Window" not in plan(placed)


def test_tokens_are_reversible(spark):
    rng = random.Random(1)
    pool = ["\x1b", "e", "s", "0", " ", "\t", "\n", "\v", "\f", "\r", "é", "%", "\\", "\xa0", "_"]
    titles = ["", "\x1b0", "\x1b", *("".join(rng.choices(pool, k=rng.randint(0, 6))) for _ in range(2000))]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    token = to_token(F.col("title")).alias("token")
    rows = df.select("title", token).select("title", "token", from_token(F.col("token")).alias("back")).collect()
    assert all(row.back == row.title for row in rows)
    assert not any(re.search(r"[ \t\n\v\f\r]", row.token) or row.token == "" for row in rows)
    assert all(row.token == row.title for row in rows if re.fullmatch(r"[^\s\x1b]+", row.title, re.ASCII))
    assert len({row.token for row in rows}) == len(set(titles))


@pytest.mark.parametrize("kind", ["outlinks", "matrix", "sorted"])
def test_odd_titles_survive_text(spark, tmp_path, kind):
    lists = spark.createDataFrame(
        [("", 0, 0.5, ["a b", ""]), ("\t\n", 0, 0.25, []), ("plain_%", 0, 0.125, [" ", "\x1bs"])],
        "page string, part int, pr double, outlinks array<string>",
    )
    path = str(tmp_path / "x")
    if kind == "outlinks":
        sinks.write_outlinks(lists, path, "text")
        found = sources.read_outlinks(spark, path, "text")
    elif kind == "matrix":
        sinks.write_rank_matrix(lists, path, "text")
        found = sources.read_rank_matrix(spark, path, "text")
    else:
        sinks.write_sorted(lists.select("page", "pr"), path)
        found = sources.read_ranks(spark, path, "text")
    expected = lists.select(*found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_command_line_reaches_every_field(monkeypatch):
    import linkrank.__main__ as cli

    seen = []

    class Session:
        builder = property(lambda self: self)
        appName = getOrCreate = lambda self, *a: self
        stop = lambda self: None

    monkeypatch.setattr(cli, "SparkSession", Session())
    monkeypatch.setattr(cli, "publish_ranking", lambda spark, config: seen.append(config) or type("P", (), {"n": 1}))
    monkeypatch.setattr(
        "sys.argv",
        "x in out --iterations 9 --keep 2 3 --start m --start-format text --done 1 --run r --clear --inlinks".split(),
    )
    cli.main()
    assert seen == [
        runs.Config(
            "in", "out", iterations=9, keep=(2, 3), start="m", start_format="text", done=1, run="r", clear=True, write_inlinks=True
        )
    ]
