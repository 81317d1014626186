"""The whole run: dump to published results."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from linkrank import sinks, sources
from linkrank.functions.score import DAMPING
from linkrank.operators import graph as g
from linkrank.operators.results import THRESHOLD_FACTOR, above_threshold
from linkrank.plans import files
from linkrank.plans.ranking import (
    ITERATIONS,
    Layout,
    link_graph_from_records,
    rank_graph,
    rank_pages,
)
from linkrank.plans.records import linked_records
from linkrank.plans.workspace import Workspace
from linkrank.sources.dump import END_TAG, START_TAG
from linkrank.sources.results import PARQUET


@dataclass(frozen=True)
class Config:
    """What to read, where to publish, and the ranking's parameters.

    ``keep`` are the iterations whose ranks are published beside the last one's. ``start``
    names ranks or a rank matrix (in ``start_format``) that ``done`` iterations led to; only
    the iterations after it are run.

    A run with a name can be stopped anywhere: run again with the same name and parameters it
    reads its finished stages and does the rest. ``clear`` removes the run's tables once
    everything is published; without it they stay, as does the name.
    """

    input: str
    output: str
    iterations: int = ITERATIONS
    damping: float = DAMPING
    threshold_factor: float = THRESHOLD_FACTOR
    start_tag: str = START_TAG
    end_tag: str = END_TAG
    graph_format: str = PARQUET
    write_inlinks: bool = False
    keep: tuple[int, ...] = (1,)
    start: str | None = None
    start_format: str = PARQUET
    done: int = 0
    run: str | None = None
    clear: bool = False
    temporary: str | None = None
    layout: Layout = field(default_factory=Layout)


@dataclass(frozen=True)
class Published:
    """Where the results are. ``ranks`` maps iteration to its sorted file; ``records`` counts
    what became of the dump's records."""

    outlinks: str
    count: str
    dropped: str
    ranks: dict[int, str]
    n: int
    records: dict[str, int]
    inlinks: str | None = None


def publish_ranking(spark: SparkSession, config: Config) -> Published:
    """Parse, count, rank, sort and publish under ``<output>/results``.

    The session's settings are not touched: the run's plans have a session of their own.
    """
    parameters = _parameters(spark, config) if config.run else None
    ws = Workspace(spark, config.temporary, config.run, parameters).private()
    try:
        published = _publish(ws, config)
    finally:
        ws.forget_tables()
    if config.clear:
        ws.clear()
    return published


def _parameters(spark: SparkSession, config: Config) -> dict:
    """What a named run has to have in common with its earlier attempts."""
    others = ("run", "clear", "temporary")
    given = {k: v for k, v in asdict(config).items() if k not in others}
    return {**given, "keep": list(config.keep), "read": files.extent(spark, config.input)}


def _publish(ws: Workspace, config: Config) -> Published:
    results = f"{config.output.rstrip('/')}/results"
    linked, counts = linked_records(ws, config.input, config.start_tag, config.end_tag)
    links = link_graph_from_records(ws, linked, config.layout)

    kept = sorted({*config.keep, config.iterations})
    published = Published(
        outlinks=f"{results}/outlink.out",
        count=f"{results}/n.out",
        dropped=f"{results}/dropped.out",
        ranks={i: f"{results}/iter{i}.out" for i in kept if config.done < i <= config.iterations},
        n=links.n,
        records=counts,
        inlinks=f"{results}/inlink.out" if config.write_inlinks else None,
    )
    format = config.graph_format

    def write_outlinks(mode: str) -> None:
        sinks.write_outlinks(links.outlinks(), published.outlinks, format, mode)

    def write_inlinks(mode: str) -> None:
        sinks.write_inlinks(links.inlinks(), published.inlinks, format, mode)

    def write_dropped(mode: str) -> None:
        row = ws.spark.createDataFrame([tuple(counts.values())], [*counts])
        sinks.write_dropped(row, published.dropped, mode)

    ws.publish("outlink.out", write_outlinks)
    if published.inlinks:
        ws.publish("inlink.out", write_inlinks)
    ws.publish("n.out", lambda mode: sinks.write_count(g.page_count(links.nodes), published.count, mode))
    ws.publish("dropped.out", write_dropped)

    start = None
    if config.start:
        start = sources.read_ranks(ws.spark, config.start, config.start_format)
    ranks = rank_pages(
        ws,
        rank_graph(ws, links),
        config.iterations,
        config.damping,
        keep=kept,
        start=start,
        done=config.done,
        layout=config.layout,
    )
    for i, path in published.ranks.items():
        top = above_threshold(ranks[i], links.n, config.threshold_factor)
        ws.publish(f"iter{i}.out", lambda mode, top=top, path=path: sinks.write_sorted(top, path, mode=mode))
    return published
