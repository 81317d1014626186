"""One query per operator. Each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank import sinks, sources
from linkrank.functions import has_title, page_title
from linkrank.operators import graph as g
from linkrank.operators import ranks as r
from linkrank.operators.pages import malformed_records, page_links, parse_pages, parse_records
from linkrank.operators.results import above_threshold
from linkrank.plans.positions import with_positions
from linkrank.plans.ranking import (
    ITERATIONS,
    LinkGraph,
    graph_from_pages,
    graph_from_pairs,
    link_graph_from_pages,
    link_graph_from_pairs,
    rank_graph,
    rank_pages,
    snapshots,
)
from linkrank.plans.records import dump_records, linked_records
from linkrank.plans.run import Config, publish_ranking
from linkrank.plans.workspace import Workspace
from workload import fixtures as fx


# --- inputs -----------------------------------------------------------------


def _wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_pages(fx.wiki_records(spark, sf_dir))


def _wiki_links(ws: Workspace, sf_dir: str) -> LinkGraph:
    return link_graph_from_pages(ws, _wiki_pages(ws.spark, sf_dir))


def _wiki_graph(ws: Workspace, sf_dir: str) -> r.RankGraph:
    return graph_from_pages(ws, _wiki_pages(ws.spark, sf_dir))


def _part_tables(ws: Workspace, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    listed = fx.part_nodes(ws.spark, sf_dir)
    pairs = ws.save(fx.listed_pairs(fx.part_pairs(ws.spark, sf_dir), listed), "pairs")
    sent = pairs.groupBy(F.col("src").alias("page")).agg(F.count(F.lit(1)).alias("links"))
    nodes = listed.join(sent, "page", "left").select(
        "page", F.lit(1).alias("records"), F.coalesce("links", F.lit(0)).alias("links")
    )
    return pairs, nodes


def _part_graph(ws: Workspace, sf_dir: str) -> r.RankGraph:
    return graph_from_pairs(ws, *_part_tables(ws, sf_dir))


def _rounded(name: str) -> Column:
    """Sums of doubles depend on their order past this digit."""
    return F.round(name, 12).alias(name)


def _ranks(df: DataFrame) -> DataFrame:
    return df.select("page", _rounded("pr"))


# --- parsing ----------------------------------------------------------------


def html_titles(spark, sf_dir):
    html = F.col("html")
    pages = fx.table(spark, sf_dir, "pages").where(has_title(html))
    return pages.select("page_id", page_title(html).alias("title"))


def html_malformed(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    return malformed_records(pages, xml="html").select("page_id")


def wiki_pages(spark, sf_dir):
    pages = _wiki_pages(spark, sf_dir)
    return pages.select("doc_id", "title", F.length("body").cast("bigint").alias("body_chars"))


def wiki_link_targets(spark, sf_dir):
    linked = page_links(_wiki_pages(spark, sf_dir))
    return linked.select("doc_id", "title", F.explode("links").alias("link"))


def wiki_link_pairs(spark, sf_dir):
    return g.link_pairs(page_links(_wiki_pages(spark, sf_dir)))


def wiki_merged_links(spark, sf_dir):
    return g.merge_copies(wiki_link_pairs(spark, sf_dir))


# --- graph ------------------------------------------------------------------


def wiki_nodes(spark, sf_dir):
    return g.page_nodes(page_links(_wiki_pages(spark, sf_dir)))


def wiki_edges(spark, sf_dir):
    return _wiki_links(Workspace(spark), sf_dir).edges.select("src", "dst", "copies")


def wiki_red_links(spark, sf_dir):
    linked = Workspace(spark).save(page_links(_wiki_pages(spark, sf_dir)), "linked")
    return g.red_links(g.link_pairs(linked), g.existing_pages(linked))


def _joined(lists: DataFrame, name: str, count: str) -> DataFrame:
    return lists.select(
        "page",
        F.size(name).cast("bigint").alias(count),
        F.array_join(name, " ").alias(name),
    )


def wiki_inlinks(spark, sf_dir):
    graph = _wiki_links(Workspace(spark), sf_dir)
    return _joined(graph.inlinks(), "inlinks", "n_in")


def wiki_outlinks(spark, sf_dir):
    graph = _wiki_links(Workspace(spark), sf_dir)
    return _joined(graph.outlinks(), "outlinks", "n_out")


def wiki_transpose(spark, sf_dir):
    graph = _wiki_links(Workspace(spark), sf_dir)
    return g.transpose_inlinks(graph.inlinks())


def page_count(spark, sf_dir):
    counted = g.page_count(g.existing_pages(_wiki_pages(spark, sf_dir)))
    return counted.select("n", F.format_string("N=%d", "n").alias("line"))


def out_degree(spark, sf_dir):
    return g.out_degree(_wiki_links(Workspace(spark), sf_dir).edges)


def in_degree(spark, sf_dir):
    return g.in_degree(_wiki_links(Workspace(spark), sf_dir).edges)


# --- ranks ------------------------------------------------------------------


def rank_init(spark, sf_dir):
    graph = _wiki_graph(Workspace(spark), sf_dir)
    return _ranks(graph.titled(r.init_ranks(graph.pages, graph.n)))


def contributions(spark, sf_dir):
    graph = _wiki_graph(Workspace(spark), sf_dir)
    sent = r.contributions(graph, r.init_ranks(graph.pages, graph.n))
    return graph.with_titles(sent, "src", "dst").select("src", "dst", "copies", _rounded("c"))


def contribution_sums(spark, sf_dir):
    graph = _wiki_graph(Workspace(spark), sf_dir)
    sums = r.contribution_sums(r.contributions(graph, r.init_ranks(graph.pages, graph.n)))
    return graph.with_titles(sums, "dst").select("dst", _rounded("s"))


def rank_iter1(spark, sf_dir):
    ws = Workspace(spark)
    return _ranks(rank_pages(ws, _wiki_graph(ws, sf_dir), iterations=1)[1])


def rank_iter8(spark, sf_dir):
    ws = Workspace(spark)
    return _ranks(rank_pages(ws, _wiki_graph(ws, sf_dir))[ITERATIONS])


def rank_snapshots(spark, sf_dir):
    ws = Workspace(spark)
    kept = snapshots(rank_pages(ws, _wiki_graph(ws, sf_dir), keep=(1,)))
    return kept.select("iteration", "page", _rounded("pr"))


def _matrix(ws: Workspace, sf_dir: str) -> DataFrame:
    links = _wiki_links(ws, sf_dir)
    ranks = rank_pages(ws, rank_graph(ws, links))[ITERATIONS]
    return r.rank_matrix(ranks, links.outlinks())


def rank_matrix8(spark, sf_dir):
    matrix = _matrix(Workspace(spark), sf_dir)
    return matrix.select("page", _rounded("pr"), F.array_join("outlinks", " ").alias("outlinks"))


def rank_resumed(spark, sf_dir):
    """Three iterations, a snapshot written and read, then the rest."""
    ws = Workspace(spark)
    graph = _wiki_graph(ws, sf_dir)
    sinks.write_ranks(rank_pages(ws, graph, iterations=3)[3], ws.path("snapshot"))
    start = sources.read_ranks(spark, ws.path("snapshot"))
    return _ranks(rank_pages(ws, graph, start=start, done=3)[ITERATIONS])


def rank_resumed_from_matrix(spark, sf_dir):
    """Three iterations, a text matrix whose long pages take several rows, then the rest."""
    ws = Workspace(spark)
    links = _wiki_links(ws, sf_dir)
    graph = rank_graph(ws, links)
    lists = links.outlinks(row_links=1)
    matrix = r.rank_matrix(rank_pages(ws, graph, iterations=3)[3], lists)
    sinks.write_rank_matrix(matrix, ws.path("matrix3.out"), format="text")
    start = sources.read_ranks(spark, ws.path("matrix3.out"), format="text")
    return _ranks(rank_pages(ws, graph, start=start, done=3)[ITERATIONS])


def _in_order(ws: Workspace, ranks: DataFrame) -> DataFrame:
    """Rounded ranks, highest first, with their positions."""
    placed = with_positions(ws, _ranks(ranks), [F.desc("pr"), F.col("page")])
    return placed.orderBy("position")


def sorted_iter8(spark, sf_dir):
    ws = Workspace(spark)
    return _in_order(ws, rank_pages(ws, _wiki_graph(ws, sf_dir))[ITERATIONS])


def top_ranked(spark, sf_dir):
    ws = Workspace(spark)
    graph = _wiki_graph(ws, sf_dir)
    return _in_order(ws, above_threshold(rank_pages(ws, graph)[ITERATIONS], graph.n))


def parts_edges(spark, sf_dir):
    ws = Workspace(spark)
    graph = link_graph_from_pairs(ws, *_part_tables(ws, sf_dir))
    return graph.edges.select("src", "dst", "copies")


def parts_rank8(spark, sf_dir):
    ws = Workspace(spark)
    return _ranks(rank_pages(ws, _part_graph(ws, sf_dir))[ITERATIONS])


def parts_top(spark, sf_dir):
    ws = Workspace(spark)
    graph = _part_graph(ws, sf_dir)
    return _in_order(ws, above_threshold(rank_pages(ws, graph)[ITERATIONS], graph.n))


# --- files ------------------------------------------------------------------


def _dump(ws: Workspace, sf_dir: str) -> str:
    """The wiki records as an XML dump in the run's folder."""
    path = ws.path("dump")
    fx.wiki_records(ws.spark, sf_dir).select("xml").write.text(path)
    return path


def xml_file_pages(spark, sf_dir):
    pages = parse_pages(sources.read_pages(spark, _dump(Workspace(spark), sf_dir)))
    return pages.select("title", F.length("body").cast("bigint").alias("body_chars"))


def xml_file_records(spark, sf_dir):
    """Every record of files with nested, unclosed and cut pages, byte by byte."""
    ws = Workspace(spark)
    records = dump_records(ws, fx.write_hard_dump(spark, sf_dir, ws.path("dump")))
    xml = F.col("xml")
    return records.select(
        F.regexp_extract(xml, "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.sha2(xml, 256).alias("sha256"),
    )


def wiki_malformed(spark, sf_dir):
    parsed = parse_records(fx.broken_records(spark, sf_dir))
    return parsed.where("dropped IS NOT NULL").select("doc_id", "dropped")


def wiki_malformed_counts(spark, sf_dir):
    """What a dump's records came to, counted while its pages were written."""
    ws = Workspace(spark)
    path = ws.path("dump")
    fx.broken_records(spark, sf_dir).select("xml").write.text(path)
    counts = linked_records(ws, path)[1]
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


def odd_titles_round_trip(spark, sf_dir):
    path = Workspace(spark).path("odd.out")
    sinks.write_outlinks(fx.odd_lists(spark, sf_dir), path, format="text")
    lists = sources.read_outlinks(spark, path, format="text")
    return lists.select("page", F.array_join("outlinks", "|").alias("outlinks"))


def outlink_text_round_trip(spark, sf_dir):
    graph = _wiki_links(Workspace(spark), sf_dir)
    path = Workspace(spark).path("outlink.out")
    sinks.write_outlinks(graph.outlinks(), path, format="text")
    return _joined(sources.read_outlinks(spark, path, format="text"), "outlinks", "n_out")


def inlink_text_round_trip(spark, sf_dir):
    graph = _wiki_links(Workspace(spark), sf_dir)
    path = Workspace(spark).path("inlink.out")
    sinks.write_inlinks(graph.inlinks(), path, format="text")
    return _joined(sources.read_inlinks(spark, path, format="text"), "inlinks", "n_in")


def matrix_text_round_trip(spark, sf_dir):
    ws = Workspace(spark)
    path = ws.path("matrix.out")
    sinks.write_rank_matrix(_matrix(ws, sf_dir), path, format="text")
    matrix = sources.read_rank_matrix(spark, path, format="text")
    return matrix.select("page", _rounded("pr"), F.array_join("outlinks", " ").alias("outlinks"))


def ranked_from_files(spark, sf_dir):
    """Dump files in, published text out, read back."""
    ws = Workspace(spark)
    published = publish_ranking(spark, Config(input=_dump(ws, sf_dir), output=ws.path("out")))
    return _ranks(sources.read_ranks(spark, published.ranks[ITERATIONS], format="text"))


def count_from_files(spark, sf_dir):
    """The published page count, read back beside the lines of the published graph."""
    ws = Workspace(spark)
    config = Config(
        input=_dump(ws, sf_dir), output=ws.path("out"), iterations=1, graph_format="text"
    )
    published = publish_ranking(spark, config)
    lines = sources.read_outlinks(spark, published.outlinks, format="text")
    return lines.agg(F.countDistinct("page").alias("pages")).withColumn(
        "published", F.lit(sources.read_count(spark, published.count)).cast("bigint")
    )


QUERIES = {
    query.__name__: query
    for query in (
        html_titles,
        html_malformed,
        wiki_pages,
        wiki_link_targets,
        wiki_link_pairs,
        wiki_merged_links,
        wiki_nodes,
        wiki_edges,
        wiki_red_links,
        wiki_inlinks,
        wiki_outlinks,
        wiki_transpose,
        page_count,
        out_degree,
        in_degree,
        rank_init,
        contributions,
        contribution_sums,
        rank_iter1,
        rank_iter8,
        rank_snapshots,
        rank_matrix8,
        rank_resumed,
        rank_resumed_from_matrix,
        sorted_iter8,
        top_ranked,
        parts_edges,
        parts_rank8,
        parts_top,
        xml_file_pages,
        xml_file_records,
        wiki_malformed,
        wiki_malformed_counts,
        odd_titles_round_trip,
        outlink_text_round_trip,
        inlink_text_round_trip,
        matrix_text_round_trip,
        ranked_from_files,
        count_from_files,
    )
}
