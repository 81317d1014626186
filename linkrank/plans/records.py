"""Records of a dump in one read of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from linkrank.operators.pages import count_records, page_links, parse_records
from linkrank.plans.workspace import Workspace
from linkrank.sources.dump import END_TAG, START_TAG, cut_records, read_chunks

Paths = str | list[str]


def dump_records(
    ws: Workspace, path: Paths, start_tag: str = START_TAG, end_tag: str = END_TAG
) -> DataFrame:
    """``(record, xml)``: the records of a dump, written. For those who need the markup
    itself; ``linked_records`` writes only what a graph is made of."""
    chunks = ws.save(lambda: read_chunks(ws.spark, path, start_tag, end_tag), "chunks")
    ends = chunks.select("file", "block", "record", F.col("xml").isNotNull().alias("opened"))
    cut = ws.value("cut", lambda: cut_records(ws.spark, ends, start_tag, end_tag))
    return _without(ws, chunks.where("xml IS NOT NULL").select("record", "xml"), cut)


def linked_records(
    ws: Workspace, path: Paths, start_tag: str = START_TAG, end_tag: str = END_TAG
) -> tuple[DataFrame, dict[str, int]]:
    """``(record, title, links)`` of the pages of a dump, written, and counts of its records.

    One read of the dump: what is no page is counted while the pages are written, and where
    a file is cut inside a record shows in what is written.
    """
    counted = Observation()

    def chunks() -> DataFrame:
        found = read_chunks(ws.spark, path, start_tag, end_tag)
        opened = found.withColumn("opened", F.col("xml").isNotNull())
        parsed = page_links(parse_records(opened)).observe(counted, *count_records())
        return parsed.select("file", "block", "record", "opened", "dropped", "title", "links")

    table = ws.save(chunks, "linked")
    counts = ws.value("counted", lambda: counted.get)
    cut = ws.value("cut", lambda: cut_records(ws.spark, table, start_tag, end_tag))
    if cut:
        taken = _without(ws, table, cut, "left_semi").agg(*count_records())
        over = ws.value("over", lambda: taken.first().asDict())
        counts = {name: n - over[name] for name, n in counts.items()}
    linked = table.where("title IS NOT NULL").select("record", "title", "links")
    return _without(ws, linked, cut), {**counts, "cut": len(cut)}


def _without(ws: Workspace, df: DataFrame, cut: list[int], how: str = "left_anti") -> DataFrame:
    """Rows but for these records: one a file at most, and only of files cut in a record."""
    if not cut:
        return df
    gone = ws.spark.createDataFrame([(i,) for i in cut], "record long")
    return df.join(F.broadcast(gone), "record", how)
