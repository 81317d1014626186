from __future__ import annotations

import bz2
import random
from pathlib import Path

import pytest

from linkrank.operators.pages import parse_pages
from linkrank.plans.ranking import link_graph_from_pages
from linkrank.sources import read_pages
from tests import brute
from workload.fixtures import write_hard_dump


def blocks(spark, tmp_path, text):
    path = tmp_path / "dump.xml"
    path.write_text(text, encoding="utf-8")
    return [row.xml for row in read_pages(spark, str(path)).collect()]


def test_blocks_run_from_start_tag_to_end_tag(spark, tmp_path):
    text = "<mediawiki>\n<page>a\nb</page> junk <page>c</page>\n</mediawiki>\n"
    assert blocks(spark, tmp_path, text) == ["<page>a\nb</page>", "<page>c</page>"]


def test_unfinished_last_block_is_dropped(spark, tmp_path):
    tail = "<page><title>Z</title><text>z</text>"
    assert blocks(spark, tmp_path, f"<page>a</page>{tail}") == ["<page>a</page>"]


@pytest.mark.parametrize("tag", ['<page id="1">', '<page\nid="1">'])
def test_start_tag_with_attributes_is_no_record(spark, tmp_path, tag):
    text = f"<mediawiki>{tag}x</page><page>a</page>{tag}y</page><page>b</page>"
    assert blocks(spark, tmp_path, text) == ["<page>a</page>", "<page>b</page>"]


def test_empty_and_headless_files(spark, tmp_path):
    assert blocks(spark, tmp_path, "") == []
    assert blocks(spark, tmp_path, "no pages here") == []


def test_other_tags(spark, tmp_path):
    path = tmp_path / "d.xml"
    path.write_text("<doc>1</doc><page>2</page><doc>3</doc>")
    rows = read_pages(spark, str(path), "<doc>", "</doc>").collect()
    assert [row.xml for row in rows] == ["<doc>1</doc>", "<doc>3</doc>"]


@pytest.mark.parametrize("suffix", [".xml", ".xml.bz2"])
def test_split_files_lose_and_repeat_nothing(spark, tmp_path, suffix):
    titles = [f"Páge {i} 日本" for i in range(5000)]
    filler = random.Random(7)
    text = "<mediawiki>\n" + "\n".join(
        brute.page(title, f"body [[{title}]] " + filler.randbytes(i % 400).hex())
        for i, title in enumerate(titles)
    )
    text += "\n<page><title>cut</title><text>off</text>"
    data = text.encode("utf-8")
    path = tmp_path / f"dump{suffix}"
    path.write_bytes(bz2.compress(data, 1) if suffix.endswith("bz2") else data)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "65536")
    try:
        records = read_pages(spark, str(path))
        assert records.rdd.getNumPartitions() > 3
        found = [row.title for row in parse_pages(records).collect()]
    finally:
        spark.conf.set(key, before)
    assert sorted(found) == sorted(title.replace(" ", "_") for title in titles)


def sequential(text: str) -> list[str]:
    """The rule itself: from a start tag to the next end tag, over and over."""
    found, at = [], 0
    while (start := text.find("<page>", at)) >= 0 and (end := text.find("</page>", start)) >= 0:
        found.append(text[start : end + 7])
        at = end + 7
    return found


NESTED = "<page>a</page><page>b <page id=\"2\"> c</page>\n"


@pytest.mark.parametrize("split", ["16384", "65536", "1g"])
@pytest.mark.parametrize("suffix", [".xml", ".xml.bz2"])
@pytest.mark.parametrize(
    "text",
    [
        NESTED * 2000,
        "rest</text></page>" + NESTED * 50,
        "<mediawiki><pagex>x</page><page>a</page>",
        "<page>a</page><page>b <page>c</page>" * 300 + "<page>cut",
        '<page id="1">x</page>' + NESTED * 300 + "</mediawiki>",
        "<page>whole</page><page>cut " + "x" * 100_000,
        "<page>whole</page><page>cut </pag",
    ],
)
def test_records_are_those_of_a_sequential_scan(spark, tmp_path, text, suffix, split):
    path = tmp_path / f"dump{suffix}"
    data = text.encode()
    path.write_bytes(bz2.compress(data, 1) if suffix.endswith("bz2") else data)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, split)
    try:
        found = [row.xml for row in read_pages(spark, str(path)).collect()]
    finally:
        spark.conf.set(key, before)
    assert sorted(found) == sorted(sequential(text))


def test_several_files(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.xml").write_text(f"<page>{name}</page>")
    assert sorted(row.xml for row in read_pages(spark, str(tmp_path)).collect()) == [
        "<page>a</page>",
        "<page>b</page>",
    ]


def test_broken_utf8_titles_meet_their_links(spark, ws, tmp_path):
    broken = b"Caf\xe9 \xff"
    path = tmp_path / "latin.xml"
    path.write_bytes(
        b"<page><title>" + broken + b"</title><text>x</text></page>"
        b"<page><title>B</title><text>[[" + broken + b"|it]]</text></page>"
    )
    graph = link_graph_from_pages(ws, parse_pages(read_pages(spark, str(path))))
    assert [(row.src, row.dst) for row in graph.edges.collect()] == [("B", "Caf\ufffd_\ufffd")]


def test_files_of_a_larger_hard_dump_are_no_larger(spark, tmp_path):
    docs = spark.range(2_000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    docs.repartition(40).write.parquet(f"{tmp_path}/documents.parquet")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "8k")  # about a file a partition
    try:
        folder, _ = write_hard_dump(spark, str(tmp_path), f"{tmp_path}/dump")
    finally:
        spark.conf.set(key, before)
    files = [p.read_text() for p in Path(folder).glob("part-*")]
    assert len(files) >= 80 and all(text.endswith("</title><text>off\n") for text in files)
    assert max(text.count("</page>") for text in files) < 2_000 / 8
