from __future__ import annotations

from pathlib import Path

import pytest

from linkrank import sinks, sources
from linkrank.operators import graph as g
from linkrank.plans.run import Config, publish_ranking
from tests import brute
from tests.test_graph import RECORDS
from tests.test_ranks import as_dict, random_records


def parts(path) -> list[Path]:
    return sorted(p for p in Path(path).iterdir() if p.name.startswith("part-"))


def lines(path) -> list[str]:
    return [line for part in parts(path) for line in part.read_text().splitlines()]


def dump(folder: Path, records) -> str:
    folder.mkdir()
    half = len(records) // 2
    for name, some in (("a", records[:half]), ("b", records[half:])):
        text = "\n".join(brute.page(title, body) for title, body in some)
        (folder / f"{name}.xml").write_text(f"<mediawiki>\n{text}\n</mediawiki>\n")
    return str(folder)


@pytest.fixture
def lists(spark):
    return spark.createDataFrame(
        [("A", 0, ["B", "B", "C"]), ("B", 0, ["A"]), ("C", 0, [])],
        "page string, part int, outlinks array<string>",
    )


@pytest.mark.parametrize("format", ["text", "parquet"])
def test_outlinks_round_trip(spark, tmp_path, lists, format):
    path = str(tmp_path / "out")
    sinks.write_outlinks(lists, path, format)
    found = {row.page: row.outlinks for row in sources.read_outlinks(spark, path, format).collect()}
    assert found == {"A": ["B", "B", "C"], "B": ["A"], "C": []}
    if format == "text":
        assert sorted(lines(path)) == ["A\tB B C", "B\tA", "C\t"]


@pytest.mark.parametrize("format", ["text", "parquet"])
def test_inlinks_round_trip(spark, tmp_path, lists, format):
    path = str(tmp_path / "in")
    sinks.write_inlinks(lists.withColumnRenamed("outlinks", "inlinks"), path, format)
    read = sources.read_inlinks(spark, path, format)
    assert {row.page: row.inlinks for row in read.collect()}["A"] == ["B", "B", "C"]


def test_matrix_round_trip(spark, tmp_path, lists):
    from pyspark.sql import functions as F

    matrix = lists.withColumn("pr", F.lit(1.0) / F.length("page") / 3)
    for format in ("text", "parquet"):
        path = str(tmp_path / format)
        sinks.write_rank_matrix(matrix, path, format)
        rows = sources.read_rank_matrix(spark, path, format).collect()
        assert {row.page: (row.pr, row.outlinks) for row in rows} == {
            "A": (1 / 3, ["B", "B", "C"]),
            "B": (1 / 3, ["A"]),
            "C": (1 / 3, []),
        }
        assert as_dict(sources.read_ranks(spark, path, format))["C"] == 1 / 3
    assert "A 0.3333333333333333 B B C" in lines(tmp_path / "text")


def test_text_readers_accept_any_white_space(spark, tmp_path):
    path = tmp_path / "m.txt"
    path.write_text("A 1.5E-4 B  C \t\n\nD 2.0 \n")
    rows = sources.read_rank_matrix(spark, str(path), "text").collect()
    assert [(row.page, row.pr, row.outlinks) for row in rows] == [
        ("A", 1.5e-4, ["B", "C"]),
        ("D", 2.0, []),
    ]
    path = tmp_path / "n.txt"
    path.write_text("N=42\t\n")
    assert sources.read_count(spark, str(path)) == 42


def test_count(spark, tmp_path):
    path = str(tmp_path / "n")
    sinks.write_count(g.page_count(spark.range(12)), path)
    assert lines(path) == ["N=12"]
    assert sources.read_count(spark, path) == 12


@pytest.fixture(scope="module")
def many(spark):
    from pyspark.sql import functions as F

    ranks = spark.range(5000).select(
        F.concat(F.lit("p"), "id").alias("page"), ((F.col("id") * 7919) % 5000 / 3.0).alias("pr")
    )
    return ranks.repartition(8)


def test_sorted_text_is_in_order_across_parts(spark, tmp_path, many):
    path = str(tmp_path / "sorted")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        sinks.write_sorted(many, path)
    finally:
        spark.conf.unset(key)
    assert len(parts(path)) > 1
    written = [line.split("\t") for line in lines(path)]
    expected = sorted(((row.page, row.pr) for row in many.collect()), key=lambda x: (-x[1], x[0]))
    assert [(page, float(pr)) for page, pr in written] == expected


def test_split_matrix_resumes_with_one_rank_a_page(spark, tmp_path):
    rows = [("A", 0, 0.25, ["B"]), ("A", 1, 0.25, ["C"]), ("B", 0, 0.25, [])]
    matrix = spark.createDataFrame(rows, "page string, part int, pr double, outlinks array<string>")
    for format in ("text", "parquet"):
        path = str(tmp_path / format)
        sinks.write_rank_matrix(matrix, path, format)
        found = sources.read_ranks(spark, path, format).collect()
        assert sorted((row.page, row.pr) for row in found) == [("A", 0.25), ("B", 0.25)]


def test_empty_dump_publishes_empty_results(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text("<mediawiki></mediawiki>")
    published = publish_ranking(spark, Config(str(tmp_path / "in"), str(tmp_path / "out")))
    assert published.n == 0 and lines(published.count) == ["N=0"]
    assert [lines(path) for path in published.ranks.values()] == [[], []]


def test_whole_run(spark, tmp_path):
    records = random_records(200, 4, seed=9) + RECORDS
    config = Config(
        input=dump(tmp_path / "in", records),
        output=str(tmp_path / "out"),
        threshold_factor=2.0,
        graph_format="text",
        write_inlinks=True,
        temporary=str(tmp_path / "work"),
    )
    published = publish_ranking(spark, config)
    pages, edges = brute.graph(records)
    assert published.n == len(pages) == sources.read_count(spark, published.count)
    assert lines(published.count) == [f"N={len(pages)}"]
    out = sources.read_outlinks(spark, published.outlinks, "text").collect()
    assert {row.page for row in out} == pages
    assert sorted((row.page, link) for row in out for link in row.outlinks) == sorted(
        edges.elements()
    )
    parents = sources.read_inlinks(spark, published.inlinks, "text").collect()
    assert sorted((link, row.page) for row in parents for link in row.inlinks) == sorted(
        edges.elements()
    )
    assert sorted(published.ranks) == [1, 8]
    for i, path in published.ranks.items():
        expected = {p: pr for p, pr in brute.ranks(pages, edges, i).items() if pr >= 2 / len(pages)}
        found = [line.split("\t") for line in lines(path)]
        assert expected and {page: float(pr) for page, pr in found} == pytest.approx(expected)
        assert [float(pr) for _, pr in found] == sorted((float(pr) for _, pr in found))[::-1]


def test_run_with_one_iteration(spark, tmp_path):
    config = Config(dump(tmp_path / "in", RECORDS), str(tmp_path / "out"), iterations=1)
    published = publish_ranking(spark, config)
    assert list(published.ranks) == [1]
    assert lines(published.ranks[1]) == []
