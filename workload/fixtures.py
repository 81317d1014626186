"""Inputs that Spark derives from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One XML record per document. {text_type} is STRING here and VARCHAR in the oracle.
# It holds repeated titles (% 50 = 7), pages without a body (% 17 = 3), dangling pages
# (% 10 = 0), self links, repeated, piped, nested and red links.
WIKI_SQL = """
SELECT doc_id, concat('<page><title>Doc ',
  CAST(CASE WHEN doc_id % 50 = 7 THEN doc_id - 1 ELSE doc_id END AS {text_type}),
  '</title><revision>',
  CASE WHEN doc_id % 17 = 3 THEN '<text xml:space="preserve" />' ELSE
    concat('<text xml:space="preserve">', text,
      CASE WHEN doc_id % 10 = 0 THEN '' ELSE concat(
        ' [[Doc ', CAST(CAST(floor(doc_id / 2) AS BIGINT) AS {text_type}), '|half]] [[Doc ',
        CAST(CAST(floor(doc_id / 3) AS BIGINT) AS {text_type}), ']] [[Doc ',
        CAST(doc_id + 1 AS {text_type}), ']] [[Doc ', CAST(doc_id AS {text_type}), ']] [[Doc ',
        CAST(doc_id * 5 + 2 AS {text_type}), '|far]] [[Doc ', CAST(doc_id + 1 AS {text_type}),
        '|again]] [[File:f.png|cap [[Doc 1]] x]]') END,
      '</text>') END, '</revision></page>') AS xml
FROM {documents}
"""

# The same records broken: no title (% 13 = 5), no body tag (% 23 = 6), a body that is never
# closed (% 19 = 4, and the ones without body above).
BROKEN_SQL = f"""
SELECT doc_id, CASE
    WHEN doc_id % 13 = 5 THEN replace(xml, '<title>', '<name>')
    WHEN doc_id % 23 = 6 THEN replace(xml, '<text', '<note')
    WHEN doc_id % 19 = 4 THEN replace(xml, '</text>', '') ELSE xml END AS xml
FROM ({WIKI_SQL}) AS wiki
"""

# Lines of a dump that is hard to read, and the records they hold: a page inside a page, a
# tag with attributes, an unclosed page before the next and an end tag too many, a page whose
# head is cut off, two pages on a line, a page over several lines.
HARD_SQL = """
SELECT doc_id, doc_id % 8 AS part, CASE kind
    WHEN 1 THEN concat('<page><title>Outer ', id, '</title><page><title>Inner</title>', body, '</page>')
    WHEN 2 THEN concat('<page id="', id, '"><title>Attributes</title>', body, '</page>')
    WHEN 3 THEN concat('<page><title>Open ', id, '</title>{line}<page>', body, '</page> junk </page>')
    WHEN 4 THEN concat(body, '</revision></page>')
    WHEN 5 THEN concat('<page><title>One ', id, '</title></page><page><title>Two ', id, '</title>', body, '</page>')
    WHEN 6 THEN concat('<page><title>End ', id, '</title>', body, '</page>')
    ELSE concat('<page>{line}<title>Page ', id, '</title>{line}', body, '{line}</page>') END AS line, CASE kind
    WHEN 2 THEN NULL WHEN 4 THEN NULL
    WHEN 3 THEN concat('<page><title>Open ', id, '</title>{line}<page>', body, '</page>')
    WHEN 5 THEN concat('<page><title>One ', id, '</title></page>')
    WHEN 1 THEN concat('<page><title>Outer ', id, '</title><page><title>Inner</title>', body, '</page>')
    WHEN 6 THEN concat('<page><title>End ', id, '</title>', body, '</page>')
    ELSE concat('<page>{line}<title>Page ', id, '</title>{line}', body, '{line}</page>') END AS first, CASE kind
    WHEN 5 THEN concat('<page><title>Two ', id, '</title>', body, '</page>') END AS second
FROM (SELECT doc_id, doc_id % 11 AS kind, CAST(doc_id AS {text_type}) AS id,
    concat('<text>', text, '</text>') AS body FROM {documents}) AS d
"""

# Titles with all that a text form has to escape, one of them empty.
ODD_SQL = """
SELECT CASE WHEN doc_id = 3 THEN '' ELSE concat('T', {char}(CAST(9 + doc_id % 5 AS INT)), {char}(27), 'e ',
    CAST(doc_id AS {text_type}), {char}(160)) END AS page, substr(text, 1, 9) AS head, doc_id
FROM {documents} WHERE text IS NOT NULL
"""

# Files of a hard dump for each partition that its documents are read in.
FILES_PER_PARTITION = 4

# Parts of these sizes have a page; the others are only linked to.
LISTED_SIZE = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wiki_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, xml)``: a page record rendered from every document."""
    sql = WIKI_SQL.format(text_type="STRING", documents="{documents}")
    return spark.sql(sql, documents=table(spark, sf_dir, "documents"))


def broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, xml)``: the wiki records, some of them no pages."""
    sql = BROKEN_SQL.format(text_type="STRING", documents="{documents}")
    return spark.sql(sql, documents=table(spark, sf_dir, "documents"))


def write_hard_dump(spark: SparkSession, sf_dir: str, path: str) -> list[str]:
    """Write a dump that is hard to read; its folders.

    Files of the first folder end inside a page; those of the second with an end tag, not
    even a new line follows. The first has more files the more partitions the documents are
    read in, so no task writes more of a larger dump.
    """
    sql = HARD_SQL.format(text_type="STRING", documents="{documents}", line="\n")
    lines = spark.sql(sql, documents=table(spark, sf_dir, "documents"))
    ends = F.endswith("line", F.lit("</page>")) & F.startswith("line", F.lit("<page><title>End"))
    parts = lines.select(F.spark_partition_id()).distinct().count()
    files = max(8, FILES_PER_PARTITION * parts)
    # Many keys a file, so that hardly any file has none and all are of a size.
    deal = F.monotonically_increasing_id() % (16 * files)
    off = F.concat(F.lit("<page><title>Cut "), F.col("id"), F.lit("</title><text>off"))
    cut = spark.range(16 * files).select(F.col("id").alias("deal"), off.alias("line"), F.lit(1).alias("last"))
    whole = lines.where(~ends).select(deal.alias("deal"), "line", F.lit(0).alias("last"))
    dealt = whole.unionByName(cut).repartition(files, "deal").sortWithinPartitions("last")
    dealt.select("line").write.text(f"{path}/cut")
    bare = F.substring_index("line", "</page>", 1)
    lines.where(ends).select(bare.alias("line")).write.option("lineSep", "</page>").text(f"{path}/ends")
    return [f"{path}/cut", f"{path}/ends"]


def odd_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page, part, outlinks)``: pages and links with titles that text has to escape."""
    sql = ODD_SQL.format(text_type="STRING", documents="{documents}", char="char")
    odd = spark.sql(sql, documents=table(spark, sf_dir, "documents"))
    return odd.select("page", F.lit(0).alias("part"), F.array("head", "page", F.lit("")).alias("outlinks"))


def part_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page``: one page per listed part."""
    parts = table(spark, sf_dir, "part").where(F.col("p_size") <= LISTED_SIZE)
    return parts.select(_part_title("p_partkey").alias("page"))


def part_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ``(src, dst)``: each order line links its part to the part numbered like
    its supplier. A few hundred hub targets, some of them not listed."""
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_partkey") != F.col("l_suppkey"))
    return (
        lines.select("l_partkey", "l_suppkey")
        .distinct()
        .select(_part_title("l_partkey").alias("src"), _part_title("l_suppkey").alias("dst"))
    )


def listed_pairs(pairs: DataFrame, listed: DataFrame) -> DataFrame:
    """Pairs whose source has a page."""
    return pairs.join(listed.select(F.col("page").alias("src")), "src", "left_semi")


def _part_title(key: str) -> Column:
    return F.concat(F.lit("Part_"), F.col(key).cast("string"))
