"""Tag-delimited page records from XML dumps."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START_TAG = "<page>"
END_TAG = "</page>"


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    start_tag: str = START_TAG,
    end_tag: str = END_TAG,
) -> DataFrame:
    """``xml``: one row per block, from a start tag to the next end tag.

    The end tag is the line separator of a text read, so files split, decompress and list as
    any text does, and a record is a chunk from its first start tag on, wherever splits fall.
    Only a file's last chunk may lack its end tag; where a file is cut inside a block, that
    chunk is dropped. To know it takes two more reads; ``read_chunks`` is for plans that
    write what they read and can look there.
    """
    chunks = read_chunks(spark, path, start_tag, end_tag).where("xml IS NOT NULL")
    tails = F.broadcast(_cut_tails(spark, path, start_tag, end_tag))
    return chunks.join(tails, ["file", "record"], "left_anti").select("xml")


def read_chunks(
    spark: SparkSession,
    path: str | list[str],
    start_tag: str = START_TAG,
    end_tag: str = END_TAG,
) -> DataFrame:
    """``(file, block, record, xml)`` in one read: a row per chunk, ``xml`` null where it
    holds no block. ``record`` numbers the chunks in order, inside a file and its blocks.

    A file's last chunk is taken for a whole block here even where the file is cut;
    ``cut_records`` tells which ones those are once ``file``, ``block`` and ``record`` are
    written.
    """
    value = F.col("value")
    opened = F.substr("value", F.locate(start_tag, value))
    xml = F.when(F.contains(value, F.lit(start_tag)), F.concat(opened, F.lit(end_tag)))
    return _chunks(spark, path, end_tag).select("file", "block", "record", xml.alias("xml"))


def cut_records(
    spark: SparkSession,
    chunks: DataFrame,
    start_tag: str = START_TAG,
    end_tag: str = END_TAG,
) -> list[int]:
    """Numbers of the records that a file is cut inside, from written
    ``chunks(file, block, record, opened)`` of whole files.

    Only a file whose last chunk holds a start tag can be cut, or ends with an end tag to the
    byte. Dumps seldom do either, so as a rule no file is looked at again; those that do
    are read once more. There is at most one number for each.
    """
    last = F.max_by(F.struct("record", "opened"), F.struct("block", "record")).alias("last")
    ends = chunks.groupBy("file").agg(last).where("last.opened")
    open_ends = {row.file: row.last.record for row in ends.collect()}
    if not open_ends:
        return []
    names = [re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(name)) for name in open_ends]
    cut = _cut_files(spark, names, start_tag, end_tag).select("file").collect()
    return sorted(open_ends[row.file] for row in cut)


def _chunks(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    """``(value, file, block, record)``: chunks, and where a file's chunks stand in it."""
    chunks = spark.read.option("lineSep", separator).text(path)
    return chunks.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("record"),
    )


def _cut_files(
    spark: SparkSession, path: str | list[str], start_tag: str, end_tag: str
) -> DataFrame:
    """``file``: those that end inside a block.

    An end tag less its last character separates even a last complete block from what
    follows, if only that character: so a file is cut if the last such piece holds a start
    tag. Only separators are looked for; no markup is parsed.
    """
    pieces = _chunks(spark, path, end_tag[:-1])
    opened = F.contains("value", F.lit(start_tag))
    last = F.max_by(opened, F.struct("block", "record")).alias("cut")
    return pieces.groupBy("file").agg(last).where("cut").select("file")


def _cut_tails(
    spark: SparkSession, path: str | list[str], start_tag: str, end_tag: str
) -> DataFrame:
    """``(file, record)``: the last chunks of files that end inside a block."""
    last = F.max_by("record", F.struct("block", "record")).alias("record")
    ends = _chunks(spark, path, end_tag).groupBy("file").agg(last)
    return ends.join(_cut_files(spark, path, start_tag, end_tag), "file")
