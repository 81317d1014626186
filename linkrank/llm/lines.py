"""Repeated passages of lines: overlapping windows of three consecutive lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.text import packed, text_key, unpacked, whole_text
from linkrank.plans.workspace import Workspace

WINDOW = 3
# What a window must hold to count: anything but white space.
INK = r"[^\x20\x09-\x0D]"


def line_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, key, pos, h1, h2)``: 128 bits of every window of lines, from line ``pos``.

    Windows of blank lines are left out: they separate passages and are none themselves.
    """
    lines = F.split(whole_text(), "\n", -1)
    return (
        docs.select("doc_id", text_key().alias("key"), lines.alias("lines"))
        .where(F.size("lines") >= window)
        .select(
            "doc_id",
            "key",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(1), F.size("lines") - window + 1),
                    lambda i: F.array_join(F.slice("lines", i, window), "\n"),
                )
            ).alias("pos", "passage"),
        )
        .where(F.col("passage").rlike(INK))
        .select(
            "doc_id",
            "key",
            "pos",
            F.xxhash64("passage").alias("h1"),
            F.xxhash64(F.lit(1), "passage").alias("h2"),
        )
    )


def repeated_lines(ws: Workspace, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, key, starts)``: where in a document windows start that occurred before.

    The first occurrence is the smallest ``(doc_id, text key, line)``, null ids first.
    Repeated rows, equal in id and text, are one document here and are cut alike.
    """
    windows = line_windows(docs, window)
    first = F.min(F.struct("doc_id", "key", "pos")).alias("first")
    repeated = ws.save(
        windows.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), first)
        .where("n > 1")
        .drop("n"),
        "windows",
    )
    here = F.struct("doc_id", "key", "pos")
    return (
        windows.join(repeated, ["h1", "h2"])
        .where(here > F.col("first"))
        .groupBy("doc_id", "key")
        .agg(F.collect_set("pos").alias("starts"))
    )


def dedup_lines(ws: Workspace, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns of ``docs``, ``text`` without repeated passages.

    A line goes if any repeated window covers it that is not the first of its kind; the
    lines that stay are joined as they were. A null text stays null, a text of fewer lines
    than a window stays as it is, a text of which no line stays becomes empty.
    """
    names = ("doc_id", "text")
    out = _cut(ws, packed(docs, *names), window)
    return unpacked(out.withColumn("text", _cut_text("text")), docs.columns, names)


def line_report(ws: Workspace, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_lines, n_removed, text)`` of every document; a null text has no line."""
    out = _cut(ws, docs.select("doc_id", "text"), window)
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1)))
    return out.select(
        "doc_id",
        lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
        _cut_text("text"),
    )


def _cut(ws: Workspace, docs: DataFrame, window: int) -> DataFrame:
    """``docs`` with ``__gone``: the line numbers to remove, null where there are none."""
    covered = F.array_distinct(
        F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (window - 1))))
    )
    starts = repeated_lines(ws, docs, window).select(
        F.col("doc_id").alias("__line_id"), F.col("key").alias("__line_key"), covered.alias("__gone")
    )
    found = ws.save(starts, "starts")
    same = F.col("doc_id").eqNullSafe(F.col("__line_id")) & (text_key() == F.col("__line_key"))
    # One plan at every size: the starts grow with the table, so they are never broadcast.
    return docs.join(found.hint("merge"), same, "left").drop("__line_id", "__line_key")


def _cut_text(column: str):
    """The text without the lines in ``__gone``."""
    lines = F.split(F.col(column), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    cut = F.array_join(F.transform(stay, lambda i: lines[i]), "\n")
    return F.when(F.col("__gone").isNull(), F.col(column)).otherwise(cut).alias(column)
