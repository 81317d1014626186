"""From raw page records to pages and their links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.functions import markup


def parse_pages(records: DataFrame, xml: str = "xml") -> DataFrame:
    """Replace the raw record by ``title`` and ``body``; other columns pass through.

    A record without a complete body does not exist as a page. A record without a
    title cannot be placed in the graph; ``malformed_records`` counts those.
    """
    raw = F.col(xml)
    others = [c for c in records.columns if c != xml]
    found = records.select(
        *others,
        F.when(markup.has_title(raw), markup.page_title(raw)).alias("_title"),
        markup.after_body_tag(raw).alias("_rest"),
    )
    # A generator, not a filter: a filter would be pushed below the expressions above and
    # below whatever builds the record, and evaluate them again for each condition.
    exists = F.col("_title").isNotNull() & markup.closes_body(F.col("_rest"))
    page = F.struct(F.col("_title").alias("title"), markup.page_body(F.col("_rest")).alias("body"))
    return found.select(*others, F.inline(F.when(exists, F.array(page))))


# Why a record is no page.
NO_TITLE, NO_BODY, OPEN_BODY = "no title", "no body", "open body"


def parse_records(records: DataFrame, xml: str = "xml") -> DataFrame:
    """Replace the raw record by ``title``, ``body`` and ``dropped``: one row per record.

    Of a record that is no page ``dropped`` tells why, and title and body are null; of a row
    without a record all three are null.
    """
    raw = F.col(xml)
    others = [c for c in records.columns if c != xml]
    found = records.select(
        *others,
        raw.isNull().alias("_none"),
        F.when(markup.has_title(raw), markup.page_title(raw)).alias("_title"),
        markup.after_body_tag(raw).alias("_rest"),
    )
    rest = F.col("_rest")
    why = (
        F.when(F.col("_title").isNull(), NO_TITLE)
        .when(rest.isNull(), NO_BODY)
        .when(~markup.closes_body(rest), OPEN_BODY)
    )
    found = found.withColumn("dropped", F.when(~F.col("_none"), why))
    page = ~F.col("_none") & F.col("dropped").isNull()
    return found.select(
        *others,
        F.when(page, F.col("_title")).alias("title"),
        F.when(page, markup.page_body(rest)).alias("body"),
        "dropped",
    )


def count_records() -> list[Column]:
    """What became of the records, as aggregates over ``parse_records`` to be observed while
    a plan reads them."""
    why = F.col("dropped")
    names = {"no_title": NO_TITLE, "no_body": NO_BODY, "open_body": OPEN_BODY}
    return [
        F.count_if(F.col("title").isNotNull()).alias("pages"),
        *(F.count_if(why == reason).alias(name) for name, reason in names.items()),
    ]


def malformed_records(records: DataFrame, xml: str = "xml") -> DataFrame:
    """Records that lack a title element or any body tag."""
    raw = F.col(xml)
    return records.where(~(markup.has_title(raw) & markup.has_open_body(raw)))


def page_links(pages: DataFrame) -> DataFrame:
    """Replace ``body`` by ``links``: each target once per record, never the page itself."""
    others = [c for c in pages.columns if c != "body"]
    targets = F.array_distinct(markup.link_targets(F.col("body")))
    return pages.select(*others, F.array_remove(targets, F.col("title")).alias("links"))
