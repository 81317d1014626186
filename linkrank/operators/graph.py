"""Link graph operators.

Column names used throughout: ``pages(page)``, ``pairs(src, dst)`` with one row per
record and target, ``edges(src, dst, copies)`` with one row per distinct pair.
``copies`` counts the records that hold the link, so records that share a title keep
their weight without repeating the row.

Records carry a number, and a page's ``id`` is the least number of its records. So links know
the id of their source as soon as they are taken out of a record; only their targets have to
be looked up by title.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.operators.skew import SHARES, hot_keys, join_keys, replicated, salted

# Links in one adjacency row; a page with more continues in further rows.
ROW_LINKS = 1_000_000
# Pages whose shares are broadcast, those with the longest lists; others get theirs by a join.
SPLIT_PAGES = 100_000
# Records with the title of another one, up to which their ids are broadcast.
BROADCAST_RECORDS = 1_000_000


def link_pairs(linked: DataFrame) -> DataFrame:
    """One ``(src, dst)`` row per record and target, links to missing pages included."""
    return linked.select(F.col("title").alias("src"), F.explode("links").alias("dst"))


def existing_pages(pages: DataFrame) -> DataFrame:
    """``page``: the distinct titles of pages that exist."""
    return pages.select(F.col("title").alias("page")).distinct()


def page_nodes(linked: DataFrame) -> DataFrame:
    """Existing pages with the number of records and of link pairs behind each, and with
    their ``id`` where records are numbered."""
    numbered = [F.min("record").alias("id")] if "record" in linked.columns else []
    return linked.groupBy(F.col("title").alias("page")).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.size("links")).alias("links"),
        *numbered,
    )


def page_count(pages: DataFrame) -> DataFrame:
    """``n``: the number of distinct existing pages."""
    return pages.agg(F.count(F.lit(1)).alias("n"))


def merge_copies(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with their number of copies, summed before the shuffle."""
    return pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))


def single_copies(pairs: DataFrame) -> DataFrame:
    """The same for pairs that are known to be distinct: no shuffle."""
    return pairs.select("src", "dst", F.lit(1).cast("bigint").alias("copies"))


def numbered_pages(nodes: DataFrame) -> DataFrame:
    """Add a distinct ``id`` per page. Write the table before use: that fixes the ids."""
    return nodes.withColumn("id", F.monotonically_increasing_id())


def existing_links(
    links: DataFrame, nodes: DataFrame, hot_targets: DataFrame | None = None
) -> DataFrame:
    """Links whose target exists. Rows of ``hot_targets(dst, shares)`` spread over salts.

    Of numbered nodes the target's id comes along as ``dst_id``.
    """
    left = salted(links, hot_targets, "dst", F.col("src"))
    numbered = [F.col("id").alias("dst_id")] if "id" in nodes.columns else []
    right = replicated(nodes.select(F.col("page").alias("dst"), *numbered), hot_targets, "dst")
    # A page is one row, so the join that brings the id keeps the rows a semi join keeps.
    how = "inner" if numbered else "left_semi"
    found = left.join(right, join_keys(hot_targets, "dst"), how)
    return found.select(*links.columns, *(["dst_id"] if numbered else []))


def shared_titles(linked: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(record, id)``: page ids of the records whose title others have too."""
    shared = nodes.where("records > 1").select(F.col("page").alias("title"), "id")
    return linked.select("title", "record").join(shared, "title").select("record", "id")


def record_links(linked: DataFrame, shared: DataFrame | None = None, rows: int = 0) -> DataFrame:
    """``(src, dst, copies)``: links by the id of their source and the title of their target.

    A record's number is its page's id, so a link has it from birth. Records that ``shared``
    (``rows`` of them) lists take their page's id, and only their links are merged.
    """
    if shared is None:
        return _numbered(linked, F.col("record"), F.lit(1).cast("bigint"))
    if rows <= BROADCAST_RECORDS:
        shared = F.broadcast(shared)
    own = linked.join(shared, "record", "left_anti")
    of_others = _numbered(linked.join(shared, "record"), F.col("id"))
    return _numbered(own, F.col("record"), F.lit(1).cast("bigint")).unionByName(
        merge_copies(of_others)
    )


def _numbered(linked: DataFrame, source: Column, *copies: Column) -> DataFrame:
    counted = [c.alias("copies") for c in copies]
    return linked.select(source.alias("src"), *counted, F.explode("links").alias("dst"))


def source_ids(
    links: DataFrame, nodes: DataFrame, hot_sources: DataFrame | None = None
) -> DataFrame:
    """Links with their source's id for its title."""
    left = salted(links, hot_sources, "src", F.col("dst"))
    ids = nodes.select(F.col("page").alias("src"), "id")
    right = replicated(ids, hot_sources, "src")
    return left.join(right, join_keys(hot_sources, "src")).select(
        F.col("id").alias("src"), "dst", "copies"
    )


def source_titles(
    links: DataFrame, nodes: DataFrame, hot_sources: DataFrame | None = None
) -> DataFrame:
    """Links with their source's title for its id."""
    left = salted(links, hot_sources, "src", F.col("dst"))
    titles = nodes.select(F.col("id").alias("src"), "page")
    right = replicated(titles, hot_sources, "src")
    return left.join(right, join_keys(hot_sources, "src")).select(
        F.col("page").alias("src"), "dst", "copies"
    )


def red_links(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Missing targets with the number of records that link there.

    Counted before the join, so a target that many records miss is one row by then.
    """
    targets = pairs.groupBy("dst").agg(F.count(F.lit(1)).alias("n"))
    return targets.join(nodes.select(F.col("page").alias("dst")), "dst", "left_anti")


def out_degree(edges: DataFrame) -> DataFrame:
    """Surviving links per source, copies included."""
    return edges.groupBy("src").agg(F.sum("copies").alias("deg"))


def in_degree(edges: DataFrame) -> DataFrame:
    """Surviving links per target, copies included."""
    return edges.groupBy("dst").agg(F.sum("copies").alias("deg"))


def page_degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(page, deg)`` for every page, 0 without outlinks; a title passes through."""
    degrees = out_degree(edges).withColumnRenamed("src", "page")
    others = [c for c in ("title",) if c in nodes.columns]
    return nodes.join(degrees, "page", "left").select(
        "page", F.coalesce("deg", F.lit(0).cast("bigint")).alias("deg"), *others
    )


def outlinks(edges: DataFrame, nodes: DataFrame, row_links: int = ROW_LINKS) -> DataFrame:
    """``(page, part, outlinks)``: children per page, empty for a dangling page."""
    return _adjacency(edges, nodes, "src", "dst", "outlinks", row_links)


def inlinks(edges: DataFrame, nodes: DataFrame, row_links: int = ROW_LINKS) -> DataFrame:
    """``(page, part, inlinks)``: parents per page, empty for a page nobody links to."""
    return _adjacency(edges, nodes, "dst", "src", "inlinks", row_links)


def _adjacency(
    edges: DataFrame, nodes: DataFrame, key: str, other: str, name: str, row_links: int
) -> DataFrame:
    """Lists of at most about ``row_links`` links, however large the graph is; ``part``
    numbers a page's rows from 0.

    Pages without links take part as a row without a link, which the list ignores, so
    one grouping serves both and no join is needed. Reads ``edges`` first for the sizes
    of the lists: pass a written table.
    """
    degrees = edges.groupBy(F.col(key).alias("page")).agg(F.sum("copies").alias("deg"))
    sizes = degrees.agg(F.sum("deg").alias("total"), F.max("deg").alias("longest")).first()
    links = edges.select(F.col(key).alias("page"), F.col(other).alias("link"), "copies")
    if (sizes.longest or 0) <= row_links:
        links = links.withColumn("part", F.lit(0))
    else:
        shared = _with_shares(links, degrees, sizes.total, row_links)
        links = _numbered_parts(shared, row_links)
    unlinked = nodes.select(
        "page",
        F.lit(None).cast("string").alias("link"),
        F.lit(0).cast("bigint").alias("copies"),
        F.lit(0).alias("part"),
    )
    repeated = F.when(F.col("link").isNotNull(), F.array_repeat("link", F.col("copies").cast("int")))
    lists = F.sort_array(F.flatten(F.collect_list(repeated)))
    return links.unionByName(unlinked).groupBy("page", "part").agg(lists.alias(name))


def _with_shares(links: DataFrame, degrees: DataFrame, total: int, limit: int) -> DataFrame:
    """Add how many rows a page's list takes; null for one.

    At most ``SPLIT_PAGES`` pages hold more than ``total / SPLIT_PAGES`` links: theirs are
    broadcast. All others with several rows are joined by page, and none of those keys
    holds more links than that.
    """
    longest = max(limit, math.ceil(total / SPLIT_PAGES))
    hot = F.broadcast(hot_keys(degrees.where(F.col("deg") > longest), "page", "deg", limit, 1))
    if longest == limit:
        return links.join(hot, "page", "left")
    other = hot_keys(degrees.where(F.col("deg") <= longest), "page", "deg", limit, 1)
    cold = links.join(hot, "page", "left_anti").join(other, "page", "left")
    return cold.unionByName(links.join(hot, "page"))


def _numbered_parts(links: DataFrame, limit: int) -> DataFrame:
    """Spread the links of long lists over parts, and many copies of one link as well."""
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / F.lit(limit)))
    chunked = links.withColumn("chunk", F.explode(chunks))
    left_over = F.col("copies") - F.col("chunk") * F.lit(limit)
    part = F.pmod(F.xxhash64("link", "chunk"), F.col(SHARES))
    return chunked.select(
        "page",
        "link",
        F.least(left_over, F.lit(limit).cast("bigint")).alias("copies"),
        F.coalesce(part, F.lit(0)).cast("int").alias("part"),
    )


def transpose_inlinks(lists: DataFrame) -> DataFrame:
    """Inlink rows back to one ``(src, dst)`` row per link."""
    return lists.select(F.explode("inlinks").alias("src"), F.col("page").alias("dst"))


def outlink_pairs(lists: DataFrame) -> DataFrame:
    """Outlink rows back to one ``(src, dst)`` row per link."""
    return lists.select(F.col("page").alias("src"), F.explode("outlinks").alias("dst"))
