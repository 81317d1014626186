"""Readers: page dumps and the text or Parquet forms of every result."""

from linkrank.sources.dump import cut_records, read_chunks, read_pages
from linkrank.sources.results import (
    read_count,
    read_inlinks,
    read_outlinks,
    read_rank_matrix,
    read_ranks,
)

__all__ = [
    "cut_records",
    "read_chunks",
    "read_count",
    "read_inlinks",
    "read_outlinks",
    "read_pages",
    "read_rank_matrix",
    "read_ranks",
]
