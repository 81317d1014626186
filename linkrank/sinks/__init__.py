"""Writers for the graph, the page count, rank snapshots and sorted ranks."""

from linkrank.sinks.results import (
    write_count,
    write_dropped,
    write_inlinks,
    write_outlinks,
    write_rank_matrix,
    write_ranks,
    write_sorted,
)

__all__ = [
    "write_count",
    "write_dropped",
    "write_inlinks",
    "write_outlinks",
    "write_rank_matrix",
    "write_ranks",
    "write_sorted",
]
