"""Writers for results.

Each result is a folder of part files. Where the result is ordered, so are the parts: read in
name order, or concatenated, they are one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.functions.tokens import to_token
from linkrank.operators.results import sorted_ranks
from linkrank.sources.results import PARQUET

# What is done where the path is there already.
MODE = "errorifexists"


def _write(df: DataFrame, line: Column, path: str, format: str, mode: str) -> None:
    if format == PARQUET:
        df.write.mode(mode).parquet(path)
        return
    df.select(line.alias("value")).write.mode(mode).text(path)


def _page() -> Column:
    return to_token(F.col("page"))


def _links(name: str) -> Column:
    return F.array_join(F.transform(name, to_token), " ")


def _list_line(name: str) -> Column:
    return F.concat_ws("\t", _page(), _links(name))


def write_outlinks(lists: DataFrame, path: str, format: str = PARQUET, mode: str = MODE) -> None:
    """``page <tab> child child …``; a dangling page has no children."""
    _write(lists, _list_line("outlinks"), path, format, mode)


def write_inlinks(lists: DataFrame, path: str, format: str = PARQUET, mode: str = MODE) -> None:
    """``page <tab> parent parent …``."""
    _write(lists, _list_line("inlinks"), path, format, mode)


def write_count(counted: DataFrame, path: str, mode: str = MODE) -> None:
    """``N=<n>`` from the one row of ``page_count``."""
    counted.select(F.format_string("N=%d", "n")).write.mode(mode).text(path)


def write_dropped(counted: DataFrame, path: str, mode: str = MODE) -> None:
    """``name=<n>``, a line for each column of one row of counts."""
    lines = [F.format_string(f"{name}=%d", F.col(name)) for name in counted.columns]
    counted.select(F.explode(F.array(*lines)).alias("value")).write.mode(mode).text(path)


def write_rank_matrix(matrix: DataFrame, path: str, format: str = PARQUET, mode: str = MODE) -> None:
    """``page rank child child …``."""
    line = F.concat_ws(" ", _page(), F.col("pr").cast("string"), _links("outlinks"))
    _write(matrix, line, path, format, mode)


def write_ranks(ranks: DataFrame, path: str, mode: str = MODE) -> None:
    """A snapshot to resume from."""
    ranks.select("page", "pr").write.mode(mode).parquet(path)


def write_sorted(ranks: DataFrame, path: str, format: str = "text", mode: str = MODE) -> None:
    """``page <tab> rank``, highest rank first across the part files in name order."""
    line = F.concat_ws("\t", _page(), F.col("pr").cast("string"))
    _write(sorted_ranks(ranks), line, path, format, mode)
