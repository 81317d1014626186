"""What several operators share: words, keys of rows, running sums inside a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but a space and the five ASCII line and tab characters.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of texts that a worker has as Python values at a time.
STRETCH_BYTES = 1 << 18
# Values added up by one lambda call, and how often blocks are made of blocks, see running_sum.
BLOCK = 64
BLOCK_LEVELS = 2


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text") -> Column:
    """The text of a row, empty for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: str = "text") -> Column:
    """64 bits of the text. With ``doc_id`` it tells rows apart; rows equal in both are
    copies of one row, and get equal results."""
    return F.xxhash64(whole_text(column))


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")


# Columns of a table that an operator does not look at, as one.
OTHERS = "__others"


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and all others as one: no name that an operator adds can clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return docs.select(*names, (F.struct(*others) if others else F.lit(0)).alias(OTHERS))


def unpacked(df: DataFrame, columns: list[str], names: tuple[str, ...]) -> DataFrame:
    """The columns that a packed table had, in their order."""
    return df.select(*[F.col(c) if c in names else F.col(OTHERS)[c].alias(c) for c in columns])


def stretches(
    batch: pa.RecordBatch, *names: str, most: int = STRETCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in turn, in parts of at most so many bytes in the named columns; a
    longer row is a part of its own. A batch holds 10,000 rows, however long their texts are:
    of only one part at a time there need be Python values and results."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for name in names:
        sizes += pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        begun = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, begun + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body's lambdas use it."""
    return F.transform(F.array(value), body)[0]


def running_sum(values: Column) -> Column:
    """For each element of an array of longs the sum of all before it.

    Sums of blocks, and of blocks of blocks, come first: no element adds up more than a block
    of each, however long the array is.
    """

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    def sums(v: Column, levels: int) -> Column:
        if not levels:
            return F.transform(v, lambda _, i: total(F.slice(v, F.lit(1), i)))
        last = F.greatest(F.size(v) - 1, F.lit(0))
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor(last / BLOCK).cast("int")),
            lambda b: total(F.slice(v, b * BLOCK + 1, BLOCK)),
        )

        def before(b: Column) -> Column:
            def at(_: Column, i: Column) -> Column:
                block = F.floor(i / BLOCK).cast("int")
                inside = F.slice(v, block * BLOCK + 1, i - block * BLOCK)
                return b[block] + total(inside)

            return F.transform(v, at)

        return let(let(blocks, lambda b: sums(b, levels - 1)), before)

    return let(values, lambda v: sums(v, BLOCK_LEVELS))
