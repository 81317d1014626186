"""Row numbers over a whole table without a task that sees all of it."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.plans.workspace import Workspace, shuffle_tasks

# monotonically_increasing_id counts the rows of a task in its lower bits.
ROW_BITS = 33


def with_positions(
    ws: Workspace, df: DataFrame, order: list[str | Column], name: str = "position"
) -> DataFrame:
    """Add a row's number in this order, from 1.

    One exchange: rows are sorted into ranges and written with their number inside the range;
    what the ranges before hold is added from a table of one row per task. Rows that are equal
    in ``order`` get numbers one after another, in no fixed order.
    """
    tasks = shuffle_tasks(ws.spark)
    runs = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed = ws.save(runs.withColumn("__place", F.monotonically_increasing_id()), "runs")
    run = F.shiftright("__place", ROW_BITS).cast("int")
    counts = placed.groupBy(run.alias("run")).agg(F.count(F.lit(1)).alias("rows"))
    sizes = sorted(counts.collect())
    before = [0, *accumulate(row.rows for row in sizes)]
    offsets = [(row.run, n) for row, n in zip(sizes, before, strict=False)]
    starts = ws.spark.createDataFrame(offsets, "__run int, __before long")
    inside = F.col("__place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        placed.withColumn("__run", run)
        .join(F.broadcast(starts), "__run")
        .withColumn(name, F.col("__before") + inside + 1)
        .drop("__place", "__run", "__before")
    )
