"""Shards by jump consistent hashing of a stable key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkrank.llm.text import whole_text
from linkrank.plans.workspace import Workspace

# Multiplier of the published jump consistent hash (Lamping and Veach).
JUMP_MULTIPLIER = 2862933555777941757
# Rows numbered by one task.
TASK_ROWS = 500_000


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key. All keys jump together; a finished one stays where it is."""
    state = keys.astype(np.uint64)
    here = np.zeros(len(state), np.int64)
    jumping = np.arange(len(state))
    while len(jumping):
        state[jumping] = state[jumping] * np.uint64(JUMP_MULTIPLIER) + np.uint64(1)
        draw = (state[jumping] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead = ((here[jumping] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        jumping, ahead = jumping[ahead < shards], ahead[ahead < shards]
        here[jumping] = ahead
    return here.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard number of a long column; null goes to shard 0, as does key 0."""

    @F.pandas_udf("int")
    def shard(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in parts:
            yield pd.Series(jump_hash(keys.fillna(0).to_numpy(np.int64).view(np.uint64), shards))

    return shard(key)


def shard_rows(ws: Workspace, docs: DataFrame, shards: int = 8) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``.

    Law ``key``: the id and the number of shards decide, nothing else. Ids are hashed first,
    so that consecutive ones spread. Rows without id share one key; equal ids share a shard.
    ``slot`` numbers a shard's rows from 0 by id, checksum and size. ``grown_shard`` is the
    shard with one more shard: a row stays or moves into the new one. A null text has size 1
    and the checksum of an empty one. Extra columns are ignored, an empty table stays empty.
    """
    text = whole_text()
    key = F.coalesce(F.xxhash64(F.col("doc_id").cast("long")), F.lit(0).cast("long"))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        shard_of(key, shards).alias("shard"),
        shard_of(key, shards + 1).alias("grown_shard"),
    )
    rows = ws.save(rows, "rows")
    tasks = max(1, -(-rows.count() // TASK_ROWS), _shuffle_tasks(ws))
    order = ["shard", "doc_id", "text_crc32", "size"]
    # Sorted runs whose bounds depend on a sample: they are written before they are counted.
    runs = ws.save(
        rows.repartitionByRange(tasks, *order).withColumn("run", F.spark_partition_id()), "runs"
    )
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        runs.groupBy("run", "shard")
        .agg(F.count("*").alias("n"))
        .select("run", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("run", "shard").orderBy(*order[1:])
    return (
        runs.withColumn("inside", F.row_number().over(inside))
        .join(offsets, ["run", "shard"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("offset") + F.col("inside") - 1).cast("long").alias("slot"),
            "grown_shard",
        )
    )


def _shuffle_tasks(ws: Workspace) -> int:
    return int(ws.spark.conf.get("spark.sql.shuffle.partitions"))
