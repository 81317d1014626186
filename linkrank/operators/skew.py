"""Salting for keys that hold more rows than one task should take.

A key is hot when it holds more than ``limit`` rows. There can be at most
``total / limit`` such keys, so a table of them is bounded by construction and is
safe to broadcast however large the data is. Rows of a hot key are spread over
``shares`` salts; the other side of a join repeats its row once per salt. Salts fall
on tasks by hash, so shares are a fraction of the limit: several may meet in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "salt"
SHARES = "shares"

# Below this many rows a key is never worth splitting.
HOT_ROWS = 1_000_000
# Salts per ``limit`` rows.
LIMIT_SHARES = 8


def hot_limit(total: int, tasks: int, hot_rows: int = HOT_ROWS) -> int:
    """Rows one key may hold: an average task's share, but at least ``hot_rows``."""
    return max(1, hot_rows, math.ceil(total / max(1, tasks)))


def hot_keys(
    counts: DataFrame, key: str, rows: str, limit: float, limit_shares: int = LIMIT_SHARES
) -> DataFrame:
    """``(key, shares)`` of the keys above the limit: at most total / limit rows."""
    shares = F.ceil(F.col(rows) * limit_shares / F.lit(float(limit)))
    return counts.where(F.col(rows) > limit).select(key, shares.cast("int").alias(SHARES))


def counted_hot_keys(rows: DataFrame, key: str, total: int, limit: int) -> DataFrame | None:
    """Hot keys of a table whose per-key counts are not known, or None if there are none.

    Counts every row, summed per task before the shuffle. The keys found (at most
    total / limit) are fixed on the driver, so that both sides of a join see the same salts.
    """
    if total <= limit:
        return None
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    found = hot_keys(counts, key, "rows", limit).collect()
    if not found:
        return None
    schema = f"`{key}` {dict(rows.dtypes)[key]}, {SHARES} int"
    return rows.sparkSession.createDataFrame(found, schema)


def salted(df: DataFrame, hot: DataFrame | None, key: str, spread: Column) -> DataFrame:
    """Add the salt: a function of ``spread`` for rows of hot keys, 0 for all others."""
    if hot is None:
        return df
    salt = F.coalesce(F.pmod(F.xxhash64(spread), F.col(SHARES)), F.lit(0)).cast("int")
    return df.join(F.broadcast(hot), key, "left").withColumn(SALT, salt).drop(SHARES)


def replicated(df: DataFrame, hot: DataFrame | None, key: str) -> DataFrame:
    """Repeat the row of a hot key once per salt, so that it meets ``salted`` rows."""
    if hot is None:
        return df
    salts = F.sequence(F.lit(0), F.coalesce(F.col(SHARES), F.lit(1)) - 1)
    return df.join(F.broadcast(hot), key, "left").withColumn(SALT, F.explode(salts)).drop(SHARES)


def join_keys(hot: DataFrame | None, key: str) -> list[str]:
    return [key] if hot is None else [key, SALT]
