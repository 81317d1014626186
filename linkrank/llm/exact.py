"""Exact duplicates by counting quotient filters and comparison of whole texts.

Every partition builds a counting quotient filter of its texts' fingerprints: the leading
bits of a fingerprint (the quotient) choose a slot range, the sorted rest (the remainder) is
stored with a count. Filters of different partitions merge without loss, range by range, by
merging their sorted remainders. Only texts whose fingerprint counts more than one are
compared, byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.text import whole_text
from linkrank.plans.workspace import Workspace

# Fingerprints that one slot range holds on average; the merge of a range is one task's work.
RANGE_ROWS = 200_000
# Rows a partition's filter takes before it is handed on and a new one begins.
FILTER_ROWS = 1_000_000
# Repeated fingerprints that may be broadcast (16 MB); beyond it they are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def _pack(fingerprints: np.ndarray, bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Slot ranges of a filter: quotient, sorted remainders, their counts."""
    values, counts = np.unique(fingerprints, return_counts=True)
    quotients = values >> np.uint64(64 - bits) if bits else np.zeros_like(values)
    starts = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]])
    for a, b in zip(starts, [*starts[1:], len(values)], strict=True):
        remainders = values[a:b] << np.uint64(bits)
        yield int(quotients[a]), remainders.tobytes(), counts[a:b].astype("<i8").tobytes()


def partition_filters(fingerprints: DataFrame, bits: int) -> DataFrame:
    """``(quotient, remainders, counts)``: each partition's filters, one row per slot range."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(parts: list[np.ndarray]) -> pa.RecordBatch:
            rows = list(_pack(np.concatenate(parts), bits))
            q, r, c = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(r, pa.binary()), pa.array(c, pa.binary())],
                names=["quotient", "remainders", "counts"],
            )

        held: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= FILTER_ROWS:
                yield made(held)
                held = []
        if held:
            yield made(held)

    return fingerprints.mapInArrow(build, "quotient long, remainders binary, counts binary")


def repeated_fingerprints(filters: DataFrame, bits: int) -> DataFrame:
    """``fp``: fingerprints that all filters together count more than once."""

    def merge(table: pa.Table) -> pa.Table:
        remainders = np.concatenate([np.frombuffer(x, "<u8") for x in table[1].to_pylist()])
        counts = np.concatenate([np.frombuffer(x, "<i8") for x in table[2].to_pylist()])
        # The runs are sorted: a stable sort merges them.
        order = np.argsort(remainders, kind="stable")
        remainders, counts = remainders[order], counts[order]
        starts = np.flatnonzero(np.r_[True, remainders[1:] != remainders[:-1]])
        again = np.add.reduceat(counts, starts) > 1
        high = np.uint64(table[0][0].as_py() << (64 - bits) if bits else 0)
        found = (remainders[starts[again]] >> np.uint64(bits)) | high
        return pa.table({"fp": pa.array(found.view(np.int64))})

    return filters.groupBy("quotient").applyInArrow(merge, "fp long")


def exact_duplicates(ws: Workspace, docs: DataFrame) -> DataFrame:
    """One row per document: ``(doc_id, keep_id, group_size, kept, text_sha256)``.

    Texts are equal if they are the same string; null counts as empty. The largest
    ``doc_id`` of a group stays; null ids are smaller than any other, so ``keep_id`` is null
    only where all ids are. Repeated rows with the id that stays are all marked as kept.
    Extra columns are ignored, an empty table gives an empty result.
    """
    text = whole_text()
    keyed = docs.select("doc_id", text.alias("body"), F.xxhash64(text).alias("fp"))
    rows = ws.save(
        keyed.select("doc_id", "fp", F.sha2("body", 256).alias("text_sha256")), "rows"
    )
    bits = max(0, int(rows.count() // RANGE_ROWS)).bit_length()
    filters = partition_filters(rows.select("fp"), bits)
    repeated = ws.save(repeated_fingerprints(filters, bits), "repeated")
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    groups = ws.save(
        keyed.join(repeated, "fp", "left_semi")
        .groupBy("body")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where(F.col("group_size") > 1)
        .select(F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size"),
        "groups",
    )
    alone = F.col("group_size").isNull()
    return rows.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )
