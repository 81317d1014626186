"""Conversation repair against a version that tries every edit."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from linkrank.llm import conversations as c
from linkrank.llm.queries import op12_conversation_repair
from tests.llm import brute_repair as brute

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def conversation(rng: random.Random, conv: int | None, size: int) -> list[dict]:
    texts = ["Yes.", "No", " \n", "", "What now?", "long " * 50 + "end!", "Ünï 日本.", None]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    return [
        {
            "conv_id": conv,
            "turn": rng.choice([i, i, i, i + 2, None]),
            "role": rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[i % 2],
            "text": rng.choice(texts) if rng.random() < 0.4 else f"turn {i}{rng.choice(['.', ''])}",
        }
        for i in range(size)
    ]


@pytest.fixture(scope="module")
def turns() -> list[dict]:
    rng = random.Random(5)
    rows = [r for i in range(120) for r in conversation(rng, i, rng.randint(1, 12))]
    return rows + conversation(rng, None, 9) + conversation(rng, 500, 300) + rows[:30]


def report(spark, tmp_path, rows) -> list[tuple]:
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    found = op12_conversation_repair(spark, str(tmp_path)).select(*NAMES).collect()
    return sorted((tuple(r) for r in found), key=str)


# Pieces of 4 rows make most conversations cross pieces and runs.
@pytest.mark.parametrize("piece", [4, c.PIECE_ROWS])
def test_equals_every_edit_tried(spark, tmp_path, turns, monkeypatch, piece):
    monkeypatch.setattr(c, "PIECE_ROWS", piece)
    assert report(spark, tmp_path, turns) == sorted(brute.op12(turns), key=str)


def test_conversation_in_several_runs(ws, spark):
    rows = conversation(random.Random(9), 1, 2000)
    rows = [r | {"text": r["text"] or " ", "role": r["role"] or " "} for r in rows]
    done = c.repair_conversations(ws, spark.createDataFrame(rows, SCHEMA))
    (found,) = done.reports.collect()
    assert done.pieces.count() > 4
    (digest,) = c.turns_digest(done.pieces).collect()
    expected = brute.repair([(r["turn"], r["role"], r["text"]) for r in rows])
    assert (*tuple(found)[1:], digest.repaired_sha256) == expected


def test_repeated_rows_are_one_row_and_duplicates(ws, spark):
    rows = spark.range(100_000).select(
        F.lit(1).alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("user").alias("role"),
        F.lit("Same.").alias("text"),
    )
    (found,) = c.repair_conversations(ws, rows).reports.collect()
    assert (found.duplicate, found.illegal, found.gaps) == (99_999, 99_999, 0)
    assert (found.cost, found.audit) == (4 * 99_999 + 3, "K" + "D" * 99_999 + "I")


def test_long_texts_and_clashing_names(ws, spark):
    rows = [(1, 0, "user", "x" * 2_000_000 + "."), (1, 1, "assistant", "ok.")]
    names = ("key", "row", "run", "piece", "seq", "digest", "n", "part", "report")
    df = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit(7).alias(n) for n in names))
    done = c.repair_conversations(ws, df)
    (found,) = done.reports.collect()
    assert (found.cost, found.audit) == (0, "KK")
    pieces = sorted(done.pieces.collect(), key=lambda p: p.part)
    assert [len(t.text) for p in pieces for t in p.turns] == [2_000_001, 3]


def test_empty_table(spark, tmp_path):
    assert report(spark, tmp_path, []) == []
