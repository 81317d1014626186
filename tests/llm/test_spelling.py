"""Spelling variants against a comparison of all words."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkrank.llm import spelling as s
from linkrank.llm.queries import op13_spelling_variants
from tests.llm import brute_spelling as brute

NAMES = "word form root n n_near form_n".split()


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=str)


@pytest.fixture(scope="module")
def texts() -> list[dict]:
    rng = random.Random(3)
    made = ["".join(rng.choices("abÀÿ", k=rng.randint(5, 8))) for _ in range(60)]
    words = made + [w[:i] + c + w[i + k :] for w in made for i in (0, 2, len(w)) for c in ("", "a") for k in (0, 1)]
    rows = [
        {"doc_id": i, "text": " ".join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(words, k=40) + rng.choices(made[:9], k=60))}
        for i in range(150)
    ]
    odd = [None, "", " \n", "abab1abab_Ababab-" * 40, "z" * 3000 + " " + "z" * 2999, "日本語 ababab😀"]
    rows += [{"doc_id": 900 + i, "text": t} for i, t in enumerate(odd) for _ in range(6)]
    chain = "dddddd " * 450 + "ddddddd " * 60 + "dddddddd " * 9
    rows += [{"doc_id": 950, "text": chain}]
    return rows + [{"doc_id": None, "text": "ababab abababa"}] * 20


def test_query_equals_comparing_all(spark, tmp_path, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    found = rows_of(op13_spelling_variants(spark, str(tmp_path)))
    expected = brute.variants(brute.vocabulary(texts))
    assert any(r[1] and r[2] != r[1] for r in expected)  # a chain of forms
    assert found == sorted(expected, key=str)


@pytest.mark.parametrize("letters, most", [(1, 3), (2, 10), (3, 1), (4, 10_000)])
def test_large_partitions_are_divided(spark, ws, letters, most):
    rng = random.Random(8)
    counts = {"".join(rng.choices("ab", k=rng.randint(1, 7))): rng.randint(1, 99) for _ in range(250)}
    words = ws.save(spark.createDataFrame(list(counts.items()), "word string, n long"), "words")
    found = {r.word: (r.n_near, -r.best.less, r.best.near) for r in s.near_words(ws, words, letters, most).collect()}
    expected = {}
    for w in counts:
        others = [v for v in counts if brute.near(w, v)]
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            expected[w] = (len(others), counts[best], best)
    assert found == expected


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abc", max_size=5), min_size=1, max_size=40))
def test_composition(words):
    counts = {w: 1 for w in words}
    found = s.compose(counts)
    for w in words:
        others = sorted(v for v in words if brute.near(w, v))
        assert found.get(w) == ((len(others), (-1, others[0])) if others else None)


def test_acceptor_is_minimal():
    acceptor = s.Acceptor(sorted(a + b for a in ("x", "yy", "z") for b in ("ing", "ings", "ed")))
    # initial, the second y, four of the endings' begin and middle, and one end
    assert len(acceptor.arcs) == len({(f, *a.items()) for f, a in zip(acceptor.final, acceptor.arcs, strict=True)})
    assert len(acceptor.arcs) == 8


def test_clashing_names_and_hot_word(spark, ws):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("ababab abcabc ababac").alias("text"),
        *(F.lit(7).alias(c) for c in ("word", "run", "id", "mark", "n", "led", "at")),
    )
    words = {r.word: r.n for r in s.vocabulary(docs).collect()}
    assert words["ababab"] > 19_000 and len(words) >= 3


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(op13_spelling_variants(spark, str(tmp_path))) == []
