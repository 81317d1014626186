from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int, letters: str) -> str:
    made = ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(40)]
    lines, line = [], []
    for _ in range(words):
        line.append(rng.choice(made) + rng.choice(["", "", "", ","]))
        if rng.random() < 0.1:
            lines.append(" ".join(line))
            line = []
    return "\n".join([*lines, " ".join(line)])


@pytest.fixture(scope="session")
def rows() -> list[dict]:
    """Copies, near copies, shared passages, and the cases an operator must bear."""
    rng = random.Random(11)
    alphabets = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "qrstuvwxyzé"}
    passage = prose(rng, 60, "abcdxyz")
    out = []
    for i in range(260):
        lang = rng.choice(list(alphabets))
        text = prose(rng, rng.randint(5, 300), alphabets[lang])
        if i % 5 in (1, 2):
            lang = out[-1]["lang"]
            text = out[-1]["text"]
        if i % 5 == 2:
            words = out[-1]["text"].split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        if i % 7 == 0:
            text = f"{text}\n{passage}\n{text[:50]}"
        out.append({"doc_id": i, "text": text, "lang": lang, "source": f"s{i % 4 * (i % 3)}"})
    hot = prose(rng, 80, "abcdefgh")
    out += [{"doc_id": 300 + i, "text": hot, "lang": "aa", "source": "hot"} for i in range(130)]
    odd = [
        None, "", " \n\t", "a", "no", "\n\n\n\n", "1 2 3 4", "### $$$ ***", "Ünïcode 日本語 \U0001f600 x\r\n",
        "ab " * 4000, "z" * 5000, "a@b.c 1.2.3.4 1.2.3.4.5.6.7.8 999.1.1.1",
        "mail x.y@d-e.com,z@q.r.s_t@u.v +1 (286) 555-5136 4737097684299439 4737 0976 8429 9439 1",
        "x" * 300 + " " + "x" * 300, "one\ntwo\nthree\none\ntwo\nthree\nfour",
    ]
    out += [{"doc_id": 500 + i, "text": t, "lang": None, "source": None} for i, t in enumerate(odd)]
    for row in out:
        row["n_chars"] = len(row["text"] or "")
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def awkward(spark, rows):
    """Null ids, repeated rows and clashing column names."""
    some = [dict(r) for r in rows[:60]] + [dict(r) for r in rows[:20]]
    for row in some[10:16]:
        row["doc_id"] = None
    for row in some:
        row |= {c: 7 for c in ("key", "body", "row", "size", "node", "score", "shard", "__gone")}
    extra = "key int, body int, row int, size int, node int, score int, shard int, `__gone` int"
    return spark.createDataFrame(some, f"{SCHEMA}, {extra}")
