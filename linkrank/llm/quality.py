"""Quality rules: fixed base rules, then robust outliers among documents of one kind.

For each language and source a minimum-covariance-determinant estimate gives centre and
scatter of five transformed statistics. Several fixed starts (median deviations, signs about
the medians, all rows) are concentrated side by side: each step keeps the three quarters of
the rows that lie nearest and estimates anew, which never raises the determinant. Of a kind's
starts the one of least determinant is kept, and a last step takes all rows within a
chi-square quantile of it. Documents whose Mahalanobis distance is too large are rejected.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.text import WORD
from linkrank.plans.workspace import Workspace

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
# Groups of fewer rows are judged with all small groups of their language, or with all others.
GROUP_ROWS = 200
KEPT_SHARE = 0.75
STEPS = 5
# Shares of normal rows that the last estimate is made from, and that are kept.
NEAR_SHARE = 0.975
NORMAL_SHARE = 0.999
# The share from which symbols and repeats count by their ratio.
SMALL_SHARE = 0.01
# Least standard deviations of a group, in any direction, and the digits that statistics and
# distances keep: that bounds their distinct values.
FLOORS = (0.15, 0.5, 0.5, 0.5, 0.02)
DIGITS = 3
FAR = 10_000.0
STATS = ("word_length", "symbols", "dup_lines", "repeats", "variety")
PAIRS = tuple(combinations_with_replacement(range(len(STATS)), 2))


def chi_square(x: float, degrees: int = len(STATS)) -> float:
    """Distribution function of a chi-square with an odd number of degrees of freedom."""
    total = math.erf(math.sqrt(x / 2))
    for k in range(1, degrees, 2):
        total -= (x / 2) ** (k / 2) * math.exp(-x / 2) / math.gamma(k / 2 + 1)
    return total


def quantile(share: float) -> float:
    """The squared distance that such a share of normal rows stays within."""
    low, high = 0.0, FAR
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle) < share else (low, middle)
    return round(high, DIGITS)


def consistency(share: float) -> float:
    """What the scatter of the nearest rows is too small by, if all rows are normal."""
    return share / chi_square(quantile(share), len(STATS) + 2)


CUT = quantile(NORMAL_SHARE)


def repeated_words(codes: np.ndarray, window: int = REPEAT_WINDOW) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    n = len(codes) - window + 1
    if n < 2:
        return 0
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    total = np.zeros(n, np.uint64)
    for k in range(window):
        total = total * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : k + n]
        total ^= total >> np.uint64(31)
    _, inverse, counts = np.unique(total, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(codes) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(again), 1)
    np.add.at(covered, np.flatnonzero(again) + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def text_statistics(text: str) -> tuple[int, int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, repeated words, different words."""
    words = re.findall(WORD, text)
    ids: dict[str, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    seen: set[str] = set()
    dup_lines = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
        elif re.search(WORD, line):
            seen.add(line)
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), sum(map(len, words)), symbols, dup_lines, repeated_words(codes), len(ids)


def document_statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_distinct)``; a null text has none of anything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [(*text_statistics(t), t.count("\n") + 1) for t in texts]
            columns = zip(*found, strict=True) if found else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "lang", "source")]
                + [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "lang", "source", *names, "n_distinct", "n_lines"],
            )

    return docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), "text"
    ).mapInArrow(
        run,
        "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, n_distinct long, n_lines long",
    )


def transformed() -> list[Column]:
    """The five statistics, on scales where ordinary texts of one kind scatter evenly."""
    words = F.greatest(F.col("n_words"), F.lit(1))

    def share(part: str, whole: Column) -> Column:
        return F.log1p(F.col(part) / whole / SMALL_SHARE)

    columns = (
        F.col("word_chars") / words,
        share("n_symbols", F.greatest(F.col("word_chars"), F.lit(1))),
        share("n_dup_lines", F.col("n_lines")),
        share("n_repeat_words", words),
        F.log(F.col("n_distinct") + 1.0) / F.log(words + 1.0),
    )
    return [F.round(c, DIGITS).alias(s) for c, s in zip(columns, STATS, strict=True)]


def grouped(ws: Workspace, rows: DataFrame) -> DataFrame:
    """``rows`` with ``kind``: language and source, or what small groups are judged with."""
    fine, coarse = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang"))
    good = ~F.col("base_failed")
    counts = rows.where(good).groupBy("lang", "source").agg(F.count("*").alias("n"))
    counts = counts.withColumn("small", F.col("n") < GROUP_ROWS)
    by_lang = counts.where("small").groupBy("lang").agg(F.sum("n").alias("rest"))
    kind = (
        F.when(~F.col("small"), fine)
        .when(F.col("rest") >= GROUP_ROWS, coarse)
        .otherwise(F.lit("rest"))
    )
    kinds = ws.save(
        counts.alias("c")
        .join(by_lang.alias("b"), F.col("c.lang").eqNullSafe(F.col("b.lang")), "left")
        .select("c.lang", "c.source", "n", "small", "rest")
        .select(
            F.col("lang").alias("_lang"),
            F.col("source").alias("_source"),
            kind.alias("kind"),
        ),
        "kinds",
    )
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return rows.join(kinds, same, "left").drop("_lang", "_source")


def floored(scatter: np.ndarray) -> np.ndarray:
    """The scatter, raised to that of FLOORS in the directions where it is less."""
    unit = np.outer(FLOORS, FLOORS)
    values, vectors = np.linalg.eigh(scatter / unit)
    return (vectors * np.maximum(values, 1.0)) @ vectors.T * unit


def inverted(estimates: DataFrame) -> DataFrame:
    """``(kind, start, determinant, c0.., p00..)``: the logarithm of the determinant, centres
    and inverse scatter, from one row per kind and start."""
    names = [f"c{i}" for i in range(len(STATS))] + [f"p{i}{j}" for i, j in PAIRS]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for row in part.itertuples(index=False):
                scatter = np.zeros((len(STATS), len(STATS)))
                for i, j in PAIRS:
                    scatter[i, j] = scatter[j, i] = getattr(row, f"s{i}{j}") or 0.0
                scatter = floored(scatter)
                inverse = np.linalg.inv(scatter)
                determinant = round(float(np.linalg.slogdet(scatter)[1]), 9)
                centre = [getattr(row, f"c{i}") for i in range(len(STATS))]
                rows.append(
                    [row.kind, row.start, determinant, *centre, *(inverse[i, j] for i, j in PAIRS)]
                )
            yield pd.DataFrame(rows, columns=["kind", "start", "determinant", *names])

    schema = "kind string, start string, determinant double, "
    return estimates.mapInPandas(run, schema + ", ".join(f"{n} double" for n in names))


def order_statistic(values: DataFrame, share: float) -> DataFrame:
    """``(kind, name, value)`` of ``(kind, name, value)`` rows of long values: the least value
    that such a share of a group's rows does not exceed.

    Tasks count equal values before the shuffle. Statistics and distances are rounded, so a
    group has at most some 10 million different ones, however many rows it has.
    """
    least = F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY value)")
    return values.groupBy("kind", "name").agg(least.cast("long").alias("value"))


def _scaled(value: Column) -> Column:
    return F.round(value * 10**DIGITS).cast("long").alias("value")


def medians(ws: Workspace, points: DataFrame, of: list[Column], prefix: str) -> DataFrame:
    """``(kind, <prefix>0..)``: medians of a column for each statistic."""
    named = [F.struct(F.lit(s).alias("name"), _scaled(c)) for s, c in zip(STATS, of, strict=True)]
    found = order_statistic(points.select("kind", F.inline(F.array(*named))), 0.5)
    value = F.col("value") / 10.0**DIGITS
    columns = [
        F.max(F.when(F.col("name") == s, value)).alias(f"{prefix}{i}") for i, s in enumerate(STATS)
    ]
    return ws.save(found.groupBy("kind").agg(*columns), "medians")


def squared_distance() -> Column:
    """Squared Mahalanobis distance of a row from its kind's centre."""
    off = [F.col(s) - F.col(f"c{i}") for i, s in enumerate(STATS)]
    terms = [
        (1.0 if i == j else 2.0) * F.col(f"p{i}{j}") * off[i] * off[j] for i, j in PAIRS
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return F.least(F.round(total, DIGITS), F.lit(FAR))


def _moments(near: DataFrame, share: float) -> DataFrame:
    """Centre and scatter of the rows of each kind and start."""

    def scatter(i: int, j: int) -> Column:
        return consistency(share) * F.covar_pop(STATS[i], STATS[j])

    return near.groupBy("kind", "start").agg(
        *[F.round(F.avg(s), 6).alias(f"c{i}") for i, s in enumerate(STATS)],
        *[F.round(scatter(i, j), 9).alias(f"s{i}{j}") for i, j in PAIRS],
    )


def starts(ws: Workspace, points: DataFrame) -> DataFrame:
    """``(kind, start, c.., s..)``: the estimates that concentration begins with."""
    middle = medians(ws, points, [F.col(s) for s in STATS], "c")
    centred = points.join(middle, "kind")
    off = [F.col(s) - F.col(f"c{i}") for i, s in enumerate(STATS)]
    spread = medians(ws, centred, [F.abs(x) for x in off], "m")
    both = middle.join(spread, "kind")
    width = [F.greatest(1.4826 * F.col(f"m{i}"), F.lit(f)) for i, f in enumerate(FLOORS)]
    wide = both.select("kind", *[f"c{i}" for i in range(len(STATS))], *[w.alias(f"w{i}") for i, w in enumerate(width)])
    wide = ws.save(wide, "widths")
    centre = [f"c{i}" for i in range(len(STATS))]

    deviations = wide.select(
        "kind", F.lit("deviations").alias("start"), *centre,
        *[(F.pow(f"w{i}", F.lit(2)) if i == j else F.lit(0.0)).alias(f"s{i}{j}") for i, j in PAIRS],
    )
    # Every row counts by its direction from the medians alone, however far it lies.
    units = [(F.col(s) - F.col(f"c{i}")) / F.col(f"w{i}") for i, s in enumerate(STATS)]
    length = F.sqrt(sum((u * u for u in units[1:]), units[0] * units[0]))
    signs = points.join(wide, "kind").select(
        "kind", *[F.when(length > 0, u / length).otherwise(0.0).alias(f"u{i}") for i, u in enumerate(units)]
    )
    turned = signs.groupBy("kind").agg(
        *[F.avg(F.col(f"u{i}") * F.col(f"u{j}")).alias(f"r{i}{j}") for i, j in PAIRS]
    )
    directions = turned.join(wide, "kind").select(
        "kind", F.lit("signs").alias("start"), *centre,
        *[F.round(len(STATS) * F.col(f"r{i}{j}") * F.col(f"w{i}") * F.col(f"w{j}"), 9).alias(f"s{i}{j}") for i, j in PAIRS],
    )
    everything = _moments(points.withColumn("start", F.lit("all rows")), 1 - 1e-12)
    return deviations.unionByName(directions).unionByName(everything)


def estimate(ws: Workspace, points: DataFrame) -> DataFrame:
    """``(kind, c.., p..)``: each kind's estimate. ``points`` are ``(kind, *STATS)``, a
    written table."""
    model = ws.save(inverted(starts(ws, points)), "model")
    for _ in range(STEPS):
        far = points.join(model, "kind").withColumn("d", squared_distance())
        distances = far.select("kind", F.col("start").alias("name"), _scaled(F.col("d")))
        limits = order_statistic(distances, KEPT_SHARE).select(
            "kind", F.col("name").alias("start"), (F.col("value") / 10.0**DIGITS).alias("limit")
        )
        near = far.join(ws.save(limits, "limits"), ["kind", "start"]).where("d <= limit")
        model = ws.save(inverted(_moments(near, KEPT_SHARE)), "model")
    least = model.groupBy("kind").agg(F.min(F.struct("determinant", "start")).alias("least"))
    best = least.select("kind", F.col("least.start").alias("start"))
    model = ws.save(model.join(best, ["kind", "start"]), "least")
    far = points.join(model, "kind").withColumn("d", squared_distance())
    last = _moments(far.where(F.col("d") <= quantile(NEAR_SHARE)), NEAR_SHARE)
    return ws.save(inverted(last).drop("start", "determinant"), "model")


def quality_rules(ws: Workspace, docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, distance)`` of every document.

    Base rules fail a document with fewer than 20 words, or with more than 30 % of its words
    in repeated windows; the estimates leave those out. Others fail beyond the distance that
    NORMAL_SHARE of normal rows stay within. Null languages and sources are kinds
    like any other. Kinds with fewer than 200 rows are judged together; ``distance`` is null,
    and the base rules decide alone, where even those are too few. Extra columns are ignored.
    """
    stats = document_statistics(docs)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    rows = ws.save(stats.select("*", failed.alias("base_failed"), *transformed()), "statistics")
    rows = ws.save(grouped(ws, rows), "grouped")
    points = rows.where(~F.col("base_failed") & F.col("kind").isNotNull()).select("kind", *STATS)
    enough = points.groupBy("kind").agg(F.count("*").alias("n")).where(F.col("n") >= GROUP_ROWS)
    kinds = ws.save(enough.select("kind"), "enough")
    estimates = estimate(ws, points.join(kinds, "kind"))
    distance = F.when(~F.col("base_failed"), squared_distance())
    return (
        rows.join(estimates, "kind", "left")
        .withColumn("distance", distance)
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUT)).alias("kept"),
            "distance",
        )
    )
