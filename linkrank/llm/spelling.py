"""Spelling variants: pairs of words one edit apart, by composition of finite-state machines.

The vocabulary is an acceptor, and a pair of near words is a path of acceptor, one-edit
transducer, acceptor. Words are partitioned by the state their first letters lead to from the
initial one. Inside a partition the acceptor is minimised and composed: up to the edit both
sides run through the same states, after it through a pair of states, and what such a pair
accepts is worked out once, however many words lead there.

An edit at the first letters leaves the partition: there the transducer has spent its edit,
so that both words go on alike, and they meet by an equal rest. The same rule splits a
partition that is too large: it is divided by further letters.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.plans.workspace import Workspace

# Fixed values of the task: letters, every how many runs lose a code point.
RUN = r"[A-Za-z\x{C0}-\x{FF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 199

MIN_LETTERS = 6
MIN_COUNT = 5
# How many times more frequent the form of a word has to be.
DOMINANCE = 5
# Letters that lead to a partition, and to the parts of one that is too large.
LETTERS = 3
# Words whose acceptor one task composes.
PARTITION_WORDS = 8_192


def vocabulary(
    docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT
) -> DataFrame:
    """``(word, n)``: words of whole texts, by a checksum of ``doc_id:run`` misspelt.

    Null texts have no words; a null ``doc_id`` is written as nothing.
    """
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))
    long_runs = F.filter(runs, lambda r: F.length(r) >= min_letters)
    words = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.transform(long_runs, lambda r: F.translate(r, UPPER, LOWER))).alias("run"),
    )
    mark = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("mark") % F.length("run")).cast("int")
    rest = F.substr("run", at + 2)
    slipped = F.concat(F.left("run", at), rest)
    word = F.when(F.col("mark") % SLIP == 0, slipped).otherwise(F.col("run"))
    return (
        words.withColumn("mark", mark)
        .select(word.alias("word"))
        .where(F.length("word") >= min_letters)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


class Acceptor:
    """The minimal acyclic acceptor of sorted, distinct strings.

    States are numbered so that arcs lead to smaller ones; equal states are one.
    """

    def __init__(self, strings: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        self._common: dict[tuple[int, int], list[str]] = {}
        path: list[tuple[list[bool], dict[str, int]]] = [([False], {})]
        last = ""
        for string in strings:
            shared = 0
            while shared < min(len(last), len(string)) and last[shared] == string[shared]:
                shared += 1
            self._close(path, last, shared)
            path += [([False], {}) for _ in range(len(string) - shared)]
            path[-1][0][0] = True
            last = string
        self._close(path, last, 0)
        self.initial = self._state(*path[0])

    def _close(self, path: list, string: str, length: int) -> None:
        while len(path) - 1 > length:
            state = self._state(*path.pop())
            path[-1][1][string[len(path) - 1]] = state

    def _state(self, final: list[bool], arcs: dict[str, int]) -> int:
        key = (final[0], *arcs.items())
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final[0])
        return self._known[key]

    def common(self, a: int, b: int) -> list[str]:
        """Strings that both states accept, worked out once for a pair of states."""
        known = self._common
        todo = [(a, b)]
        while todo:
            pair = todo[-1]
            if pair in known:
                todo.pop()
                continue
            s, t = pair
            x, y = self.arcs[s], self.arcs[t]
            steps = [(c, (x[c], y[c])) for c in (x if len(x) <= len(y) else y) if c in x and c in y]
            missing = [p for _, p in steps if p not in known]
            if missing:
                todo += missing
                continue
            found = [c + rest for c, p in steps for rest in known[p]]
            known[pair] = [""] + found if self.final[s] and self.final[t] else found
            todo.pop()
        return known[a, b]

    def edits(self, state: int) -> list[tuple[str, str]]:
        """Pairs of strings of a state that differ by one edit, at their first letters."""
        arcs = list(self.arcs[state].items())
        pairs = []
        for i, (c, after) in enumerate(arcs):
            for d, other in arcs[:i]:
                pairs += [(c + rest, d + rest) for rest in self.common(after, other)]
            # c inserted: without it the string goes on from here, and not with c itself.
            pairs += [(c + rest, rest) for rest in self.common(after, state) if rest[:1] != c]
        return pairs


def compose(counts: dict[str, int]) -> dict[str, tuple[int, tuple[int, str]]]:
    """Of each word with near words: how many, and the first by ``(-n, word)``."""
    acceptor = Acceptor(sorted(counts))
    edits: dict[int, list[tuple[str, str]]] = {}
    near: dict[str, int] = defaultdict(int)
    best: dict[str, tuple[int, str]] = {}
    todo = [(acceptor.initial, "")]
    while todo:
        state, begun = todo.pop()
        if state not in edits:
            edits[state] = acceptor.edits(state)
        for a, b in edits[state]:
            a, b = begun + a, begun + b
            for word, other in ((a, b), (b, a)):
                near[word] += 1
                this = (-counts[other], other)
                if word not in best or this < best[word]:
                    best[word] = this
        todo += [(after, begun + c) for c, after in acceptor.arcs[state].items()]
    return {word: (n, best[word]) for word, n in near.items()}


FOUND = "word string, n_near long, best struct<less: long, near: string>"


def _compose_partition(table: pa.Table) -> pa.Table:
    words = table.column("word").to_pylist()
    found = compose(dict(zip(words, table.column("n").to_pylist(), strict=True)))
    return pa.table(
        {
            "word": pa.array(found.keys(), pa.string()),
            "n_near": pa.array([n for n, _ in found.values()], pa.int64()),
            "best": pa.array(
                [{"less": less, "near": near} for _, (less, near) in found.values()],
                pa.struct([("less", pa.int64()), ("near", pa.string())]),
            ),
        }
    )


def _crossing(words: DataFrame, begin: int, end: int) -> DataFrame:
    """Near words that agree before letter ``begin`` and first differ before letter ``end``.

    Cut at the letter where they first differ, they go on alike, or one is what the other is
    without that letter. At most one word for each letter meets under a key.
    """
    word, letters = F.col("word"), F.length("word")
    shapes: list[Column] = []
    for at in range(begin, end):
        head, letter = F.left(word, F.lit(at)), F.substr(word, F.lit(at + 1), F.lit(1))
        cut = F.struct(F.lit(at).alias("at"), head.alias("head"), F.substr(word, F.lit(at + 2)).alias("rest"), letter.alias("letter"))
        whole = F.struct(F.lit(at).alias("at"), head.alias("head"), F.substr(word, F.lit(at + 1)).alias("rest"), F.lit(None).cast("string").alias("letter"))
        shapes += [F.when(letters > at, cut), F.when(letters >= at, whole)]
    shaped = words.select("word", "n", F.explode(F.array(*shapes)).alias("shape")).where("shape IS NOT NULL")
    one = F.struct(F.col("shape.letter").alias("letter"), (-F.col("n")).alias("less"), F.col("word").alias("near"))
    keys = ("shape.at", "shape.head", "shape.rest")
    met = shaped.groupBy(*keys).agg(F.collect_list(one).alias("met")).where(F.size("met") > 1)
    each = met.select("met", F.substr("rest", F.lit(1), F.lit(1)).alias("next"), F.explode("met").alias("this"))

    def near(other: Column) -> Column:
        this = F.col("this")
        # The one with a letter more must not go on with that letter: then they differ later.
        letter = F.coalesce(this["letter"], other["letter"])
        both = this["letter"].isNotNull() & other["letter"].isNotNull()
        return (this["near"] != other["near"]) & (both | (letter != F.col("next")))

    found = each.select(F.col("this.near").alias("word"), F.filter("met", near).alias("found"))
    least = F.array_min(F.transform("found", lambda o: F.struct(o["less"].alias("less"), o["near"].alias("near"))))
    return found.where(F.size("found") > 0).select(
        "word", F.size("found").cast("long").alias("n_near"), least.alias("best")
    )


def near_words(
    ws: Workspace, words: DataFrame, letters: int = LETTERS, most: int = PARTITION_WORDS
) -> DataFrame:
    """``(word, n_near, best(less, near))`` of the words of ``words(word, n)`` that are one
    inserted, deleted or replaced code point from others; ``best`` is the most frequent of
    these, the first in code point order of equals, with ``less`` its negative count.

    Pass a written table of distinct words.
    """
    found, begin, left = [], 0, words
    while True:
        end = begin + letters
        found.append(ws.save(_crossing(left, begin, end), "crossing"))
        led = left.withColumn("led", F.left("word", F.lit(end)))
        large = ws.save(
            led.groupBy("led").agg(F.count("*").alias("size")).where(F.col("size") > most).select("led"),
            "large",
        )
        small = led.join(large, "led", "left_anti")
        composed = small.groupBy("led").applyInArrow(_compose_partition, FOUND)
        found.append(ws.save(composed, "composed"))
        if large.isEmpty():
            break
        left = ws.save(led.join(large, "led", "left_semi").drop("led"), "left")
        begin = end
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(ws: Workspace, forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: where following forms ends.

    Each round doubles the steps taken. A form is several times as frequent as its word, so
    the steps are few.
    """
    state = ws.save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("at"), F.col("root").alias("further"))
        state = ws.save(
            state.join(further, state.root == further["at"], "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("at").alias("passed")
            ),
            "roots",
        )
        if state.where("passed IS NOT NULL").isEmpty():
            return state.select("word", "root")
        state = state.drop("passed")


def group_variants(ws: Workspace, words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of ``words(word, n)``.

    ``form`` is the most frequent near word if it is ``dominance`` times as frequent, else
    null; ``root`` follows forms to the last, and is the word itself without a form. An
    empty table gives no rows.
    """
    words = ws.save(words.select("word", "n"), "words")
    near = near_words(ws, words)
    best_n = -F.col("best.less")
    formed = best_n >= F.col("n") * dominance
    table = ws.save(
        words.join(near, "word", "left").select(
            "word",
            F.when(formed, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(formed, best_n).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(ws, table.where("form IS NOT NULL").select("word", "form"))
    return table.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
