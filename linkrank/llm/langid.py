"""Language identification by cross-parsing.

For every language a suffix automaton holds all substrings of a bounded sample of labelled
text. A text is cut, from the left, into the longest phrases that each automaton knows; the
language that needs the fewest phrases, times the bits a phrase costs, wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from linkrank.llm.text import stretches

# The sample of one language: so many labelled rows, a window of so many characters of each. An automaton
# has fewer than twice as many states as characters.
SAMPLE_ROWS = 64
ROW_CHARS = 500
# Characters of all samples together; more languages get shorter samples.
ALL_CHARS = 1_000_000
# Languages whose counts may be broadcast; with more, the counts are joined by a shuffle.
BROADCAST_LANGUAGES = 10_000
# Cells of one automaton's table of transitions; one that needs more is kept as a sorted list.
TABLE_CELLS = 1 << 22
# Texts are parsed in blocks of so many characters, all blocks of a stretch side by side.
BLOCK = 512
UNKNOWN = "und"

# Classes of characters: a letter of none of the samples; anything between letters.
OTHER, GAP = 0, 1


class Automaton:
    """Transitions from state and class; 0 is no state, 1 the empty string. ``local`` numbers
    the classes that occur in the automaton, from 1."""

    def __init__(self, moves: list[dict[int, int]], width: int) -> None:
        used = sorted({c for out in moves for c in out})
        self.local = np.zeros(width, np.int64)
        self.local[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        kind = np.min_scalar_type(len(moves))
        triples = [(s, c, t) for s, out in enumerate(moves) if s for c, t in out.items()]
        state, label, target = np.array(triples, np.int64).reshape(-1, 3).T
        keys = state * self.width + self.local[label]
        self.begin = np.ones(self.width, kind)
        first = state == 1
        self.begin[self.local[label[first]]] = target[first]
        self.table = self.keys = None
        if len(moves) * self.width <= TABLE_CELLS:
            self.table = np.zeros(len(moves) * self.width, kind)
            self.table[keys] = target
        else:
            order = np.argsort(keys)
            self.keys, self.targets = keys[order], target[order].astype(kind)

    def step(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The states that follow, by local classes; 0 where there is none."""
        wanted = states.astype(np.int64) * self.width + labels
        if self.keys is None:
            return self.table[wanted]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.targets[at], 0)


def suffix_automaton(classes: list[int], width: int) -> Automaton:
    """All substrings of a sequence of classes below ``width``. The usual online construction."""
    moves: list[dict[int, int]] = [{}, {}]
    links, lengths = [0, 0], [0, 0]
    last = 1
    for c in classes:
        new = len(moves)
        moves.append({})
        lengths.append(lengths[last] + 1)
        links.append(1)
        at = last
        while at and c not in moves[at]:
            moves[at][c] = new
            at = links[at]
        if at:
            target = moves[at][c]
            if lengths[at] + 1 == lengths[target]:
                links[new] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                lengths.append(lengths[at] + 1)
                links.append(links[target])
                while at and moves[at].get(c) == target:
                    moves[at][c] = copy
                    at = links[at]
                links[target] = links[new] = copy
        last = new
    return Automaton(moves, width)


@dataclass
class Model:
    """``classes`` maps a code point to its class; one automaton for each language."""

    languages: list[str]
    classes: np.ndarray
    automata: list[Automaton]
    bits: list[float]

    @property
    def width(self) -> int:
        return int(self.classes.max(initial=GAP)) + 1

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all characters, runs of gaps as one, and each text's number of them."""
        lowered = [t.lower() for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
        codes = self.classes[points]
        lengths = np.array([len(t) for t in lowered], np.int64)
        owner = np.repeat(np.arange(len(texts)), lengths)
        gap = codes == GAP
        again = np.zeros(len(codes), bool)
        again[1:] = gap[1:] & gap[:-1] & (owner[1:] == owner[:-1])
        return codes[~again], np.bincount(owner[~again], minlength=len(texts))

    def phrases(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases ``[language, text]`` that each automaton needs. A character that it does not
        know belongs to the phrase that follows it."""
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(lengths)), blocks)
        first = np.repeat(np.cumsum(lengths) - lengths, blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        size = np.minimum(lengths[owner] - nth * BLOCK, BLOCK)
        order = np.argsort(-size, kind="stable")
        start, size, owner = (first + nth * BLOCK)[order], size[order], owner[order]
        out = np.zeros((len(self.languages), len(lengths)), np.int64)
        if not len(owner):
            return out
        # How many blocks have a character at each place: those come first.
        alive = np.searchsorted(-size, -np.arange(size[0]), side="left")
        places = [start[:n] + at for at, n in enumerate(alive)]
        for k, automaton in enumerate(self.automata):
            labels, begin = automaton.local[codes], automaton.begin
            # The first character of a block begins a phrase, and each that extends none.
            state = begin[labels[places[0]]]
            count = np.ones(len(owner), np.int64)
            for n, place in zip(alive[1:], places[1:], strict=True):
                c = labels[place]
                step = automaton.step(state[:n], c)
                stuck = step == 0
                count[:n] += stuck
                state[:n] = np.where(stuck, begin[c], step)
            np.add.at(out[k], owner, count)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Languages and scores: by how large a share the winner needs fewer bits than the
        next one. A text without letters, or without any language learned, is ``und``."""
        codes, lengths = self.encode([t or "" for t in texts])
        ends = np.cumsum(lengths)
        letters = np.r_[0, np.cumsum(codes != GAP)]
        lettered = letters[ends] - letters[ends - lengths] > 0
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        cost = self.phrases(codes, lengths) * np.array(self.bits)[:, None]
        best = cost.argmin(axis=0)
        ranked = np.sort(cost, axis=0)
        score = 1 - ranked[0] / np.maximum(ranked[min(1, len(ranked) - 1)], 1e-9)
        if len(ranked) == 1:
            score[:] = 1.0
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, score, 0.0).tolist()


def fit(samples: dict[str, list[str]]) -> Model:
    """The model of sampled texts by language."""
    lowered = {k: [t.lower() for t in v] for k, v in sorted(samples.items())}
    found: set[str] = set()
    for parts in lowered.values():
        for part in parts:
            found.update(filter(str.isalpha, part))
    classes = np.fromiter(
        (OTHER if chr(i).isalpha() else GAP for i in range(0x110000)), np.uint32, 0x110000
    )
    for number, ch in enumerate(sorted(found), GAP + 1):
        classes[ord(ch)] = number
    model = Model(sorted(lowered), classes, [], [])
    for name in model.languages:
        codes, _ = model.encode([" ".join(lowered[name])])
        model.automata.append(suffix_automaton(codes.tolist(), model.width))
        model.bits.append(math.log2(len(codes) + 2))
    return model


def remainder(doc_id: str = "doc_id"):
    """What decides whether a document is held out; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % 5


def learnable(docs: DataFrame) -> DataFrame:
    """Labelled rows that are not held out and hold a letter: only they are learned from, and
    only their languages count."""
    return docs.where(
        F.col("lang").isNotNull() & (remainder() != 0) & F.col("text").rlike(r"\p{L}")
    )


def sample_rows(docs: DataFrame, rows: int = SAMPLE_ROWS, languages: int | None = None) -> DataFrame:
    """``(lang, place, part)``: a bounded sample of each language's labelled rows that are not
    held out, chosen by a hash of the row. A first cut by that hash leaves a few times as many
    rows as are needed, so that no language has to be sorted. Where there are at most
    ``BROADCAST_LANGUAGES``, the cut comes before the shuffle, so that no task gets all rows
    of a language; ``languages`` is their number if it is known."""
    labelled = learnable(docs)
    known = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    if languages is not None and languages <= BROADCAST_LANGUAGES:
        known = F.broadcast(known)
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)).cast("double") / float(1 << 40)
    # A window of the text at a place that its hash draws, so that no head is preferred.
    spare = F.greatest(F.length("text") - ROW_CHARS, F.lit(0))
    begin = F.pmod(F.xxhash64("text", F.lit("window")), spare + 1).cast("int") + 1
    part = F.substr("text", begin, F.lit(ROW_CHARS))
    near = (
        labelled.select("lang", draw.alias("draw"), part.alias("part"))
        .join(known, "lang")
        .where(F.col("draw") * F.col("n") < 4 * rows + 40)
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "part"))
    return near.withColumn("place", place).where(F.col("place") <= rows).select("lang", "place", "part")


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Collects the sample, at most ALL_CHARS characters, and builds the automata."""
    languages = max(1, learnable(docs).select("lang").distinct().count())
    rows = max(1, min(rows, ALL_CHARS // (ROW_CHARS * languages)))
    samples: dict[str, list[str]] = {}
    for row in sample_rows(docs, rows, languages).orderBy("lang", "place").collect():
        samples.setdefault(row.lang, []).append(row.part)
    return fit(samples)


def identify(
    docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """All columns of ``docs`` and two new ones, by default ``lang_pred`` and ``score``; only
    ``text`` is looked at.

    Null texts, and texts without a letter, are ``und`` with score 0. Columns that have the
    new names are replaced.
    """
    docs = docs.drop(lang, score)
    # By value, as the functions travel: workers need not have this package.
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = cloudpickle.loads(shared.value)
        for batch in batches:
            for part in stretches(batch, "text"):
                names, scores = model.predict(part.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[*part.schema.names, lang, score],
                )

    added = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def detect_languages(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, learned from the rows that are not held out.

    A row without id is neither held out nor learned from. With nothing to learn from, every
    text is ``und``. Extra columns are ignored.
    """
    model = learn(docs)
    out = identify(docs.select("doc_id", "text"), model)
    held = F.coalesce(remainder() == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
