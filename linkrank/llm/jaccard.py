"""Near duplicates: a Jaccard join on word shingles, filtered under several token orders.

Two sets that are similar enough share a token among the first few of each, whatever one
order both are sorted by, and several among the first few more. One order proposes pairs, two
others must agree before a pair's texts are compared: one of them asks for several tokens.
Two orders put rare tokens first, as a sketch of fixed size counts them; all break ties by a
hash of their own. Equal sets are one class; classes are joined.

A group of near copies is not expanded into all pairs: while many pairs are left, each shared
token proposes only its members' pairs with the most central one, and what links is one
component from then on. Then all pairs between different components that share a token are
tested. So components are exact, and every class's links inside one need no test.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkrank.llm.components import components
from linkrank.llm.text import packed, stretches, text_key, unpacked, whole_text
from linkrank.plans.workspace import Workspace

# Counters of the sketch that orders tokens: 8 MB, whatever the table.
SKETCH_BITS = 21
SKETCH_BLOCK = 1 << 14
# Words whose hashes a task keeps.
KNOWN_WORDS = 300_000
# Star rounds go on while all pairs that are left are more than this many per class.
PAIRS_PER_CLASS = 4
STAR_ROUNDS = 6
# Classes that may be broadcast to pick their texts (32 MB).
BROADCAST_ROWS = 1_000_000

_MASK = (1 << 64) - 1


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words; two sets link from ``percent`` of their union on."""

    words: int
    percent: int

    def prefix(self, n: np.ndarray | int):
        """How many tokens of a set of n must be looked at: n less the least overlap, plus 1."""
        return n - -(-self.percent * n // 100) + 1

    def longer(self, n: np.ndarray | int):
        """The prefix of the order that asks for several tokens: half the set."""
        return n // 2 + self.prefix(n)


class _Words(dict):
    """Hashes of words, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def split_words(text: bytes) -> list[bytes]:
    """Lower-cased words: bytes know no other letters and white space than ASCII ones."""
    return text.lower().split()


def shingles(words: list[bytes], n: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the runs of n words; of all words if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    take = min(n, len(words))
    count = len(words) - take + 1
    total = np.full(count, take, np.uint64)
    for k in range(take):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count]
        total ^= total >> np.uint64(32)
        total *= np.uint64(0xBF58476D1CE4E5B9)
    total ^= total >> np.uint64(29)
    return np.unique(total)


def _class_of(tokens: np.ndarray) -> tuple[int, bytes]:
    """A class number and 128 bits that tell sets apart."""
    digest = xxhash.xxh3_128_digest(tokens.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), digest


def document_sets(docs: DataFrame, rule: Similarity) -> DataFrame:
    """``(doc_id, key, n, node, digest)``, and the sketch's counts in rows of their own, with
    ``block`` and ``counts``; ``docs`` are ``(doc_id, key, body)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shift = _Words(), np.uint64(64 - SKETCH_BITS)
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["doc_id", "key", "n", "node", "digest", "block", "counts"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
        for part in (part for batch in batches for part in stretches(batch, "body")):
            sizes, nodes, digests, held = [], [], [], []
            for body in part.column("body").to_pylist():
                tokens = shingles(split_words(body), rule.words, known)
                node, digest = _class_of(tokens)
                sizes.append(len(tokens))
                nodes.append(node)
                digests.append(digest)
                held.append((tokens >> shift).astype(np.int32))
            np.add.at(sketch, np.concatenate(held), 1)
            none = pa.nulls(len(sizes))
            columns = [part.column("doc_id"), part.column("key"), sizes, nodes, digests, none, none]
            arrays = [pa.array(c, t) if isinstance(c, list) else c.cast(t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        blocks = [
            (i, np.minimum(part, 65535).astype("<u2").tobytes())
            for i, part in enumerate(sketch.reshape(-1, SKETCH_BLOCK))
            if part.any()
        ]
        if blocks:
            block, counts = zip(*blocks, strict=True)
            none = [pa.nulls(len(blocks)).cast(t) for t in types[:5]]
            last = [pa.array(block, pa.int32()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, *last], names=names)

    return docs.select("doc_id", "key", "body").mapInArrow(
        run, "doc_id long, key long, n long, node long, digest binary, block int, counts binary"
    )


def token_levels(partial: DataFrame, tokens: int) -> np.ndarray:
    """The sketch: 16 bits of each counter's count. Where an average count is large, its low
    bits are left out, well below what counts of equally rare tokens differ by."""
    mean = tokens >> SKETCH_BITS
    shift = max(0, mean.bit_length() - 12)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        block = None

        def level() -> pa.RecordBatch:
            levels = np.minimum(total >> shift, 65535).astype("<u2").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([levels], pa.binary())], names=["block", "levels"]
            )

        for batch in batches:
            for b, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b != block:
                    if total is not None:
                        yield level()
                    block, total = b, np.zeros(SKETCH_BLOCK, np.int64)
                total += np.frombuffer(counts, "<u2")
        if total is not None:
            yield level()

    found = (
        partial.repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(add, "block int, levels binary")
        .toArrow()
    )
    out = np.zeros(1 << SKETCH_BITS, np.uint16)
    for b, levels in zip(found["block"].to_pylist(), found["levels"].to_pylist(), strict=True):
        out[b * SKETCH_BLOCK : (b + 1) * SKETCH_BLOCK] = np.frombuffer(levels, "<u2")
    return out


def order_key(tokens: np.ndarray, levels: np.ndarray, order: int) -> np.ndarray:
    """Places of tokens in one order: by count, then by a hash; by coarse counts in order 1,
    by the hash alone in order 2."""
    mixed = tokens * np.uint64(0x9E3779B97F4A7C15 + 2 * order * 0x632BE59BD9B4E019 & _MASK)
    mixed ^= mixed >> np.uint64(31)
    if order == 2:
        return mixed
    level = levels[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    return level >> np.uint64(4 * order) << np.uint64(48) | mixed >> np.uint64(16)


def smallest(tokens: np.ndarray, key: np.ndarray, take: int) -> np.ndarray:
    """The first tokens by key, in no order."""
    return tokens[np.argpartition(key, take - 1)[:take]] if take < len(tokens) else tokens


def class_prefixes(docs: DataFrame, levels: np.ndarray, rule: Similarity) -> DataFrame:
    """``(node, tokens)``: each class's first tokens under the proposing order, in order. A
    task names a class once; classes of several tasks come several times."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, levels, seen = _Words(), shared.value, set()
        for texts in (part for batch in batches for part in stretches(batch, "body")):
            nodes, first = [], []
            for body in texts.column("body").to_pylist():
                tokens = shingles(split_words(body), rule.words, known)
                node, _ = _class_of(tokens)
                if not len(tokens) or node in seen:
                    continue
                if len(seen) < KNOWN_WORDS:
                    seen.add(node)
                key = order_key(tokens, levels, 0)
                part = smallest(np.arange(len(tokens)), key, rule.prefix(len(tokens)))
                nodes.append(node)
                first.append(tokens[part[np.argsort(key[part])]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(first, pa.list_(pa.int64()))],
                names=["node", "tokens"],
            )

    return docs.select("body").mapInArrow(run, "node long, tokens array<long>")


def other_orders(docs: DataFrame, levels: np.ndarray, rule: Similarity) -> DataFrame:
    """``(node, body, size, second, third)`` of ``(node, body)``: 32 bits of the first tokens
    under the second order, and 16 of a longer prefix under the third."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, levels = _Words(), shared.value
        for texts in (part for batch in batches for part in stretches(batch, "body")):
            sizes, second, third = [], [], []
            for body in texts.column("body").to_pylist():
                tokens = shingles(split_words(body), rule.words, known)
                n = len(tokens)
                sizes.append(n)
                part = smallest(tokens, order_key(tokens, levels, 1), rule.prefix(n))
                second.append(part.view(np.int64).astype(np.int32))
                part = smallest(tokens, order_key(tokens, levels, 2), rule.longer(n))
                third.append(part.view(np.int64).astype(np.int16))
            yield pa.RecordBatch.from_arrays(
                [texts.column("node"), texts.column("body"), pa.array(sizes, pa.int64())]
                + [pa.array(second, pa.list_(pa.int32())), pa.array(third, pa.list_(pa.int16()))],
                names=["node", "body", "size", "second", "third"],
            )

    return docs.select("node", "body").mapInArrow(
        run, "node long, body binary, size long, second array<int>, third array<short>"
    )


def least_overlap(rule: Similarity, one: Column, two: Column) -> Column:
    """How many tokens sets of these sizes have in common at least, if they link."""
    return F.ceil(rule.percent * (one + two) / (100 + rule.percent))


def orders_agree(rule: Similarity) -> Column:
    """Whether the prefixes of a pair, ``one`` and ``two``, allow it to link.

    With at least ``least`` tokens in common, prefixes of ``size - least + k`` tokens share k.
    Of tokens whose 16 bits are equal one is lost to the count, and is added again.
    """
    one, two = F.col("one"), F.col("two")
    least = least_overlap(rule, one["size"], two["size"])
    wanted = F.least(
        *[F.size(x["third"]) - x["size"] + least for x in (one, two)], one["size"], two["size"]
    )
    lost = F.size(one["third"]) - F.size(F.array_distinct(one["third"]))
    common = F.size(F.array_intersect(one["third"], two["third"])) + lost
    return F.arrays_overlap(one["second"], two["second"]) & (common >= wanted)


def _links(pairs: DataFrame, rule: Similarity) -> DataFrame:
    """``(a, b)`` of ``(a, b, text_a, text_b)`` whose shingles, the words themselves, agree."""

    def shingle_set(text: bytes) -> set[tuple[bytes, ...]]:
        words = split_words(text)
        take = min(rule.words, len(words))
        return set(zip(*(words[k:] for k in range(take)), strict=False)) if words else set()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, set()
        for part in (p for batch in batches for p in stretches(batch, "text_a", "text_b")):
            keep = []
            columns = (part.column(c).to_pylist() for c in ("a", "text_a", "text_b"))
            for a, text_a, text_b in zip(*columns, strict=True):
                if a != last or last is None:
                    last, left = a, shingle_set(text_a)
                right = shingle_set(text_b)
                both = len(left & right)
                keep.append(100 * both >= rule.percent * (len(left) + len(right) - both))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


@dataclass
class _Join:
    """The tables of one join: ``docs(place, body)``; ``shared(token, node, left, size, rank)``
    where ``left`` counts the class's tokens from this one on; the sketch; by class the place
    of one of its rows: 64 bits of id and key."""

    ws: Workspace
    rule: Similarity
    docs: DataFrame
    shared: DataFrame
    levels: np.ndarray
    places: DataFrame

    def labelled(self, labels: DataFrame | None) -> DataFrame:
        """Shared tokens with each class's component, without those inside one component."""
        rows = self.shared
        if labels is None:
            return rows.withColumn("component", F.col("node"))
        found = labels.select("node", F.col("component").alias("found"))
        rows = rows.join(found, "node", "left").select(
            "*", F.coalesce("found", "node").alias("component")
        ).drop("found")
        rows = self.ws.save(rows, "labelled")
        split = rows.groupBy("token").agg(
            F.min("component").alias("c0"), F.max("component").alias("c1")
        ).where("c0 != c1").select("token")
        return self.ws.save(rows.join(self.ws.save(split, "split"), "token"), "labelled")

    def possible(self) -> Column:
        """Whether a shared token can be the first that a pair shares: so many tokens as the
        pair must have in common are left from its place on, in either class."""
        least = least_overlap(self.rule, F.col("size"), F.col("size2"))
        return (F.col("left") >= least) & (F.col("left2") >= least)

    def stars(self, rows: DataFrame) -> DataFrame:
        """Pairs of each class with the most central one of a token, components apart."""
        central = [
            F.min_by(c, "rank").alias(f"{c}2") for c in ("node", "component", "size", "left")
        ]
        centre = self.ws.save(rows.groupBy("token").agg(*central), "centres")
        near = rows.join(centre, "token").where(F.col("component") != F.col("component2"))
        return near.where(self.possible()).select(
            F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")
        )

    def all_pairs(self, rows: DataFrame) -> DataFrame:
        names = ("node", "component", "size", "left")
        other = rows.select("token", *[F.col(c).alias(f"{c}2") for c in names])
        apart = (F.col("node") < F.col("node2")) & (F.col("component") != F.col("component2"))
        return rows.join(other, "token").where(apart & self.possible()).select(
            F.col("node").alias("a"), F.col("node2").alias("b")
        )

    def texts(self, pairs: DataFrame) -> DataFrame:
        """``(node, body, size, second, third)``: one text of each class in the pairs, and its
        first tokens. Rows, not texts, are chosen: only where such a row repeats are texts
        moved to leave one."""
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        chosen = self.ws.save(self.places.join(nodes, "node"), "chosen")
        classes = chosen.count()
        if classes <= BROADCAST_ROWS:
            chosen = F.broadcast(chosen)
        found = self.docs.join(chosen, "place").select("node", "body")
        texts = self.ws.save(other_orders(found, self.levels, self.rule), "texts")
        if texts.count() == classes:
            return texts
        return self.ws.save(texts.dropDuplicates(["node"]), "texts")

    def test(self, pairs: DataFrame, tested: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """New links among the pairs, and all pairs tested so far."""
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = self.ws.save(pairs, "pairs")
        texts = self.texts(pairs)
        sides = F.struct("size", "second", "third")
        one = texts.select(F.col("node").alias("a"), sides.alias("one"))
        two = texts.select(F.col("node").alias("b"), sides.alias("two"))
        near = pairs.join(one, "a").join(two, "b").where(orders_agree(self.rule))
        near = self.ws.save(near.select("a", "b"), "candidates")
        left = texts.select(F.col("node").alias("a"), F.col("body").alias("text_a"))
        right = texts.select(F.col("node").alias("b"), F.col("body").alias("text_b"))
        links = self.ws.save(_links(near.join(right, "b").join(left, "a"), self.rule), "links")
        return links, pairs if tested is None else tested.union(pairs)


def near_duplicates(ws: Workspace, docs: DataFrame, rule: Similarity) -> DataFrame:
    """``(doc_id, key, n_shingles, node, component_id, first_key)`` of every row of ``docs``.

    Rows link if their shingle sets' intersection is at least ``percent`` of their union.
    ``component_id`` is the smallest id reachable by links, nulls left out (null where all
    are null), ``first_key`` the smallest text key among the component's rows of that id. A text without
    words, or null, is linked with nothing and stays alone. Repeated rows are links of each
    other. Classes are 64-bit numbers: at 10^10 different sets about three of them would
    share one by chance.
    """
    body = F.encode(whole_text(), "UTF-8")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), body.alias("body"))
    both = ws.save(document_sets(keyed, rule), "sets")
    sets = both.where("node IS NOT NULL").select("doc_id", "key", "n", "node")
    total = sets.agg(F.sum("n")).first()[0] or 0
    levels = token_levels(both.where("block IS NOT NULL").select("block", "counts"), total)
    first = ws.save(class_prefixes(keyed, levels, rule), "prefixes")
    tokens = first.select("node", F.posexplode("tokens").alias("place", "token"))
    repeated = ws.save(
        tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token"), "tokens"
    )
    shared = tokens.join(repeated, "token").groupBy("token", "node").agg(F.min("place").alias("place"))
    shared = ws.save(shared, "shared")
    # Tokens of one class only, named by several tasks, propose nothing.
    several = shared.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    shared = ws.save(shared.join(ws.save(several.select("token"), "several"), "token"), "shared")
    # The fewer tokens of its own a class has, the more central it is.
    own = ws.save(shared.groupBy("node").agg(F.count("*").alias("n_shared")), "own")
    place = F.xxhash64("doc_id", "key").alias("place")
    sizes = sets.groupBy("node").agg(F.min("n").alias("size"), F.min(place).alias("place"))
    prefix = F.col("size") - F.ceil(F.col("size") * rule.percent / 100) + 1
    alone = F.least(F.floor(1000 * (1 - F.col("n_shared") / prefix)), F.lit(1000))
    rank = F.greatest(alone, F.lit(0)).cast("long") * (1 << 50) + F.shiftrightunsigned("node", 14)
    ranked = ws.save(
        own.join(sizes, "node").select("node", "size", "place", rank.alias("rank")), "ranked"
    )
    left = (F.col("size") - F.col("place")).alias("left")
    shared = shared.join(ranked.drop("place"), "node").select("token", "node", left, "size", "rank")
    shared = ws.save(shared, "shared")
    docs = keyed.select(place, "body")
    join = _Join(ws, rule, docs, shared, levels, ranked.select("node", "place"))
    links = labels = tested = None
    rows = join.labelled(None)
    classes = ranked.count()
    for _ in range(STAR_ROUNDS):
        n = rows.groupBy("token").agg(F.count("*").alias("n")).agg(F.sum(F.expr("n * (n - 1) / 2"))).first()[0]
        if (n or 0) <= PAIRS_PER_CLASS * classes:
            break
        new, tested = join.test(join.stars(rows), tested)
        if new.isEmpty():  # the same centres again
            break
        links = new if links is None else links.union(new)
        labels = components(ws, links)
        rows = join.labelled(labels)
    new, _ = join.test(join.all_pairs(rows), tested)
    links = new if links is None else links.union(new)
    labels = components(ws, links)
    classed = sets.join(labels.select("node", "component"), "node", "left").select(
        "doc_id", "key", "n", "node", F.coalesce("component", "node").alias("component")
    )
    classed = ws.save(classed, "classed")
    first_of = classed.where("n > 0").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    )
    first_of = ws.save(first_of, "firsts")
    linked = F.col("n") > 0
    return classed.join(first_of, "component", "left").select(
        "doc_id",
        "key",
        F.col("n").alias("n_shingles"),
        "node",
        F.when(linked, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linked, F.col("first.key")).otherwise(F.col("key")).alias("first_key"),
    )


def keep_firsts(ws: Workspace, docs: DataFrame, rule: Similarity) -> DataFrame:
    """All columns of ``docs``, one row of each component: the smallest id, then text key.
    Rows without words all stay; of repeated rows one stays."""
    classes = near_duplicates(ws, docs.select("doc_id", "text"), rule)
    stay = F.col("doc_id").eqNullSafe(F.col("component_id")) & (
        F.col("key") == F.col("first_key")
    )
    place = F.xxhash64("doc_id", "key")
    kept = classes.where(stay).select(
        place.alias("__place"),
        F.col("doc_id").alias("__id"),
        F.col("key").alias("__key"),
        (F.col("n_shingles") > 0).alias("__words"),
    )
    kept = ws.save(kept.distinct(), "kept")
    own_id = F.col("doc_id").cast("long")
    names = ("doc_id", "text")
    here = packed(docs, *names).withColumn("__here", F.xxhash64(own_id, text_key()))
    same = (
        (F.col("__here") == F.col("__place"))
        & own_id.eqNullSafe(F.col("__id"))
        & (text_key() == F.col("__key"))
    )
    # Repeated rows lie side by side after the join; each but the first of a place goes.
    order = Window.partitionBy("__here").orderBy("__id", "__key")
    nth = F.row_number().over(order)
    before = F.lag(F.struct("__id", "__key")).over(order)
    again = (nth > 1) & before.eqNullSafe(F.struct("__id", "__key"))
    first = (
        here.join(kept, same)
        .withColumn("__again", again)
        .where(~F.col("__again") | ~F.col("__words"))
    )
    return unpacked(first, docs.columns, names)
