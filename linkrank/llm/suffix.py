"""Removal of repeated byte strings by prefix-free parsing.

Triggers of a rolling hash cut texts into phrases. A trigger is the smallest hash of any
stretch of 200 bytes, so the bytes alone decide where it lies, and every such stretch holds
one. A phrase is all the stretches that share a trigger; neighbouring phrases overlap, so
each stretch lies wholly inside one phrase, and equal stretches lie in phrases of the same
trigger at the same distance from it. The dictionary holds each different phrase once, with
its count; the parse of a text is its list of phrases.

A phrase that occurs twice is repeated throughout. A phrase that occurs once, but whose
trigger occurs again, is compared with the dictionary's other phrases of that trigger: the
suffix array of the dictionary, sorted to a depth of 200 bytes, brings equal stretches
together whatever phrase they belong to. All repeated stretches of a phrase hold its trigger,
so they cover one run of bytes, and its first and last repeated stretch are all that the
parse needs to know.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.text import text_key, whole_text
from linkrank.plans.workspace import Workspace

LENGTH = 200
# Bytes of a trigger: a power of two.
TRIGGER = 64
# Bytes of dictionary that one suffix array covers: its positions are 20-bit numbers.
ARRAY_BYTES = 1 << 20
# Triggers with more different phrases than one suffix array holds are compared by
# fingerprints of stretches: those add up before they are shuffled, so no task has to hold
# such a trigger's phrases.
HOT_PHRASES = ARRAY_BYTES // (2 * LENGTH) - 1
# Bits of the filter that tells which texts hold a repeated trigger: 8 MB, and how many of
# them a trigger sets. A full filter only lets texts through that hold none.
FILTER_BITS = 26
FILTER_HASHES = 4
# Bytes of a text that are parsed at a time.
PIECE = 4_000_000

_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every stretch of so many bytes: sums of shorter ones, scaled."""
    single = data.astype(np.uint64) + np.uint64(1)
    total, covered, power = None, 0, 1
    part, size, scale = single, 1, _MULTIPLIER
    while True:
        if length & size:
            if total is None:
                total, covered, power = part, size, scale
            else:
                n = len(data) - covered - size + 1
                total = total[:n] * np.uint64(scale) + part[covered : covered + n]
                covered, power = covered + size, power * scale & _MASK
        if size * 2 > length:
            break
        part = part[:-size] * np.uint64(scale) + part[size:]
        size, scale = size * 2, scale * scale & _MASK
    total = total ^ (total >> np.uint64(29))
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def phrases(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(trigger hashes, first stretches, numbers of stretches)`` of a text's phrases.

    A long text is parsed in pieces that overlap by one stretch less a byte, so every stretch
    is in one piece; a phrase that a piece's end divides counts as two, in each of which the
    comparison finds its share.
    """
    starts = range(0, max(len(text) - length, 0) + 1, PIECE)
    found = []
    for at in starts:
        grams, first, count = _piece_phrases(text[at : at + PIECE + length - 1], length)
        found.append((grams, first + at, count))
    return found[0] if len(found) == 1 else tuple(map(np.concatenate, zip(*found, strict=True)))


def _piece_phrases(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    empty = np.zeros(0, np.int64)
    if len(text) < length:
        return empty.view(np.uint64), empty, empty
    trigger = min(TRIGGER, length)
    hashes = rolling(np.frombuffer(text, np.uint8), trigger)
    low = np.uint64((1 << 24) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width, done = length - trigger + 1, 1
    least = keys
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if rest := width - done:
        least = np.minimum(least[:-rest], least[rest:])
    at = (least & low).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return hashes[at[first]], first, np.diff(np.r_[first, len(at)])


def phrase_hash(text: bytes, first: int, count: int, length: int) -> int:
    """Fingerprint of a phrase; with its trigger's hash it makes 128 bits."""
    return xxhash.xxh3_64_intdigest(text[first : first + count + length - 1])


def equal_stretches(contents: list[bytes], length: int) -> np.ndarray:
    """A number for every stretch of the contents, equal for equal stretches.

    This is a suffix array by prefix doubling, cut off at the stretches' length: ranks of
    short strings are sorted by pairs into ranks of strings twice as long.
    """
    data = np.frombuffer(b"".join(contents) + bytes(length), np.uint8)
    n = len(data)
    assert n <= 1 << 20, "positions and ranks are 20-bit numbers"
    place = np.arange(n, dtype=np.uint64)

    def ranked(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        m = min(len(first), len(second))
        order = np.sort(first[:m] << np.uint64(40) | second[:m] << np.uint64(20) | place[:m])
        pairs = order >> np.uint64(20)
        new = np.r_[False, pairs[1:] != pairs[:-1]]
        rank = np.empty(m, np.uint64)
        rank[(order & np.uint64((1 << 20) - 1)).astype(np.int64)] = np.cumsum(new)
        return rank

    rank, size = data.astype(np.uint64), 1
    while size * 2 <= length:
        rank = ranked(rank, rank[size:])
        size *= 2
    if size < length:
        rank = ranked(rank, rank[length - size :])
    return rank.astype(np.int64)


def compare(contents: list[bytes], counts: list[int], length: int) -> tuple[list[int], list[int]]:
    """First and last stretch of each phrase that occurs elsewhere; -1 where none does."""
    ranks = equal_stretches(contents, length)
    sizes = np.array([len(c) - length + 1 for c in contents])
    starts = np.cumsum([0, *map(len, contents)])[:-1]
    owner = np.repeat(np.arange(len(contents)), sizes)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    stretch = ranks[starts[owner] + offset]
    weight = np.bincount(stretch, np.minimum(np.array(counts), 2)[owner])
    again = weight[stretch] > 1
    first = np.full(len(contents), np.iinfo(np.int64).max)
    last = np.full(len(contents), -1)
    np.minimum.at(first, owner[again], offset[again])
    np.maximum.at(last, owner[again], offset[again])
    return np.where(last < 0, -1, first).tolist(), last.tolist()


def _rows(
    docs: DataFrame, columns: list[str], schema: str, rows_of: Callable[..., Iterator[tuple]]
) -> DataFrame:
    """Rows that ``rows_of`` makes of each document's columns, in columnar batches."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows), fields, strict=True)],
                names=[name for name, _ in fields],
            )

        rows: list[tuple] = []
        for batch in batches:
            for values in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                rows.extend(rows_of(*values))
                if len(rows) >= 100_000:
                    yield made(rows)
                    rows = []
        if rows:
            yield made(rows)

    return docs.select(*columns).mapInArrow(run, schema)


def _signed(values: np.ndarray) -> list[int]:
    return values.view(np.int64).tolist()


def triggers(docs: DataFrame, length: int) -> DataFrame:
    """``gram``: the hash of every phrase's trigger."""

    def rows_of(body: bytes) -> Iterator[tuple]:
        return zip(_signed(phrases(body, length)[0]))

    return _rows(docs, ["body"], "gram long", rows_of)


def _filter_places(grams: np.ndarray) -> list[np.ndarray]:
    """Bit numbers of trigger hashes: slices of the hash scaled by odd numbers."""
    shift = np.uint64(64 - FILTER_BITS)
    return [
        (grams * np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) & _MASK)) >> shift
        for i in range(FILTER_HASHES)
    ]


def trigger_filter(repeated: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size of the repeated triggers, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            bits = np.unique(np.concatenate(_filter_places(grams))).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bits >> 5), pa.array(np.int64(1) << (bits & 31))], names=["word", "bits"]
            )

    words = (
        repeated.mapInArrow(run, "word long, bits long")
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .select(F.col("word").cast("int"), F.col("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return out


def may_repeat(docs: DataFrame, bits: np.ndarray, length: int) -> DataFrame:
    """``(row, doc_id, key, body, copies)``: the documents of which some trigger passes the
    filter, equal rows as one with their number.

    A task hands on a row's body once and what else it has of that row as a number, so a row
    that a third of the table repeats is one body and one number a task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    names = ["row", "doc_id", "key", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        copies: dict[tuple, int] = {}
        for batch in batches:
            found = []
            ids = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for same, body in zip(ids, batch.column(3), strict=True):
                if same in copies:
                    copies[same] += 1
                    found.append(False)
                    continue
                grams = phrases(body.as_py(), length)[0]
                passing = np.ones(len(grams), bool)
                for at in _filter_places(grams):
                    bit = words[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)
                    passing &= (bit & 1).astype(bool)
                found.append(bool(passing.any()))
                copies[same] = 0 if found[-1] else -(1 << 62)
            kept = batch.filter(pa.array(found, pa.bool_()))
            if kept.num_rows:
                once = pa.array(np.ones(kept.num_rows, np.int64))
                yield pa.RecordBatch.from_arrays([*kept.columns, once], names=[*names, "copies"])
        more = [(*same, None, n) for same, n in copies.items() if n > 0]
        if more:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*more, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "copies"])

    schema = "row long, doc_id long, key long, body binary, copies long"
    return docs.select(*names).mapInArrow(run, schema)


def parse(docs: DataFrame, length: int) -> DataFrame:
    """``(row, copies, gram, phrase, first, count)``: each text's phrases in order."""

    def rows_of(row: int, copies: int, body: bytes) -> Iterator[tuple]:
        grams, first, count = phrases(body, length)
        for g, f, c in zip(_signed(grams), first.tolist(), count.tolist(), strict=True):
            h = phrase_hash(body, f, c, length)
            yield row, copies, g, h - (1 << 64) if h >> 63 else h, f, c

    schema = "row long, copies long, gram long, phrase long, first long, count long"
    return _rows(docs, ["row", "copies", "body"], schema, rows_of)


def _compared(contents: DataFrame, length: int) -> DataFrame:
    """``(gram, phrase, lo, hi)``: where phrases of cold triggers repeat, from
    ``(gram, phrase, times, content)``. Chunks of whole triggers share a suffix array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(chunk: dict[tuple[int, int], tuple[int, bytes]]) -> pa.RecordBatch:
            times, texts = zip(*chunk.values(), strict=True)
            lo, hi = compare(list(texts), list(times), length)
            grams, names = zip(*chunk, strict=True)
            columns = [pa.array(x, pa.int64()) for x in (grams, names, lo, hi)]
            return pa.RecordBatch.from_arrays(columns, names=["gram", "phrase", "lo", "hi"])

        def groups() -> Iterator[dict[tuple[int, int], tuple[int, bytes]]]:
            group: dict[tuple[int, int], tuple[int, bytes]] = {}
            last = None
            for batch in batches:
                for g, p, t, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                    if g != last and group:
                        yield group
                        group = {}
                    last = g
                    group[g, p] = (t, c)
            if group:
                yield group

        chunk: dict[tuple[int, int], tuple[int, bytes]] = {}
        size = 0
        for group in groups():
            more = sum(len(c) for _, c in group.values())
            if chunk and size + more > ARRAY_BYTES - 2 * length:
                yield made(chunk)
                chunk, size = {}, 0
            chunk |= group
            size += more
        if chunk:
            yield made(chunk)

    return (
        contents.repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(run, "gram long, phrase long, lo long, hi long")
    )


def _fingerprinted(contents: DataFrame, length: int) -> DataFrame:
    """The same for hot triggers, by fingerprints of single stretches."""

    def rows_of(gram: int, phrase: int, times: int, content: bytes) -> Iterator[tuple]:
        hashes = rolling(np.frombuffer(content, np.uint8), length)
        for at, h in enumerate(_signed(hashes)):
            yield gram, phrase, times, at, h

    stretches = _rows(
        contents,
        ["gram", "phrase", "times", "content"],
        "gram long, phrase long, times long, at long, stretch long",
        rows_of,
    )
    again = (
        stretches.groupBy("gram", "stretch")
        .agg(F.sum("times").alias("n"))
        .where("n > 1")
        .select("gram", "stretch")
    )
    return (
        stretches.join(again, ["gram", "stretch"])
        .groupBy("gram", "phrase")
        .agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
        .select("gram", "phrase", "lo", "hi")
    )


def repeated_runs(
    ws: Workspace, docs: DataFrame, length: int = LENGTH, hot_phrases: int = HOT_PHRASES
) -> tuple[DataFrame, DataFrame]:
    """``(texts, runs)``: the texts that may repeat, ``(row, doc_id, key, body, copies)``, and
    ``(row, runs)``: for each text with repeats the byte runs ``[first, end)``, as they come.

    ``docs`` are ``(row, doc_id, key, body)``. Rows equal in all are copies of one text, which
    is parsed once; what occurs in it counts once for each copy.
    """
    spark = ws.spark
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    repeated = ws.save(
        triggers(docs, length).groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"),
        "triggers",
    )
    texts = may_repeat(docs, trigger_filter(repeated), length).repartition(tasks, "row")
    # The rows of one text lie in one task already: no further exchange.
    texts = texts.groupBy("row", "doc_id", "key").agg(
        F.max("body").alias("body"), F.sum("copies").alias("copies")
    )
    texts = ws.save_bucketed(texts, "texts", ["row"], tasks, dealt=True)
    parsed = parse(texts, length)
    dictionary = ws.save(
        parsed.groupBy("gram", "phrase").agg(
            F.sum("copies").alias("times"),
            F.min("row").alias("row"),
            F.min_by("first", "row").alias("first"),
            F.min("count").alias("count"),
        ),
        "dictionary",
    )
    kinds = dictionary.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    mixed = ws.save(dictionary.join(ws.save(kinds, "kinds"), "gram"), "mixed")
    wanted = mixed.groupBy("row").agg(
        F.collect_list(F.struct("gram", "phrase", "times", "first", "count", "kinds")).alias("wanted")
    )

    def content_of(body: bytes, wanted: list[dict]) -> Iterator[tuple]:
        for w in wanted:
            content = body[w["first"] : w["first"] + w["count"] + length - 1]
            h = phrase_hash(body, w["first"], w["count"], length)
            if h == w["phrase"] & _MASK:  # else another row of the same key
                yield w["gram"], w["phrase"], min(w["times"], 2), content, w["kinds"]

    contents = ws.save(
        _rows(
            texts.join(wanted, "row"),
            ["body", "wanted"],
            "gram long, phrase long, times long, content binary, kinds long",
            content_of,
        ),
        "contents",
    )
    cold = contents.where(F.col("kinds") <= hot_phrases).drop("kinds")
    hot = contents.where(F.col("kinds") > hot_phrases).drop("kinds").dropDuplicates(["gram", "phrase"])
    some = _compared(cold, length).where("hi >= 0").unionByName(_fingerprinted(hot, length))
    # Phrases that occur twice are covered whole, whatever the comparison says of them.
    whole = dictionary.where("times > 1").select("gram", "phrase", F.lit(0).cast("long").alias("lo"), (F.col("count") - 1).alias("hi"))
    once = some.join(dictionary.where("times = 1").select("gram", "phrase"), ["gram", "phrase"])
    covered = ws.save(whole.unionByName(once.select("gram", "phrase", "lo", "hi")), "covered")
    runs = (
        parsed.join(covered, ["gram", "phrase"])
        .select("row", (F.col("first") + F.col("lo")).alias("start"), (F.col("first") + F.col("hi") + length).alias("end"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    )
    return texts, runs


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs that touch or overlap as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def remove_repeats(
    ws: Workspace, docs: DataFrame, length: int = LENGTH, hot_phrases: int = HOT_PHRASES
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every document.

    Every byte goes that lies in a string of ``length`` bytes that also starts anywhere else
    in the table, in the same text or another; matches do not cross texts. Null counts as
    empty, texts shorter than ``length`` stay whole. Repeated rows, equal in id and text, are
    copies of each other. Extra columns are ignored.
    """
    body = F.encode(whole_text(), "UTF-8")
    keyed = docs.select("doc_id", text_key().alias("key"), body.alias("body"))
    keyed = keyed.withColumn("row", F.xxhash64("doc_id", "key"))
    texts, runs = repeated_runs(ws, keyed.select("row", "doc_id", "key", "body"), length, hot_phrases)

    def cut(doc_id: int, key: int, body: bytes, runs: list[dict]) -> Iterator[tuple]:
        spans = merged([(r["start"], r["end"]) for r in runs])
        view, digest, at = memoryview(body), hashlib.sha256(), 0
        for start, end in spans:
            digest.update(view[at:start])
            at = end
        digest.update(view[at:])
        yield doc_id, key, sum(b - a for a, b in spans), len(spans), digest.hexdigest()

    cuts = ws.save(
        _rows(
            texts.join(runs, "row"),
            ["doc_id", "key", "body", "runs"],
            "doc_id long, key long, n_removed long, n_spans long, cut_sha256 string",
            cut,
        ).dropDuplicates(["doc_id", "key"]),
        "cuts",
    )
    whole = keyed.select(
        "doc_id", "key", F.octet_length("body").cast("long").alias("n_bytes"), F.sha2("body", 256).alias("sha256")
    )
    same = F.col("w.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("w.key") == F.col("c.key"))
    nothing = F.lit(0).cast("long")
    return (
        whole.alias("w")
        .join(cuts.alias("c"), same, "left")
        .select(
            F.col("w.doc_id").alias("doc_id"),
            "n_bytes",
            F.coalesce("n_removed", nothing).alias("n_removed"),
            F.coalesce("n_spans", nothing).alias("n_spans"),
            F.coalesce("cut_sha256", "sha256").alias("kept_sha256"),
        )
    )
