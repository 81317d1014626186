"""Byte-level BPE as a finite-state transducer that is made deterministic while it runs.

The last token of an encoded prefix is known from that prefix alone, and what stands before
an emitted token does not change what follows it. So the transducer reads bytes one by one and
keeps the last token of each prefix that a longer token could still start from. As soon as all
those prefixes share a common beginning, its tokens are final and are emitted. The lookahead
is bounded by the longest token.

The last token of a prefix is the one token it ends with that may follow the last token of
what is before: two tokens may stand side by side if no merge across their border comes before
the merges that made them. So a step takes a few lookups and merges nothing anew.

A state holds no more than what follows can depend on: where tokens have begun, how far each
is read, and the tokens in front of them back to the last emitted one; that one itself only
while a token may follow it directly. Prefixes that agree in these are one state. Transitions
are worked out when they are first taken and kept in a table of bounded size, as are outputs
of whole pieces; tables serve all tasks of a call that run in one worker process.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from linkrank.llm.text import stretches

# Ids that decoding handles at a time; pieces that encoding handles at a time.
STRETCH = 65_536
# Characters from which on pieces are not listed all at once.
LONG_TEXT = 1_000_000

NO_TOKEN = -1


@dataclass(frozen=True)
class Tables:
    """Entries that a worker's tables keep before they start anew: transitions of about 800
    bytes, outputs of whole pieces of about 200. More cost memory and save work; no id
    depends on them."""

    transitions: int = 40_000
    pieces: int = 200_000


def load_ranks(path: str | Path) -> dict[bytes, int]:
    """Ranks of a tiktoken file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """BPE by definition: the pair of lowest rank merges, the leftmost of equals first."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = len(ranks)
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while pairs and (best := min(pairs)) < none:
        at = pairs.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
    return parts


class Transducer:
    """Encodes pieces of text; ``ranks`` are the compiled merges.

    All tokens make up a trie. A state is the last emitted token, the last token of every
    prefix of the bytes after it, and where tokens begin that are not read to their end: their
    places and nodes of the trie. What no token that may come can ask for is ``NO_TOKEN``.
    """

    def __init__(self, ranks: dict[bytes, int], most: int = Tables.transitions):
        self.ranks, self.most = ranks, most
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.above = max(ranks.values(), default=0) + 2
        self.halves: dict[int, tuple[int, int] | None] = {}
        # The trie by node and byte; each node's token, and whether tokens go on behind it.
        self.trie: dict[int, int] = {}
        self.token_at, self.inner = [NO_TOKEN], [True]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.inner[node] = True
                key = node << 8 | byte
                if key not in self.trie:
                    self.trie[key] = len(self.inner)
                    self.inner.append(False)
                    self.token_at.append(NO_TOKEN)
                node = self.trie[key]
            self.token_at[node] = rank
        # By state, eight bits up, and byte: the next state, eight bits up, and final tokens.
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.states: list[tuple] = []
        self.pairs: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states but the first."""
        self.moves.clear()
        self.states[:] = [(NO_TOKEN, (), ((0, 0),))]
        self.numbers = {self.states[0]: 0}
        self.ends: dict[int, tuple[int, ...]] = {0: ()}

    def parts(self, rank: int) -> tuple[int, int] | None:
        """The two tokens that a token is merged from; itself twice for a single byte, None
        for one that merges never make."""
        if rank not in self.halves:
            token = self.tokens[rank]
            if len(token) == 1:
                self.halves[rank] = (rank, rank)
            else:
                lower = _Below(self.ranks, rank)
                made = [self.ranks[t] for t in merge_bytes(token, lower)]
                self.halves[rank] = (made[0], made[1]) if len(made) == 2 else None
        return self.halves[rank]

    def may_follow(self, first: int, second: int) -> bool:
        """Whether two tokens stay apart side by side.

        Their merges are undone from the last one, always of the token that was made later;
        a merge across the border that comes before those still done would have joined them.
        """
        tokens, ranks = self.tokens, self.ranks
        limit = self.above
        while True:
            joined = ranks.get(tokens[first] + tokens[second])
            if joined is not None and joined < limit and self.parts(joined) == (first, second):
                return False
            # A later left token is undone first; of a single byte nothing is left to undo.
            for left in (True, False) if first > second else (False, True):
                if left:
                    rest = self.parts(first)[1]
                    if rest != first:
                        limit, first = first, rest
                        break
                else:
                    rest = self.parts(second)[0]
                    if rest != second:
                        limit, second = second + 1, rest
                        break
            else:
                return True

    def fits(self, before: int, rank: int) -> bool:
        """Whether a token may be the last one behind another, or at a piece's begin."""
        key = before << 32 | rank
        known = self.pairs.get(key)
        if known is None:
            known = self.parts(rank) is not None
            if known and before != NO_TOKEN:
                known = self.may_follow(before, rank)
            if len(self.pairs) >= self.most:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The next state and the tokens that have become final."""
        before, lasts, begun = self.states[state >> 8]
        if len(self.moves) >= self.most:
            self.reset()
            state = self._number((before, lasts, begun)) << 8
        trie, token_at, inner = self.trie, self.token_at, self.inner
        known = self.pairs.get
        # The one token that fits ends here; tokens that could still come go on.
        last, going = NO_TOKEN, []
        for start, node in begun:
            child = trie.get(node << 8 | byte)
            if child is None:
                continue
            rank = token_at[child]
            if last == NO_TOKEN and rank != NO_TOKEN:
                first = lasts[start - 1] if start else before
                fits = known(first << 32 | rank)
                if fits or fits is None and self.fits(first, rank):
                    last = rank
            if inner[child]:
                going.append((start, child))
        lasts = [*lasts, last]
        # The next token may begin behind this one, or is one of those that go on: step back
        # from all their begins, token by token, to where their paths meet.
        end = common = len(lasts)
        sizes = self.sizes
        for start, _ in reversed(going):
            while common != start:
                if common > start:
                    common -= sizes[lasts[common - 1]]
                else:
                    start -= sizes[lasts[start - 1]]
        going.append((end, 0))
        out = self.path(lasts, common) if common else ()
        # Only the tokens on these paths are asked for again, and the one that was emitted
        # last only where a token begins behind it.
        kept = [NO_TOKEN] * (end - common)
        for start, _ in going:
            while start > common and kept[start - common - 1] == NO_TOKEN:
                kept[start - common - 1] = token = lasts[start - 1]
                start -= sizes[token]
        if going[0][0] > common:
            before = NO_TOKEN
        elif out:
            before = out[-1]
        if common:
            going = [(start - common, node) for start, node in going]
        following = self._number((before, tuple(kept), tuple(going))) << 8
        step = self.moves[state | byte] = following, out
        return step

    def _number(self, state: tuple) -> int:
        number = self.numbers.setdefault(state, len(self.states))
        if number == len(self.states):
            self.states.append(state)
        return number

    def path(self, lasts: Sequence[int], end: int) -> tuple[int, ...]:
        """Tokens of the prefix that ends here."""
        out = []
        while end:
            out.append(lasts[end - 1])
            end -= self.sizes[lasts[end - 1]]
        return tuple(reversed(out))

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one piece; a piece that is a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        state, known = 0, self.moves.get
        for byte in piece:
            state, final = known(state | byte) or self.move(state, byte)
            if final:
                out += final
        if state not in self.ends:
            lasts = self.states[state >> 8][1]
            self.ends[state] = self.path(lasts, len(lasts))
        out += self.ends[state]
        return out


class _Below:
    """The merges that come before one of them."""

    def __init__(self, ranks: dict[bytes, int], rank: int):
        self.ranks, self.rank = ranks, rank

    def __len__(self) -> int:
        return self.rank

    def get(self, token: bytes, none: int) -> int:
        return min(self.ranks.get(token, none), none)


class Utf8Stream:
    """Characters of a stream of bytes, each as soon as its last byte is there.

    The state is the bytes of a character that has begun: at most three. Bytes that can be
    no part of UTF-8 become U+FFFD.
    """

    def __init__(self) -> None:
        self.begun = b""

    def feed(self, data: bytes) -> str:
        data = self.begun + data
        keep = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:  # begins a character of two, three or four bytes
                if back < (2 if byte < 0xE0 else 3 if byte < 0xF0 else 4):
                    keep -= back
                break
            if byte < 0x80:
                break
        self.begun = data[keep:]
        return data[:keep].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """Texts to ids and back: pieces by a pattern, each piece by the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, tables: Tables = Tables()):
        self.most = tables.pieces
        self.transducer = Transducer(ranks, tables.transitions)
        self.pattern = regex.compile(pattern)
        self.tokens = self.transducer.tokens
        self.pieces: dict[str, bytes] = {}

    def _encoded(self, pieces: list[str]) -> bytes:
        known = self.pieces
        out = [*map(known.get, pieces)]
        at = -1
        for _ in range(out.count(None)):
            at = out.index(None, at + 1)
            piece = pieces[at]
            ids = known.get(piece)  # it may have come before in this text
            if ids is None:
                encoded = self.transducer.encode(piece.encode("utf-8", "replace"))
                ids = struct.pack(f"<{len(encoded)}I", *encoded)
                if len(piece) <= 64:
                    if len(known) >= self.most:
                        known.clear()
                    known[piece] = ids
            out[at] = ids
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(text) < LONG_TEXT:
            return self._encoded(self.pattern.findall(text))
        found = (m[0] for m in self.pattern.finditer(text))
        return b"".join(iter(lambda: self._encoded([*islice(found, STRETCH)]), b""))

    def decode(self, ids: bytes) -> Iterator[str]:
        """The text in stretches: whole characters, however tokens divide them."""
        stream, tokens = Utf8Stream(), self.tokens
        numbers = np.frombuffer(ids, "<u4")
        for at in range(0, len(numbers), STRETCH):
            part = numbers[at : at + STRETCH].tolist()
            yield stream.feed(b"".join([tokens[i] for i in part]))
        yield stream.close()


def _codec(shared: Broadcast, pattern: str, tables: Tables) -> Codec:
    """The codec of this worker process, kept in what it has of the broadcast: so it serves all
    tasks of one call, and goes as soon as the worker gets a task that is not of this call."""
    kept = shared.value
    if "codec" not in kept:
        kept["codec"] = Codec(kept["ranks"], pattern, tables)
    return kept["codec"]


def bpe_ids(
    docs: DataFrame, ranks_path: str | Path, pattern: str, tables: Tables = Tables()
) -> DataFrame:
    """``(doc_id, ids, n_tokens, ids_sha256, decoded_sha256)`` of every whole text.

    ``ids`` are little-endian unsigned 32-bit integers; ``decoded_sha256`` is taken from the
    text that streaming decode returns. Null counts as empty: no ids. Extra columns are
    ignored, rows stay as many as they are. The ranks are the vocabulary file's, a few MB
    whatever the table; they are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": load_ranks(ranks_path)})

    def digest_of(codec: Codec, ids: bytes) -> str:
        digest = hashlib.sha256()
        for part in codec.decode(ids):
            digest.update(part.encode("utf-8"))
        return digest.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern, tables)
        gc.disable()  # the tables hold no cycles: to walk them again and again finds nothing
        try:
            for part in (part for batch in batches for part in stretches(batch, "text")):
                ids = [codec.encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                        pa.array([digest_of(codec, x) for x in ids], pa.string()),
                    ],
                    names=["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        finally:
            gc.enable()

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


def decode_ids(encoded: DataFrame, ranks_path: str | Path) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; null ids give an empty text."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks.value, "")
        for batch in batches:
            texts = ["".join(codec.decode(x or b"")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "text"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
