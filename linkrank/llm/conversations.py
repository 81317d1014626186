"""Repair of conversations as weighted deduction, lightest derivation first.

The rows of a conversation in order are edited into a legal alternation of roles. Items are
``(rows read, state)``; an edit of the next row, or an insertion, deduces the next item. A
derivation weighs ``(cost, audit)``: its summed cost and the initials of its edits, appended
one by one. Appending never makes a weight smaller, and of two weights of one item the
smaller stays the smaller: neither audit begins the other, since further edits of the same
rows could only be insertions, and those cost. So Knuth's agenda is exact: items are popped
by weight, and one that is popped is final.

Long conversations are derived piece by piece, from every state a piece may begin in; weights
of pieces append like those of edits.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from linkrank.plans.workspace import Workspace, shuffle_tasks

# Costs and initials of the edits, characters that end a turn.
RELABEL, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
ENDS = ".!?"
BLANKS = " \t\n\v\f\r"
LEGAL = {"su", "ua", "au"}

# Legal role initials are (s?(ua)+)?: states and steps of their acceptor.
STATES = range(4)
START = 0
FINAL = (0, 3)
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WRITTEN = {"u": "user", "a": "assistant"}

# Rows of a conversation that are derived in one go; longer ones take several pieces.
PIECE_ROWS = 512

Weight = tuple[int, str]


@dataclass(frozen=True)
class Row:
    """A turn and its copies: ``n`` equal rows at one place."""

    turn: int | None
    role: str
    text: str
    n: int
    seen: bool  # an earlier row has this role and text

    @property
    def blank(self) -> bool:
        return not self.text.strip(BLANKS)

    @property
    def live(self) -> bool:
        """The first copy may stay; blank rows and repeats have to go."""
        return not self.blank and not self.seen

    @property
    def unfinished(self) -> bool:
        return self.live and self.text.rstrip(BLANKS)[-1] not in ENDS


def deductions(rows: list[Row], at: int, state: int) -> Iterator[tuple[Weight, tuple[int, int]]]:
    """Weight and consequence of every edit that applies to an item."""
    for initial in WRITTEN:
        if (state, initial) in STEPS:
            yield (INSERT, "I"), (at, STEPS[state, initial])
    if at == len(rows):
        return
    row = rows[at]
    # Deleted copies follow at once: an insertion between them is never the lesser audit.
    rest = row.n - 1 if row.live else row.n
    gone, marks = DELETE * rest, "D" * rest
    if not row.live:
        yield (gone, marks), (at + 1, state)
        return
    yield (gone + DELETE, "D" + marks), (at + 1, state)
    stays = gone + UNFINISHED * row.unfinished
    if (state, row.role[:1]) in STEPS:
        yield (stays, "K" + marks), (at + 1, STEPS[state, row.role[:1]])
    for initial in WRITTEN:
        if (state, initial) in STEPS:
            yield (stays + RELABEL, "R" + marks), (at + 1, STEPS[state, initial])


def lightest(rows: list[Row], start: int, goals: Iterable[int]) -> Iterator[tuple[int, Weight]]:
    """States after all rows with their lightest weights, lightest first."""
    wanted = set(goals)
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    while agenda and wanted:
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if at == len(rows) and state in wanted:
            wanted.remove(state)
            yield state, (cost, audit)
        for (more, marks), item in deductions(rows, at, state):
            if item not in final:
                heapq.heappush(agenda, (cost + more, audit + marks, *item))


def rewrite(rows: list[Row], audit: str, state: int) -> list[dict[str, str]]:
    """The turns that an audit leaves, its first edit made in ``state``."""
    turns = []
    marks = iter(audit)

    def write(initial: str, role: str, text: str) -> None:
        nonlocal state
        turns.append({"role": role, "text": text})
        state = STEPS[state, initial]

    def made(text: str) -> None:
        initial = next(x for x in WRITTEN if (state, x) in STEPS)
        write(initial, WRITTEN[initial], text)

    for row in rows:
        left = row.n
        while left:
            mark = next(marks)
            left -= mark != "I"
            if mark == "K":
                write(row.role[:1], row.role, row.text)
            elif mark in "RI":
                made(row.text if mark == "R" else "")
    for _ in marks:
        made("")
    return turns


def counts(rows: list[Row]) -> dict:
    """Faults of rows that follow each other, and what joins them to those around."""
    turns = [row.turn for row in rows if row.turn is not None]
    initials = [row.role[:1] for row in rows]
    broken = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    return {
        "blank": sum(row.n for row in rows if row.blank),
        "duplicate": sum(row.n - row.live for row in rows if not row.blank),
        "truncated": sum(row.unfinished for row in rows),
        "illegal": broken + sum(row.n - 1 for row in rows),
        "turns": len(set(turns)),
        "first_turn": min(turns, default=None),
        "last_turn": max(turns, default=None),
        "first_role": initials[0],
        "last_role": initials[-1],
    }


def total(parts: list[dict]) -> dict:
    """Faults of a whole conversation from those of its pieces in order."""
    out = {name: sum(p[name] for p in parts) for name in ("blank", "duplicate", "truncated", "illegal")}
    for before, after in zip(parts, parts[1:], strict=False):
        out["illegal"] += before["last_role"] + after["first_role"] not in LEGAL
    numbered = [p for p in parts if p["turns"]]
    out["gaps"] = 0
    if numbered:
        span = numbered[-1]["last_turn"] - numbered[0]["first_turn"] + 1
        met = sum(
            a["last_turn"] == b["first_turn"] for a, b in zip(numbered, numbered[1:], strict=False)
        )
        out["gaps"] = span - (sum(p["turns"] for p in numbered) - met)
    return out


# Order of a conversation's rows, and of all rows.
ORDER = ["key", "turn", "role", "digest"]

_INT, _TEXT = pa.int64(), pa.string()
_REPORT = pa.struct(
    [(x, _INT) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", _TEXT)]
)
_TURNS = pa.list_(pa.struct([("role", _TEXT), ("text", _TEXT)]))
_ROW = pa.struct(
    [("turn", _INT), ("role", _TEXT), ("digest", pa.binary()), ("text", _TEXT), ("n", _INT)]
)
_COUNTS = pa.struct(
    [(x, _INT) for x in ("blank", "duplicate", "truncated", "illegal")]
    + [(x, _INT) for x in ("turns", "first_turn", "last_turn")]
    + [("first_role", _TEXT), ("last_role", _TEXT)]
)
_SPANS = pa.list_(
    pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", _INT), ("audit", _TEXT)])
)
_PLACE = [("key", _TEXT), ("run", pa.int32()), ("piece", _INT)]
CUT = pa.schema(
    [("key", _TEXT), ("report", _REPORT), ("turns", _TURNS)]
    + [("run", pa.int32()), ("piece", _INT), ("seq", _INT), ("row", _ROW)]
)
DERIVED = pa.schema([*_PLACE, ("counts", _COUNTS), ("spans", _SPANS)])
CHOSEN = pa.schema(
    [*_PLACE, ("part", _INT), ("state", pa.int32()), ("audit", _TEXT), ("report", _REPORT)]
)
PIECES = pa.schema([("key", _TEXT), ("part", _INT), ("turns", _TURNS)])


def marked(entries: list[dict]) -> list[Row]:
    """All turns of a conversation in order, repeats of earlier ones marked."""
    met: set[tuple[str, bytes]] = set()
    rows = []
    for e in entries:
        this = (e["role"], e["digest"])
        rows.append(Row(e["turn"], e["role"], e["text"], e["n"], this in met))
        met.add(this)
    return rows


def _whole(key: str, entries: list[dict]) -> dict:
    """A conversation that is one piece, repaired."""
    rows = marked(entries)
    _, (cost, audit) = next(lightest(rows, START, FINAL))
    report = {**total([counts(rows)]), "cost": cost, "audit": audit}
    return {"key": key, "report": report, "turns": rewrite(rows, audit, START)}


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repair the conversations that lie inside a sorted run and fit one piece.

    The first and the last may go on in other runs: their rows are passed on with their
    place, as are those of long ones. So no more than a piece is ever held.
    """
    run = TaskContext.get().partitionId()
    key, held, seq, passing = None, [], 0, True
    out: list[dict] = []

    def pass_on() -> None:
        nonlocal seq
        for e in held:
            out.append({"key": key, "run": run, "piece": seq // PIECE_ROWS, "seq": seq, "row": e})
            seq += 1
        held.clear()

    for batch in batches:
        for e in batch.to_pylist():
            if e["key"] != key:
                if passing:
                    pass_on()
                elif held:
                    out.append(_whole(key, held))
                passing, seq, held = key is None, 0, []
                key = e["key"]
            held.append(e)
            if len(held) > PIECE_ROWS:
                passing = True
            if passing:
                pass_on()
        yield pa.RecordBatch.from_pylist(out, CUT)
        out.clear()
    pass_on()
    yield pa.RecordBatch.from_pylist(out, CUT)


def _piece_rows(table: pa.Table) -> list[Row]:
    entries = sorted(table.to_pylist(), key=lambda e: e["seq"])
    return [Row(**{x: e["row"][x] for x in ("turn", "role", "text", "n")}, seen=e["seen"]) for e in entries]


def _derive(key: tuple, table: pa.Table) -> pa.Table:
    """The lightest ways through a piece from every state to every state."""
    rows = _piece_rows(table)
    spans = [
        {"start": start, "stop": stop, "cost": cost, "audit": audit}
        for start in STATES
        for stop, (cost, audit) in lightest(rows, start, STATES)
    ]
    names = dict(zip(("key", "run", "piece"), (k.as_py() for k in key), strict=True))
    return pa.Table.from_pylist([{**names, "counts": counts(rows), "spans": spans}], DERIVED)


def _choose(key: tuple, table: pa.Table) -> pa.Table:
    """The lightest way through all pieces of a conversation. Audits are kept without what
    all of them begin with, so they stay short however many pieces there are."""
    pieces = sorted(table.to_pylist(), key=lambda p: (p["run"], p["piece"]))
    best: dict[int, Weight] = {START: (0, "")}
    came: list[dict[int, dict]] = []
    for piece in pieces:
        ways: dict[int, tuple[Weight, dict]] = {}
        for span in piece["spans"]:
            if span["start"] in best:
                cost, audit = best[span["start"]]
                weight = (cost + span["cost"], audit + span["audit"])
                if span["stop"] not in ways or weight < ways[span["stop"]][0]:
                    ways[span["stop"]] = (weight, span)
        came.append({state: span for state, (_, span) in ways.items()})
        # What all audits begin with decides nothing more.
        same = len(commonprefix([weight[1] for weight, _ in ways.values()]))
        best = {state: (cost, audit[same:]) for state, ((cost, audit), _) in ways.items()}
    state = min((s for s in FINAL if s in best), key=best.__getitem__)
    cost = best[state][0]
    way = []
    for spans in reversed(came):
        way.append(spans[state])
        state = spans[state]["start"]
    way.reverse()
    report = {
        **total([p["counts"] for p in pieces]),
        "cost": cost,
        "audit": "".join(span["audit"] for span in way),
    }
    chosen = [
        {
            **{x: piece[x] for x in ("key", "run", "piece")},
            "part": part,
            "state": span["start"],
            "audit": span["audit"],
            "report": None if part else report,
        }
        for part, (piece, span) in enumerate(zip(pieces, way, strict=True))
    ]
    return pa.Table.from_pylist(chosen, CHOSEN)


def _rewrite_piece(key: tuple, rows: pa.Table, chosen: pa.Table) -> pa.Table:
    (way,) = chosen.to_pylist()
    turns = rewrite(_piece_rows(rows), way["audit"], way["state"])
    return pa.Table.from_pylist([{"key": way["key"], "part": way["part"], "turns": turns}], PIECES)


@dataclass(frozen=True)
class Repaired:
    """``reports(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` and
    ``pieces(conv_id, part, parts, turns)``: the repaired turns, of long conversations in
    several rows, ``part`` from 0."""

    reports: DataFrame
    pieces: DataFrame


def repair_conversations(ws: Workspace, rows: DataFrame) -> Repaired:
    """Least-cost repair of every conversation of ``rows(conv_id, turn, role, text)``.

    Rows stand in order of turn, null first; rows of one turn by role and digest of the
    text. Null roles and texts count as one space; rows without ``conv_id`` are one
    conversation. Equal rows stand side by side and all but the first are duplicates. Extra
    columns are ignored; an empty table gives no rows.

    Rows are sorted into runs of even size, so a conversation may hold any share of them.
    At most two conversations of a run, and long ones, are derived by pieces; what meets in
    one task of these is a conversation's audits, which are a value of the result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    turns = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
    )
    entries = turns.groupBy(*ORDER).agg(F.first("text").alias("text"), F.count("*").alias("n"))
    tasks = shuffle_tasks(ws.spark)
    runs = entries.repartitionByRange(tasks, *ORDER).sortWithinPartitions(*ORDER)
    cut = ws.save(runs.mapInArrow(_cut, from_arrow_schema(CUT)), "cut")

    opened = cut.where("row IS NOT NULL").select("key", "run", "piece", "seq", "row")
    place = F.struct("run", "seq")
    firsts = (
        opened.groupBy("key", F.col("row.role").alias("role"), F.col("row.digest").alias("digest"))
        .agg(F.min(place).alias("first"), F.count("*").alias("met"))
        .where("met > 1")
        .select(F.col("key").alias("of"), "role", "digest", "first")
    )
    same = (F.col("key") == F.col("of")) & (F.col("row.role") == F.col("role"))
    again = opened.join(firsts, same & (F.col("row.digest") == F.col("digest")), "left")
    seen = F.coalesce(F.col("first") < place, F.lit(False)).alias("seen")
    opened = ws.save(again.select("key", "run", "piece", "seq", "row", seen), "opened")

    pieces = opened.groupBy("key", "run", "piece")
    derived = ws.save(pieces.applyInArrow(_derive, from_arrow_schema(DERIVED)), "derived")
    chosen = derived.groupBy("key").applyInArrow(_choose, from_arrow_schema(CHOSEN))
    chosen = ws.save(chosen, "chosen")
    rewritten = pieces.cogroup(chosen.groupBy("key", "run", "piece")).applyInArrow(
        _rewrite_piece, from_arrow_schema(PIECES)
    )
    rewritten = rewritten.join(chosen.groupBy("key").agg(F.count("*").alias("parts")), "key")

    kind = dict(rows.dtypes)["conv_id"]
    conv_id = F.when(F.col("key") != "", F.substring("key", 2, 2**31 - 1)).cast(kind)
    whole = cut.where("row IS NULL")
    reports = whole.select("key", "report").unionByName(
        chosen.where("report IS NOT NULL").select("key", "report")
    )
    all_pieces = whole.select(
        "key", F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"), "turns"
    ).unionByName(rewritten.select("key", "part", "parts", "turns"))
    return Repaired(
        reports.select(conv_id.alias("conv_id"), "report.*"),
        all_pieces.select(conv_id.alias("conv_id"), "part", "parts", "turns"),
    )


def turns_digest(pieces: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)``: of ``role:text`` lines joined by new lines.

    Pieces of one conversation are hashed one after another as they stream by, since a
    digest takes its text in order.
    """
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    joined = F.when(F.size("turns") > 0, F.array_join(line, "\n"))
    lines = pieces.select("conv_id", "part", "parts", joined.alias("lines"))
    whole = F.sha2(F.coalesce("lines", F.lit("")), 256)
    single = lines.where("parts = 1").select("conv_id", whole.alias("repaired_sha256"))
    kind = dict(pieces.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, begun = hashlib.sha256(), False
        for batch in batches:
            done = []
            for e in batch.to_pylist():
                if e["lines"] is not None:
                    digest.update(("\n" * begun + e["lines"]).encode())
                    begun = True
                if e["part"] + 1 == e["parts"]:
                    done.append((e["conv_id"], digest.hexdigest()))
                    digest, begun = hashlib.sha256(), False
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c for c, _ in done], batch.schema.field("conv_id").type),
                    pa.array([d for _, d in done], pa.string()),
                ],
                names=["conv_id", "repaired_sha256"],
            )

    streamed = lines.where("parts > 1").repartition("conv_id")
    hashed = streamed.sortWithinPartitions("conv_id", "part").mapInArrow(
        run, f"conv_id {kind}, repaired_sha256 string"
    )
    return single.unionByName(hashed)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the faults that a checksum of ``conv_id:turn`` deals: of 20 remainders one
    drops a row, one empties its text, one takes out its sentence ends, one repeats it, one
    gives it to the user. Nulls count as one space; a null turn stays null."""
    space = F.lit(" ")
    part = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    fault = (F.crc32(part.cast("binary")) % 20).alias("fault")
    text = F.coalesce(F.col("text").cast("string"), space)
    cut = F.when(F.col("fault") == 1, F.lit("")).when(
        F.col("fault") == 2, F.translate(text, ENDS, "")
    )
    role = F.coalesce(F.col("role").cast("string"), space)
    faulty = rows.select("conv_id", "turn", "role", "text", fault).where("fault != 0")
    return faulty.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(role).alias("role"),
        F.coalesce(cut, text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
