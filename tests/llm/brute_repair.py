"""Conversation repair by trying every edit of every row, for small conversations."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

BLANK = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def damage(rows: list[dict]) -> list[tuple]:
    out = []
    for r in rows:
        conv, turn = (" " if r[c] is None else r[c] for c in ("conv_id", "turn"))
        fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = " " if r["text"] is None else r["text"]
        role = " " if r["role"] is None else r["role"]
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(r["conv_id"], r["turn"], role, text)] * (2 if fault == 3 else 1)
    return out


def repair(turns: list[tuple[int | None, str, str]]) -> tuple:
    """Report and lines of one conversation's rows ``(turn, role, text)`` after damage."""
    turns = sorted(
        turns,
        key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()),
    )
    faults, seen = [], set()
    for _, role, text in turns:
        if not BLANK.search(text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif BLANK.findall(text)[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append("")
        seen.add((role, text))
    # (cost, audit, lines) by the last role written; "" before any.
    ways = {"": (0, "", ())}

    def inserted(ways: dict) -> dict:
        ways = dict(ways)
        for _ in range(4):
            for last, (cost, audit, lines) in list(ways.items()):
                for x, role in (("u", "user"), ("a", "assistant")):
                    if x in NEXT[last]:
                        new = (cost + 3, audit + "I", (*lines, f"{role}:"))
                        ways[x] = min(ways.get(x, new), new)
        return ways

    for (_, role, text), fault in zip(turns, faults, strict=True):
        after = {}
        for last, (cost, audit, lines) in inserted(ways).items():
            new = [(last, (cost + 4, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] and role[0] in NEXT[last]:
                    new.append((role[0], (cost + more, audit + "K", (*lines, f"{role}:{text}"))))
                for x, other in (("u", "user"), ("a", "assistant")):
                    if x in NEXT[last]:
                        edited = (cost + more + 3, audit + "R", (*lines, f"{other}:{text}"))
                        new.append((x, edited))
            for state, way in new:
                after[state] = min(after.get(state, way), way)
        ways = after
    ways = inserted(ways)
    cost, audit, lines = min(ways[x] for x in ("", "a") if x in ways)
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:], strict=False)]
    n = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return (gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def op12(rows: list[dict]) -> list[tuple]:
    turns = defaultdict(list)
    for conv, turn, role, text in damage(rows):
        turns[conv].append((turn, role, text))
    return [(c, *repair(turns[c])) for c in {r["conv_id"] for r in rows}]
