"""Contexts of personal data, round by round, with dictionaries."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from linkrank.llm import pii
from tests.llm import brute

APART = pii.EMAIL.replace(r"\G|", "")
NUMBER = rf"(?<![A-Za-z0-9]){pii.CARD}(?![A-Za-z0-9])"
EITHER = re.compile("|".join(f"(?:{p})" for p in (APART, pii.PHONE, pii.IP, NUMBER, pii.TOKEN)))


def fits(instance: str) -> set[str]:
    return {k for k in pii.DISCOVERED if re.search(pii.SHAPES[k], instance)}


def instances(text: str) -> list[tuple]:
    """``(start, end, instance, kind, patterns)`` of every occurrence."""
    found = [m for m in EITHER.finditer(text)]
    out = []
    for i, m in enumerate(found):
        before = text[found[i - 1].end() if i else 0 : m.start()][-64:]
        after = text[m.end() : found[i + 1].start() if i + 1 < len(found) else len(text)][:64]
        bare = m[0].lstrip(pii.LEFT_MARKS)
        start = m.start() + len(m[0]) - len(bare)
        bare = bare.rstrip(pii.RIGHT_MARKS)
        kind = pii.SECRET if re.search(pii.SECRET_SEED, bare) else None
        for k in reversed(pii.KINDS):
            if re.fullmatch(brute.KINDS[k], m[0]) and brute.valid(k, m[0]):
                kind = k
        left, right = brute.WORD.findall(before.lower()), brute.WORD.findall(after.lower())
        patterns = []
        if left:
            patterns.append("<" + left[-1])
            if len(left) > 1:
                patterns.append(f"<<{left[-2]} {left[-1]}")
            if right:
                patterns.append(f"<>{left[-1]} {right[0]}")
        if kind in pii.KINDS:
            out.append((m.start(), m.end(), m[0].lower(), kind, patterns))
        elif bare:
            out.append((start, start + len(bare), bare.lower(), kind, patterns))
    return out


def spans(docs: list[dict], how: pii.Bootstrap = pii.Bootstrap()) -> list[tuple]:
    """``(doc_id, spans)`` as the operator writes them."""
    found = [(d, instances(d["text"] or "")) for d in docs]
    flat, seeds = Counter(), {}
    for _, rows in found:
        for _, _, instance, kind, patterns in rows:
            for p in patterns:
                flat[p, instance] += 1
                if kind:
                    seeds[instance, kind] = 1.0
    known = dict(seeds)
    for _ in range(how.rounds):
        sures = defaultdict(dict)
        for (instance, kind), sure in known.items():
            sures[instance][kind] = sure
        sums = defaultdict(Counter)
        for (p, instance), n in flat.items():
            for k in pii.DISCOVERED:
                sums[p]["unfit", k] += n * (k not in fits(instance))
                if instance in sures:
                    sums[p]["known", k] += n * (k in fits(instance))
                    if k in sures[instance]:
                        sums[p]["hits", k] += n * sures[instance][k]
                        sums[p]["support", k] += 1
        scored = {}
        for p, s in sums.items():
            for k in pii.DISCOVERED:
                judged = s["unfit", k] + s["known", k]
                if judged and s["support", k] >= how.support and s["hits", k] / judged >= how.confidence:
                    scored[p, k] = s["hits", k] / judged
        reached = defaultdict(float)
        for (p, instance) in flat:
            for k in fits(instance):
                reached[instance, k] = max(reached[instance, k], scored.get((p, k), 0.0))
        seeded = {instance for instance, _ in seeds}
        known = seeds | {x: s for x, s in reached.items() if s >= how.known and x[0] not in seeded}
    out = []
    for d, rows in found:
        base = brute.base_spans(d["text"])
        fresh = {
            (k, start, end)
            for start, end, instance, kind, patterns in rows
            if kind not in pii.KINDS
            for k in fits(instance)
            if any((p, k) in scored for p in patterns)
        }
        every = sorted({*base, *fresh}, key=lambda s: (pii.DISCOVERED.index(s[0]), *s[1:]))
        out.append((d["doc_id"], ",".join(f"{k}:{a}:{b}" for k, a, b in every)))
    return out
