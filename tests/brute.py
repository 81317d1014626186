"""Plain Python versions of the rules, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict


def page(title: str, body: str | None) -> str:
    """One dump record; no body gives the self-closed form."""
    text = '<text xml:space="preserve" />' if body is None else f"<text a='b'>{body}</text>"
    return f"<page>\n <title>{title}</title><revision>{text}</revision>\n</page>"


def graph(records: list[tuple[str, str | None]]) -> tuple[set, Counter]:
    """Existing pages and surviving edges with copies, from (title, body) records."""
    pages = {title.replace(" ", "_") for title, body in records if body is not None}
    edges = Counter()
    for title, body in records:
        if body is None:
            continue
        source = title.replace(" ", "_")
        targets = {
            found.split("|")[0].replace(" ", "_") for found in re.findall(r"\[\[([^\]]*)\]", body)
        }
        edges.update((source, target) for target in targets - {source} if target in pages)
    return pages, edges


def ranks(pages: set, edges: Counter, iterations: int, damping: float = 0.85) -> dict:
    degree = defaultdict(int)
    for (source, _), copies in edges.items():
        degree[source] += copies
    rank = {title: 1.0 / len(pages) for title in pages}
    for _ in range(iterations):
        received = defaultdict(float)
        for (source, target), copies in edges.items():
            received[target] += rank[source] / degree[source] * copies
        rank = {
            title: (1.0 - damping) / len(pages) + damping * received[title] for title in pages
        }
    return rank
