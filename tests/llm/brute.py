"""Plain per-row versions of the operators, for comparison on small tables."""

from __future__ import annotations

import re

GAP = re.compile(r"[\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return [w for w in GAP.split(text or "") if w]


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text: str | None, width: int) -> set[tuple[str, ...]]:
    w = words(ascii_lower(text or ""))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def components(sets: dict, percent: int = 80) -> dict:
    """Smallest id reachable over links, from all pairs that share a shingle."""
    by: dict = {}
    for d, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(d)
    both: dict = {}
    for ids in by.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                both[(a, b)] = both.get((a, b), 0) + 1
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: find(d) for d in sets}
