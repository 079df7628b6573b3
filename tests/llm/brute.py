"""Plain versions that the operators are held against."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_az(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, k: int = 5) -> set:
    words = WORD.findall(lower_az(text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def components(n: int, links) -> list[int]:
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def near_groups(rows, k: int = 5, percent: int = 75):
    """(doc_id, text) rows → sorted (doc_id, n_shingles, component_id, kept)."""
    sets = [shingles(t, k) for _, t in rows]
    by: dict = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    seen, links = set(), []
    for ids in by.values():
        for x in range(len(ids)):
            for y in range(x):
                p = (ids[y], ids[x])
                if p not in seen:
                    seen.add(p)
                    a, b = sets[p[0]], sets[p[1]]
                    if 100 * len(a & b) >= percent * len(a | b):
                        links.append(p)
    roots = components(len(rows), links)
    least: dict = {}
    for (d, _), r in zip(rows, roots):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(s), c := least.get(r) if s else d, c == d) for (d, _), s, r in zip(rows, sets, roots)), key=str)
