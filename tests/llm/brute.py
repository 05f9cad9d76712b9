"""Small texts with every edge case, and brute-force versions of what the operators compute."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

WORDS = ["the", "of", "river", "stone", "Maple", "orbit", "quiet", "signal", "vector", "amber", "candle", "forest", "harbor", "mirror", "pepper", "saddle", "tunnel", "window", "yellow", "zephyr"]


def sentence(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


def edge_texts() -> list:
    base = sentence(1, 60)
    near = base.replace(base.split()[30], "changed", 1)
    return [
        None,
        "",
        " \t\n ",
        "word",
        "One two THREE four",
        base,
        base,
        base.upper(),
        near,
        sentence(2, 60) + " " + sentence(3, 12),
        sentence(3, 12),
        sentence(4, 8000),
        "é ß 中文 x\x1cy \U0001f600",
        "x" * 30_000,
        base + "\n" + sentence(5, 40),
    ]


def tuples(df, *columns) -> list[tuple]:
    """The rows in an order that nulls do not disturb."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


_ascii_lower = {c: c + 32 for c in range(65, 91)}


def lowered(text) -> str:
    return (text or "").translate(_ascii_lower)


def spaced_words(text) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lowered(text)) if w]


def plain_words(text) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def held_out(doc_id, m: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m == 2


def shingles(text, k: int = 5) -> frozenset:
    w = spaced_words(text)
    return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])


class Groups:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            i = self.up[i]
        return i

    def tie(self, i: int, j: int) -> None:
        self.up[self.root(i)] = self.root(j)


def jaccard_groups(texts: list) -> Groups:
    sets, groups, lists = [shingles(t) for t in texts], Groups(len(texts)), defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            lists[x].append(i)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in lists[x]:
                common[j] += j < i
        for j, n in common.items():
            if j < i and 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                groups.tie(i, j)
    return groups


def named(groups: Groups, ids: list) -> list:
    """The smallest id of each row's group, nulls aside; its own without one."""
    best: dict = {}
    for i, x in enumerate(ids):
        r = groups.root(i)
        if x is not None:
            best[r] = min(best.get(r, x), x)
    return [best.get(groups.root(i), x) for i, x in enumerate(ids)]
