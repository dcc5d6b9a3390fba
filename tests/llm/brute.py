"""Brute-force versions of the operators, in plain Python, for small inputs."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None, lowered: bool = True) -> list[str]:
    return WORD.findall(lower(text or "") if lowered else text or "")


def crc_fold(key, modulus: int) -> int:
    return -1 if key is None else zlib.crc32(str(key).encode()) % modulus


def shingle_set(text: str | None) -> set:
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def jaccard_components(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """id -> (set size, smallest id reachable), comparing all pairs that share a shingle."""
    sets = {k: shingle_set(t) for k, t in rows}
    holders: dict = {}
    for k, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(k)
    shared: Counter = Counter()
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                shared[a, b] += 1
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(s), find(k)) for k, s in sets.items()}


def repetition(text: str | None) -> tuple[int, int, int, int, int, bool]:
    w = words(text, lowered=False)
    n = len(w)
    windows: dict[tuple, list[int]] = {}
    for i in range(n - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    seen: set[str] = set()
    dup = 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, w)), symbols, dup, len(covered), failed


def unigram(rows: list[tuple[int | None, str | None]]) -> dict:
    """Row number -> (held out, tokens, known, N, base score)."""
    texts = [(crc_fold(k, 7) == 2, [*words(t), "\n"]) for k, t in rows]
    count = Counter(x for held, w in texts if not held for x in w)
    total, distinct = sum(count.values()), len(count)
    return {
        i: (held, len(w), sum(count[x] > 0 for x in w), total, sum(math.log10((count[x] + 1) / (total + distinct + 1)) for x in w))
        for i, (held, w) in enumerate(texts)
    }


def edit_inside(passage: str, text: str) -> int:
    """Least edits between the passage and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        last, row[0] = row[0], i
        for j, c in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != c))
    return min(row)
