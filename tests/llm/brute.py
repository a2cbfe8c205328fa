"""Brute-force versions that the operators are held against."""

from __future__ import annotations

import hashlib
import re

BLANK = re.compile(r"[\x20\x09-\x0D]")


def words(text):
    return (text or "").encode().split()


def near(docs, width, percent):
    """{doc_id: (set size, component)} by comparing every pair of distinct sets."""
    sets = {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets[d] = frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            c = len(sets[a] & sets[b])
            if c and 100 * c >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def substring(docs, width):
    """{doc_id: (words, removed, sha256 of what is left, words left)}."""
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        w = words(t)
        cover = [False] * len(w)
        for i in range(len(w) - width + 1):
            key = tuple(w[i:i + width])
            if key in seen:
                cover[i:i + width] = [True] * width
            seen.add(key)
        left = [x for x, c in zip(w, cover) if not c]
        out[d] = (len(w), sum(cover), hashlib.sha256(b" ".join(left)).hexdigest(), b" ".join(left).decode())
    return out


def repeats(text, width=5):
    w = words(text)
    windows = [tuple(w[i:i + width]) for i in range(len(w) - width + 1)]
    cover = set()
    for i, x in enumerate(windows):
        if windows.count(x) > 1:
            cover |= set(range(i, i + width))
    return len(cover)


def exact(docs):
    """{doc_id: (keep_id, group size)}."""
    groups = {}
    for d, t in docs:
        groups.setdefault(BLANK.sub("", t or ""), []).append((-len(t or ""), d))
    return {d: (min(g)[1], len(g)) for g in groups.values() for _, d in g}
