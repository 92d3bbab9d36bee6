"""Plain restatements of the contracts, for small tables."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def repeats(docs, n=20):
    """{doc_id: set of removed word positions} for (doc_id, text)."""
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        w, gone = words(t), set()
        for k in range(len(w) - n + 1):
            q = tuple(w[k : k + n])
            if q in seen:
                gone.update(range(k, k + n))
            seen.add(q)
        out[d] = gone
    return out


def shingle_set(text, size):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


def near_components(docs, size, percent=80):
    """{doc_id: smallest doc_id reachable over links}."""
    sets = {d: shingle_set(t, size) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}, sets


def base_statistics(text):
    t = text or ""
    w = words(t)
    lines, seen, dup = [x for x in t.split("\n") if words(x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    grams = {}
    for k in range(len(w) - 7):
        grams.setdefault(tuple(w[k : k + 8]), []).append(k)
    hit = {p for at in grams.values() if len(at) > 1 for k in at for p in range(k, k + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit)
