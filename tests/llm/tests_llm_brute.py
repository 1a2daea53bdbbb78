"""Brute-force versions that several tests compare with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def removed(rows, size=50):
    first = {}
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - size + 1):
            k = tuple(w[i:i + size])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = {j for i in range(len(w) - size + 1) if first[tuple(w[i:i + size])] < d for j in range(i, i + size)}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


def components(rows, k, percent):
    sets = {}
    for d, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.setdefault(d, {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}
