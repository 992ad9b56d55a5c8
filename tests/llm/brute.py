"""Plain versions that the operators are held against."""

import hashlib
import re
from collections import Counter, defaultdict


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]


def components(rows, n, part, whole):
    """id -> (set size, smallest id reachable)."""
    sets, parent, holders = {}, {}, defaultdict(list)
    for i, text in rows:
        w = words(text)
        grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        sets[i] = grams if len(w) >= n else {tuple(w)} if w else set()
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in sets.items():
        common = Counter(j for gram in own for j in holders[gram])
        for j, k in common.items():
            if whole * k >= part * (len(own) + len(sets[j]) - k):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for gram in own:
            holders[gram].append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def repeats(rows, length):
    """id -> (bytes, removed, spans, sha256 of the rest)."""
    first, result = {}, {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            first[w] = min(first.get(w, i), i)
    for i, t in data:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        spans = sum(g and (q == 0 or not gone[q - 1]) for q, g in enumerate(gone))
        rest = bytes(c for c, g in zip(t, gone) if not g)
        result[i] = (len(t), sum(gone), int(spans), hashlib.sha256(rest).hexdigest())
    return result
