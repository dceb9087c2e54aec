"""Plain Python versions of what operators compute, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, k):
    w = words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def near_groups(rows, k):
    """doc_id -> (set size, component) by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def fewest_edits(item, text):
    """Edits from the item to the run of the text's words that is nearest to it."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)
