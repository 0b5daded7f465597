"""Brute force of the n-gram Jaccard join."""

from collections import Counter

from closeledger.llm.words import shingle_strings


def brute(rows):
    """doc_id, set size and component of every row, from all pairs that share
    a shingle."""
    sets = [shingle_strings(t or "") for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders.get(x, ()))
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for x in s:
            holders.setdefault(x, []).append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]
