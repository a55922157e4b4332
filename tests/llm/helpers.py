"""Brute-force versions of the operators, in plain Python."""

from __future__ import annotations

import re

UPPER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return [w for w in re.split("[ \t-\r]+", (text or "").translate(UPPER)) if w]


def shingle_list(ws, k=5):
    k = min(k, len(ws))
    return [tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)] if ws else []


def components(texts):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = {i: frozenset(shingle_list(words(t))) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def overlap(a, b):
    """Weighted Jaccard similarity of two lists, as (minima, maxima)."""
    low = sum(min(a.count(x), b.count(x)) for x in set(a) & set(b))
    return low, len(a) + len(b) - low


def leaks(texts, items):
    """{(doc_id, item_id)} over every item-sized window of every text."""
    found = set()
    for d, t in texts.items():
        ws = words(t)
        for i, item in items.items():
            own = words(item)
            if not own or not ws:
                continue
            k, m = min(5, len(own)), len(own)
            want = [tuple(own[j:j + k]) for j in range(m - k + 1)]
            for s in range(max(1, len(ws) - m + 1)):
                cut = ws[s:s + m]
                low, high = overlap([tuple(cut[j:j + k]) for j in range(len(cut) - k + 1)], want)
                if low and 100 * low >= 75 * high:
                    found.add((d, i))
                    break
    return found
