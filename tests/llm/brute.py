"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import itertools
import re
from collections import Counter


def components(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) >= 5:
        return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def jaccard(docs):
    """{doc_id: (n_shingles, component_id)}"""
    sets = {i: shingles(t) for i, t in docs}
    links = []
    for (a, s), (b, t) in itertools.combinations(sets.items(), 2):
        if s and t and 100 * len(s & t) >= 80 * len(s | t):
            links.append((a, b))
    comp = components(sets, links)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def chunks(text, boundary):
    """Chunks (text, words) given boundary(previous line, line) and the long-line rule."""
    lines = text.split("\n")
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines]
    out, start = [], 0
    for i in range(len(lines)):
        last = i == len(lines) - 1
        if last or words[i] >= 50 or words[i + 1] >= 50 or boundary(lines[i - 1] if i else None, lines[i]):
            out.append(("\n".join(lines[start : i + 1]), sum(words[start : i + 1])))
            start = i + 1
    return out


def line_dedup(docs, boundary):
    """{doc_id: text} with later occurrences of repeated runs of 50 words or more removed."""
    cut = {i: chunks(t, boundary) if t else [] for i, t in docs}
    count = Counter(c for own in cut.values() for c, _ in own)
    # candidates are runs of repeated chunks with 50 words or more, first occurrences included
    def runs(flags, own):
        out = [False] * len(own)
        k = 0
        while k < len(own):
            if flags[k]:
                e = k
                while e < len(own) and flags[e]:
                    e += 1
                if sum(w for _, w in own[k:e]) >= 50:
                    out[k:e] = [True] * (e - k)
                k = e
            else:
                k += 1
        return out

    cand = {i: runs([count[c] > 1 for c, _ in own], own) for i, own in cut.items()}
    first = {}
    for i in sorted(cut):
        for k, (c, _) in enumerate(cut[i]):
            if cand[i][k]:
                first.setdefault(c, (i, k))
    seen = Counter(c for i, own in cut.items() for k, (c, _) in enumerate(own) if cand[i][k])
    out = {}
    for i, t in docs:
        own = cut[i]
        gone = runs([cand[i][k] and seen[c] > 1 and first[c] != (i, k) for k, (c, _) in enumerate(own)], own)
        out[i] = "\n".join(c for k, (c, _) in enumerate(own) if not gone[k]) if own and any(gone) else t
    return out


def maximal_segments(scores):
    """All maximal scoring segments, by repeatedly taking the best one (leftmost, shortest) and recursing."""

    def within(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[0] + 1e-9):
                    best = (total, i, j + 1)
        if best is None:
            return []
        return within(a, best[1]) + [(best[1], best[2])] + within(best[2], b)

    return within(0, len(scores))
