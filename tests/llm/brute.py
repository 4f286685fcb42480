"""Plain-Python models that the operators are held against."""

from __future__ import annotations

import re


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(rows, percent=85):
    """Smallest id reachable of each (doc_id, text) row; all pairs are compared."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                shared = len(a & b)
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    parent[find(i)] = find(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            r = find(i)
            low[r] = min(low.get(r, doc_id), doc_id)
    return [doc_id if not sets[i] else low.get(find(i)) for i, (doc_id, _) in enumerate(rows)]


def repeated(rows, least=50):
    """Word ranges covered by windows of ``least`` words that a document with a smaller id holds."""
    first, out = {}, {}
    coded = {i: tuple((t or "").encode().split()) for i, t in rows}
    for i in sorted(coded):
        w = coded[i]
        for a in range(len(w) - least + 1):
            first.setdefault(w[a : a + least], i)
    for i, w in coded.items():
        cover = []
        for a in range(len(w) - least + 1):
            if first[w[a : a + least]] != i:
                if cover and a <= cover[-1][1]:
                    cover[-1] = (cover[-1][0], a + least)
                else:
                    cover.append((a, a + least))
        out[i] = cover
    return out


def alnum(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def overlapping(x, y, least=13):
    """Whether words ``x`` and ``y`` agree in 70 % of a stretch of ``least`` words (or all of ``y``): all diagonals
    and all stretches on them."""
    least, places, same = min(least, len(y)), {}, {}
    for j, w in enumerate(y):
        places.setdefault(w, []).append(j)
    for i, w in enumerate(x):
        for j in places.get(w, ()):
            same.setdefault(i - j, []).append(i)
    for diagonal, hits in same.items():
        lo, hi = max(0, diagonal), min(len(x), len(y) + diagonal)
        if 10 * len(hits) < 7 * least or not least:
            continue
        marks = [0] * (hi - lo)
        for i in hits:
            marks[i - lo] = 1
        for a in range(hi - lo):
            if any(10 * sum(marks[a:e]) >= 7 * (e - a) for e in range(a + least, hi - lo + 1)):
                return True
    return False
