"""Suffix trees (Ukkonen) of sequences of whole numbers, and common extensions through them.

A tree lives inside a task, for one stretch of one document. Nodes are places in flat lists and all
edges are one dictionary, so a stretch of n symbols takes about 300 bytes a symbol while it is worked on.
"""

from __future__ import annotations

import numpy as np


class SuffixTree:
    """Tree of ``symbols`` (1 .. ``most``) with the end mark 0 behind them."""

    def __init__(self, symbols: list[int], most: int):
        self.text = [*symbols, 0]
        self.width = most + 1
        self._build()

    def _build(self) -> None:
        text, width = self.text, self.width
        n = len(text)
        start, end, link, edges = [0], [0], [0], {}
        node = length = waiting = edge = 0
        for i, c in enumerate(text):
            unlinked = 0
            waiting += 1
            while waiting:
                if not length:
                    edge = i
                key = node * width + text[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i), end.append(n), link.append(0)
                    if unlinked:
                        link[unlinked], unlinked = node, 0
                else:
                    size = min(end[child], i + 1) - start[child]
                    if length >= size:
                        edge, length, node = edge + size, length - size, child
                        continue
                    at = start[child]
                    if text[at + length] == c:
                        if unlinked and node:
                            link[unlinked] = node
                        length += 1
                        break
                    split = len(start)
                    start.append(at), end.append(at + length), link.append(0)
                    edges[key] = split
                    edges[split * width + c] = split + 1
                    start.append(i), end.append(n), link.append(0)
                    start[child] = at + length
                    edges[split * width + text[at + length]] = child
                    if unlinked:
                        link[unlinked] = split
                    unlinked = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        key = np.fromiter(edges.keys(), np.int64, len(edges))
        self.child = np.fromiter(edges.values(), np.int64, len(edges))
        self.parent, self.first = key // width, key % width
        self.size = np.array(end) - np.array(start)

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Euler tour with children in rising (or falling) order of their first symbols, the end mark
        always first: the suffixes in the order of their leaves, and before each leaf the least string
        depth that the tour has passed since the leaf before (the depth of the two leaves' lowest
        common ancestor)."""
        rank = np.where(self.first == 0, 0, self.width - self.first) if falling else self.first
        order = np.lexsort((-rank, self.parent))
        by_parent = self.parent[order]
        nodes = len(self.size)
        first = np.searchsorted(by_parent, np.arange(nodes + 1)).tolist()
        children, size = self.child[order].tolist(), self.size.tolist()
        n = len(self.text)
        leaves, between = [], []
        stack, depths, low = [0], [0], 0
        while stack:
            node, above = stack.pop(), depths.pop()
            if above < low:
                low = above
            lo, hi = first[node], first[node + 1]
            depth = above + size[node]
            if lo == hi:
                leaves.append(n - depth)
                between.append(low)
                low = n
            else:
                stack += children[lo:hi]
                depths += [depth] * (hi - lo)
        return np.array(leaves), np.array(between)


class CommonExtension:
    """Length of the longest common prefix of two suffixes, in constant time each: the least entry of the
    tour between their leaves, from minima of blocks of a power of two."""

    def __init__(self, leaves: np.ndarray, between: np.ndarray):
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        levels = [between.astype(np.int32)]
        while 2 << (len(levels) - 1) <= len(between):
            half = 1 << (len(levels) - 1)
            levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
        self.levels = levels

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For suffixes ``a`` and ``b``, different in each place."""
        x, y = self.rank[a], self.rank[b]
        lo, hi = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.log2(hi - lo + 1).astype(np.int64) if len(lo) else lo
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][lo[at]], self.levels[k][hi[at] - (1 << int(k)) + 1])
        return out


def lyndon_lengths(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place but the end mark: up to the next suffix
    of a smaller rank."""
    ranks, out, stack = rank.tolist(), [0] * (len(rank) - 1), []
    for i, r in enumerate(ranks):
        while stack and ranks[stack[-1]] > r:
            at = stack.pop()
            out[at] = i - at
        stack.append(i)
    return np.array(out, np.int64)


def runs(symbols: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """Rows (start, length, period), in this order, of the maximal periodic runs of ``symbols`` that are at
    least ``least`` and ``exponent`` times their smallest period long (``exponent`` 2 or more).

    Every run has a root that is the longest Lyndon word at its place, in the rising or in the falling
    order of symbols; each such word is a candidate and is extended both ways, forwards by the tree of the
    sequence and backwards by the tree of its reversal.
    """
    n = len(symbols)
    _, codes = np.unique(symbols, return_inverse=True)
    codes = codes + 1
    most = int(codes.max())
    tree = SuffixTree(codes.tolist(), most)
    leaves, between = tree.tour()
    forwards = CommonExtension(leaves, between)
    falling = np.empty(n + 1, np.int64)
    falling[tree.tour(falling=True)[0]] = np.arange(n + 1)
    backwards = CommonExtension(*SuffixTree(codes[::-1].tolist(), most).tour())
    at = np.tile(np.arange(n), 2)
    period = np.concatenate([lyndon_lengths(forwards.rank), lyndon_lengths(falling)])
    fits = exponent * period <= n
    at, period = np.unique(np.stack([at[fits], period[fits]]), axis=1)
    # The end mark and the place before the first symbol extend nothing.
    end = at + period + forwards(at, at + period)
    back = np.zeros(len(at), np.int64)
    inner = np.flatnonzero(at > 0)
    back[inner] = backwards(n - at[inner], n - at[inner] - period[inner])
    start = at - back
    length = end - start
    good = length >= np.maximum(least, exponent * period)
    found = np.unique(np.stack([start[good], period[good], length[good]]), axis=1)
    return found[[0, 2, 1]].T
