"""Vectorised text helpers that run inside Spark tasks, on Arrow batches of bounded size.

A batch of texts is joined into one byte array and everything is numpy work on that array: word
spans, 64-bit word hashes, shingle hashes. Slices hold about ``SLICE_BYTES`` (a longer text is a
slice of its own), so a task's memory doesn't depend on how many rows Arrow delivers at once.
Hashes depend on the bytes alone and agree between processes, runs and machines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
#: Bytes whose words are hashed at once.
HASH_BYTES = 1 << 21

U64 = np.uint64


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return h.view(np.int64)


def byte_class(ranges: Iterable[tuple[int, int]]) -> np.ndarray:
    """Boolean table over the 256 byte values, true inside the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Separators of white-space words: space and U+0009..U+000D.
WHITE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Separators of alphanumeric words in lower-cased text: ASCII other than 0-9 and a-z.
NON_ALNUM = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (shift, multiply) that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers from a rule: the finaliser over a counter."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


_BYTE_CODE = constants(256, 11)
_POWERS = np.empty(0, dtype=U64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([[U64(1)], np.full(max(n, 4096) - 1, U64(0x5851F42D4C957F2D))]))
    return _POWERS


@dataclass
class Words:
    """Words of a slice of texts, in text order.

    ``doc`` is the row in the slice, ``start``/``end`` byte places in ``buf``, ``first`` the index
    of each row's first word (one entry more than rows), ``base`` each row's first byte.
    """

    h: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    buf: np.ndarray
    base: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def hash_words(texts: list[bytes], separators: np.ndarray = WHITE, lower: bool = True) -> Words:
    """Words and their 64-bit hashes; ``lower`` folds A-Z only."""
    joined = b"\n".join(texts) + b"\n"
    buf = np.frombuffer(joined.lower() if lower else joined, dtype=np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    gap = separators[buf]
    gap[base[1:] - 1] = True
    before = np.empty_like(gap)
    before[0] = True
    before[1:] = gap[:-1]
    start = np.flatnonzero(before & ~gap)
    end = np.flatnonzero(gap & ~before)
    first = np.searchsorted(start, base)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(first))
    if not len(start):
        return Words(np.empty(0, U64), doc, start, end, first, buf, base)
    h = np.empty(len(start), U64)
    # A long text is hashed in blocks of words, so that only spans and hashes are held for the whole.
    cuts = np.unique(np.searchsorted(start, np.arange(0, len(buf) + HASH_BYTES, HASH_BYTES)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        lo, hi = start[a], end[b - 1]
        h[a:b] = _hash_block(buf[lo:hi], gap[lo:hi], start[a:b] - lo, end[a:b] - lo)
    return Words(h, doc, start, end, first, buf, base)


def _hash_block(buf: np.ndarray, gap: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words start:end of ``buf``; the first word starts at 0, the last ends with it."""
    lengths = end - start
    place = np.arange(len(buf)) - np.repeat(start, np.diff(np.append(start, len(buf))))
    np.minimum(place, int(lengths.max()), out=place)
    values = _BYTE_CODE[buf]
    values[gap] = 0
    values *= _powers(int(lengths.max()) + 1)[place]
    return mix(np.add.reduceat(values, start) + lengths.astype(U64) * U64(0xD6E8FEB86659FD93))


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words inside one text, and its row.

    A text of 1 to k-1 words gives its whole sequence as one shingle; one without words gives none.
    """
    c = constants(k + 1, 77)
    n, counts = len(words.h), words.counts
    out_h, out_doc = [], []
    if n >= k:
        total = words.h[: n - k + 1] * c[0]
        for j in range(1, k):
            total = total + words.h[j : n - k + 1 + j] * c[j]
        inside = words.doc[: n - k + 1] == words.doc[k - 1 :]
        out_h.append(mix(total[inside]))
        out_doc.append(words.doc[: n - k + 1][inside])
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        sums = np.zeros(len(short), U64)
        for j in range(k - 1):
            has = counts[short] > j
            sums[has] += words.h[words.first[short[has]] + j] * c[j]
        out_h.append(mix(sums + counts[short].astype(U64) * c[k]))
        out_doc.append(short.astype(np.int32))
    if not out_h:
        return np.empty(0, U64), np.empty(0, np.int32)
    h, doc = np.concatenate(out_h), np.concatenate(out_doc)
    if len(out_h) > 1:
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    return h, doc


def distinct_per_row(h: np.ndarray, doc: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, and where each row's run starts (rows + 1 entries)."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[keep], doc[keep]
    return h, np.searchsorted(doc, np.arange(rows + 1))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes the empty text."""
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes together (at least one row each)."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def map_slices(
    text: str, work: Callable[[pa.RecordBatch, list[bytes]], pa.RecordBatch | Iterable[pa.RecordBatch] | None]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function: ``work`` sees a bounded slice of rows and its texts as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(batch.schema.get_field_index(text)))
            for lo, hi in slices(texts):
                out = work(batch.slice(lo, hi - lo), texts[lo:hi])
                if isinstance(out, pa.RecordBatch):
                    yield out
                elif out is not None:
                    yield from out

    return run


def binary_column(parts: Iterable[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())
