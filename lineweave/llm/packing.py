"""Best-fit packing of whole tables after Martello-Toth dominance reduction.

Documents become pieces of at most ``width`` ids. Pieces of the same length are interchangeable, so
the packing problem is a histogram of at most ``width`` lengths, whatever the number of documents;
that histogram is all the driver sees.

1. **Reduction.** For the longest open length a small set that provably dominates every other set
   holding that length is fixed for as many sequences as the counts allow: the length alone if nothing
   fits beside it; with a partner that fills the sequence exactly; with the longest partner if no two
   others fit together or no two fit better; with the best pair if no three fit and the pair covers
   every other pair item by item. A length without such a set is left for step 2.
2. **Best fit.** The remainder goes by decreasing length into the fullest open sequence with room,
   all pieces of a length at once.
3. **Placement.** Every piece gets its rank within its length, counted in hashed parts so that a
   frequent length is no single task, and a small table of rank ranges maps ranks to sequences.

Cases: a null or empty text is the end id alone; a null id is an id like any other; rows that repeat
are packed as often as they come; ties of length are broken by a hash of id and piece, then id; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineweave.llm import textops as T
from lineweave.llm.tables import cut, prepare, read_table
from lineweave.llm.tokens import VOCABULARY, encoder, piece_sizes

WIDTH, END_ID = 1024, 2
#: Hashed parts in which the pieces of one length are numbered.
PARTS = 1024

#: A group of equal sequences: ((length, times), ...) of one sequence, and their number.
Group = tuple[tuple[tuple[int, int], ...], int]


class _Counts:
    """Multiset of lengths with the look-ups of the reduction."""

    def __init__(self, counts: dict[int, int]):
        self.n = {x: c for x, c in counts.items() if c > 0}
        self.order = sorted(self.n)

    def take(self, length: int, times: int) -> None:
        self.n[length] -= times
        if not self.n[length]:
            del self.n[length]
            self.order.pop(bisect_left(self.order, length))

    def give(self, length: int, times: int) -> None:
        if length not in self.n:
            insort(self.order, length)
        self.n[length] = self.n.get(length, 0) + times

    def smallest(self, k: int) -> list[int]:
        out: list[int] = []
        for x in self.order:
            out += [x] * min(self.n[x], k - len(out))
            if len(out) == k:
                break
        return out

    def longest(self, most: int) -> int | None:
        at = bisect_right(self.order, most)
        return self.order[at - 1] if at else None

    def best_pair_sum(self, room: int) -> int:
        lo, hi, best = 0, bisect_right(self.order, room) - 1, 0
        while lo <= hi:
            a, b = self.order[lo], self.order[hi]
            if a + b > room or (lo == hi and self.n[a] < 2):
                hi -= 1
            else:
                best = max(best, a + b)
                lo += 1
        return best

    def longest_second(self, room: int) -> int:
        """The longest y with some x >= y and x + y <= room."""
        for y in reversed(self.order[: bisect_right(self.order, room // 2)]):
            if self.n[y] > 1:
                return y
            at = bisect_right(self.order, y)
            if at < len(self.order) and self.order[at] + y <= room:
                return y
        return 0


def dominant_set(free: _Counts, j: int, width: int) -> tuple[int, ...] | None:
    """Partners of length ``j`` in a set that dominates all others, or None. ``free`` has no j taken."""
    room = width - j
    k = free.longest(room)
    if k is None:
        return ()
    if k == room:
        return (k,)
    low = free.smallest(3)
    if len(low) < 2 or low[0] + low[1] > room:
        return (k,)
    if len(low) < 3 or sum(low) > room:
        if k >= free.best_pair_sum(room):
            return (k,)
        free.take(k, 1)
        a = free.longest(room - k)
        free.give(k, 1)
        if a is not None and a >= free.longest_second(room):
            return (k, a)
    return None


def reduce_dominated(counts: dict[int, int], width: int) -> tuple[list[Group], dict[int, int]]:
    """Groups fixed by dominance, and the counts that remain when a pass fixes nothing more."""
    free, fixed, changed = _Counts(counts), [], True
    while changed:
        changed, below = False, width + 1
        while (j := free.longest(below - 1)) is not None:
            free.take(j, 1)
            partners = dominant_set(free, j, width)
            if partners is None:
                free.give(j, 1)
                below = j
                continue
            need = {j: 1}
            for p in partners:
                need[p] = need.get(p, 0) + 1
            free.give(j, 1)
            # The set stays dominant until one of its lengths runs out: that others lose pieces
            # never helps a rival set.
            times = min(free.n[p] // m for p, m in need.items())
            for p, m in need.items():
                free.take(p, times * m)
            fixed.append((tuple(sorted(need.items(), reverse=True)), times))
            changed = True
    return fixed, dict(free.n)


class CapacityTree:
    """Segment tree over rooms 0..width: the smallest room of at least ``need`` that is present."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.any = [0] * (2 * self.leaves)

    def add(self, room: int, times: int) -> None:
        node = self.leaves + room
        while node:
            self.any[node] += times
            node >>= 1

    def first_at_least(self, need: int) -> int | None:
        node = self.leaves + need
        if self.any[node]:
            return need
        while node > 1:
            if not node & 1 and self.any[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node + (not self.any[2 * node])
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], width: int) -> list[Group]:
    """Best fit by decreasing length on a histogram; equal sequences stay one group."""
    tree, open_ = CapacityTree(width), {}
    closed: list[Group] = []

    def put(pattern: tuple, number: int, room: int) -> None:
        if number and room:
            open_.setdefault(room, []).append((pattern, number))
            tree.add(room, number)
        elif number:
            closed.append((pattern, number))

    for length in sorted((x for x, c in counts.items() if c > 0), reverse=True):
        left = counts[length]
        while left:
            room = tree.first_at_least(length)
            if room is None:
                pattern, number, room = (), -(-left // (width // length)), width
            else:
                pattern, number = open_[room].pop()
                tree.add(room, -number)
            each = room // length
            full, rest = min(number, left // each), 0
            if full < number:
                rest = left - full * each
            left -= full * each + rest
            put((*pattern, (length, each)), full, room - each * length)
            if rest:
                put((*pattern, (length, rest)), 1, room - rest * length)
            put(pattern, number - full - bool(rest), room)
    return closed + [g for groups in open_.values() for g in groups]


def plan_sequences(counts: dict[int, int], width: int) -> list[Group]:
    """Groups of sequences that hold all pieces: whole widths, dominant sets, then best fit."""
    whole = [(((width, 1),), counts[width])] if counts.get(width) else []
    fixed, rest = reduce_dominated({x: c for x, c in counts.items() if x < width}, width)
    return whole + fixed + best_fit_decreasing(rest, width)


def placement_rows(groups: list[Group]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, sequences, offset) for every slot of every group."""
    rows, taken, sequence = [], {}, 0
    for pattern, number in groups:
        offset = 0
        for length, times in pattern:
            for _ in range(times):
                rank = taken.get(length, 0)
                rows.append((length, rank, rank + number, sequence, number, offset))
                taken[length] = rank + number
                offset += length
        sequence += number
    return rows


_SLOT = ("length", "lo", "hi", "first", "number", "offset")
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(vocabulary: str, width: int, end_id: int):
    """Pieces of the texts with the checksum of their ids."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                start = 0
                for piece, size in enumerate(piece_sizes(len(ids) // 4, width)):
                    rows.append((doc_id, piece, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)])))
                    start += size
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def packed_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, width: int = WIDTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32,
    sequence_id and offset (its place in the sequence)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = cut(rows.mapInArrow(_pieces(vocabulary, width, end_id), _PIECES).withColumn("part", F.expr(f"pmod(xxhash64(doc_id, piece), {PARTS})")), "pack-pieces")
    # At most `width` rows reach the driver.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # As an Arrow table, as rows would pass Python workers of their own kind.
    places = placement_rows(plan_sequences(counts, width)) or [(0, 0, 0, 0, 1, 0)]
    slots = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in zip(*places)], names=list(_SLOT)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.groupBy("length", "part").agg(F.count("*").alias("n")).select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("own", F.row_number().over(own) - 1).join(starts, ["length", "part"]).withColumn("rank", F.col("base") + F.col("own"))
    # At most a few groups per length, each of at most width slots: bounded by the width alone.
    placed = ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return placed.select("doc_id", "piece", "start", ranked["length"], "ids_crc32", F.expr("first + rank - lo").alias("sequence_id"), "offset")


def op8_pack(spark, sf_dir: str) -> DataFrame:
    return packed_pieces(read_table(spark, sf_dir, "documents"))
