"""Benchmark passages in training documents, found by spaced seeds.

Words are runs of lower-cased alphanumerics (A-Z folded, every non-ASCII byte belongs to a word).
A *seed* is a fixed mask over consecutive words: places marked 1 are hashed, places marked 0 are
ignored, so a substituted word under a 0 leaves the hash unchanged.

1. Every distinct benchmark item is hashed under all masks for its length at all places; the hashes also fill
   a bitmap whose size follows their number, up to 8 MB. The masks are such that no overlap as in 3 is without a hit.
2. Every document is hashed under the masks that occur; hashes that miss the bitmap are dropped in the task, the
   others are joined with the benchmark's on the hash. From there on equal texts are one.
3. A hit gives a diagonal (place in the document minus place in the item). The stretch of the document that
   faces the item on it meets the item's words in a join, so no text is copied and none waits in a list. The words are
   compared: an agreement counts 3, a substitution -7, and the best stretch of at least
   13 words (or the whole item if it is shorter) is an overlap if it counts 0 or more, which is 70 %
   agreement.
4. The overlaps of distinct texts with distinct items are joined with the ids that have them.

Items of fewer than 13 words have masks of their own, down to one word. Cases: null or empty texts on either
side match nothing; items or documents that repeat are reported once per (document text, item);
rows that repeat an id are told apart by their texts; with no items or no documents nothing is found;
other columns, whatever their names, are ignored here and kept by :func:`remove_contaminated`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweave.llm import textops as T
from lineweave.llm.tables import HashFilter, cut, fold_id, prepare, read_table
from lineweave.llm.touched import KeyCells, row_key, without

#: Masks of weight 5: every stretch of 13 words or more with 70 % agreement has a place where one of them
#: sees agreeing words only (shown for 13 to 25 words; a longer one has a part of such a length with 70 %).
MASKS = ("111011", "1100001011", "110111", "101000111", "11000100101", "1101101", "11000111")
#: The same for whole items of 1 to 12 words, by their number of words.
SHORT_MASKS = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("111", "1101", "1011"),
    5: ("1111", "11101", "11011", "10111"),
    6: ("11111", "111101", "111011", "110111", "101111"),
    7: ("1111", "11011", "1100011", "1010101"),
    8: ("11011", "1111", "1100011"),
    9: ("111011", "1001111", "11010011", "111101"),
    10: ("11101", "1010011", "1100101", "11000101"),
    11: ("111011", "11010011", "110001011", "1011011", "11011000001"),
    12: ("111011", "110100011", "11001011", "110111"),
}
ALL_MASKS = tuple(dict.fromkeys([*MASKS, *(m for masks in SHORT_MASKS.values() for m in masks)]))
LEAST_WORDS = 13
#: What an agreement and a substitution count: a stretch has 70 % agreement if it counts 0 or more.
AGREEMENT, SUBSTITUTION = 3, 7
#: Largest filter (8 MB of bits), and how many stretches of documents go into one Arrow batch.
MOST_BITS, STRETCHES = 26, 1000


def seeds(words: T.Words, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of the mask ``number`` at every place where it fits into a text."""
    mask, n = ALL_MASKS[number], len(words.h)
    span = len(mask)
    if n < span:
        return np.empty(0, T.U64), np.empty(0, np.int64)
    c = T.constants(span, 1000 * (number + 1))
    total = np.zeros(n - span + 1, T.U64)
    for j, bit in enumerate(mask):
        if bit == "1":
            total += words.h[j : n - span + 1 + j] * c[j]
    at = np.flatnonzero(words.doc[: n - span + 1] == words.doc[span - 1 :])
    return T.mix(total[at]), at


def text_key(text: Column) -> tuple[Column, Column]:
    """A text's identity in 128 bits: columns t1 and t2."""
    return F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")


def _item_seeds(batch: pa.RecordBatch, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """(hash, item, place, length, mask) of the items, each under the masks for its number of words."""
    words, keys = T.hash_words(texts, T.NON_ALNUM), batch.column(0).to_numpy()
    for number, mask in enumerate(ALL_MASKS):
        own = np.array([mask in SHORT_MASKS.get(n, ()) if n < LEAST_WORDS else mask in MASKS for n in words.counts])
        h, at = seeds(words, number)
        h, at = h[own[words.doc[at]]], at[own[words.doc[at]]]
        row = words.doc[at]
        values = [T.signed(h), keys[row], *(v.astype(np.int32) for v in (at - words.first[row], words.counts[row], np.full(len(h), number)))]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["hash", "item", "place", "length", "mask"])


def _hits(known: HashFilter, masks: list[int]):
    """(hash, doc, t1, t2, place) of the documents' seeds under ``masks`` that pass the filter."""

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        words, keys = T.hash_words(texts, T.NON_ALNUM), [batch.column(c).to_numpy() for c in range(3)]
        for number in masks:
            h, at = seeds(words, number)
            hit = known.maybe(h)
            h, at = h[hit], at[hit]
            if len(h):
                row = words.doc[at]
                place = (at - words.first[row]).astype(np.int32)
                values = [T.signed(h), *(k[row] for k in keys), place]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["hash", "doc", "t1", "t2", "place"])

    return T.map_slices("text", work)


def best_overlap(x: np.ndarray, y: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """(first, end) in the document and agreements of the best stretch of words ``x[i] ~ y[i - diagonal]``."""
    lo, hi = max(0, diagonal), min(len(x), len(y) + diagonal)
    if hi <= lo:
        return None
    same, least = x[lo:hi] == y[lo - diagonal : hi - diagonal], min(LEAST_WORDS, len(y))
    if hi - lo < least:
        return None
    total = np.concatenate([[0], np.cumsum(np.where(same, AGREEMENT, -SUBSTITUTION))])
    # Of the stretches that end at each word and have the least length.
    gain = total[least:] - np.minimum.accumulate(total)[: len(total) - least]
    end = int(np.argmax(gain)) + least
    if gain[end - least] < 0:
        return None
    first = int(np.argmin(total[: end - least + 1]))
    return lo + first, lo + end, int(same[first:end].sum())


def _stretches(batch: pa.RecordBatch, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """(t1, t2, item, diagonal, own) for every hit of a text: ``own`` holds the hashes of the text's words that face
    the item's on that diagonal."""
    words, hits = T.hash_words(texts, T.NON_ALNUM), batch.column(3)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(hits).to_numpy())
    item, length, diagonal = (field.to_numpy() for field in hits.flatten().flatten())
    lo, hi = np.maximum(diagonal, 0), np.minimum(words.counts[row], diagonal + length)
    at = np.flatnonzero(hi - lo >= np.minimum(length, LEAST_WORDS))
    lo, hi = lo + words.first[row], hi + words.first[row]
    keys = [batch.column(c).to_numpy() for c in (0, 1)]
    for some in np.array_split(at, len(at) // STRETCHES + 1):
        own = T.binary_column(words.h[x:y] for x, y in zip(lo[some], hi[some]))
        values = [pa.array(v[row[some]]) for v in keys] + [pa.array(item[some]), pa.array(diagonal[some]), own]
        yield pa.RecordBatch.from_arrays(values, names=["t1", "t2", "item", "diagonal", "own"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["t1", "t2", "item", "n_same", "diagonal", "first_word", "end_word"]
    kinds = [pa.int64()] * 3 + [pa.int32()] * 4
    for batch in batches:
        t1, t2, item, diagonals = (batch.column(c).to_pylist() for c in range(4))
        rows = []
        for i, diagonal in enumerate(diagonals):
            x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), T.U64) for c in (4, 5))
            lo = max(0, diagonal)
            got = best_overlap(x, y, diagonal - lo)
            if got:
                rows.append((t1[i], t2[i], item[i], got[2], diagonal, lo + got[0], lo + got[1]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _item_words(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    words = T.hash_words(texts, T.NON_ALNUM)
    of_item = T.binary_column(words.h[a:b] for a, b in zip(words.first[:-1], words.first[1:]))
    return pa.RecordBatch.from_arrays([batch.column(0), of_item], names=["item", "item_words"])


def _text_overlaps(rows: DataFrame, items: DataFrame) -> DataFrame:
    """The best overlap of every distinct text of ``rows`` (doc, t1, t2, text) with every distinct item (item, text):
    t1, t2, item, n_same, diagonal, first_word, end_word."""
    tests = items.mapInArrow(T.map_slices("text", _item_seeds), "hash long, item long, place int, length int, mask int")
    tests = cut(tests.distinct(), "bench-seeds")
    masks = sorted(r["mask"] for r in tests.select("mask").distinct().collect())
    # 256 cells a seed up to the filter's largest size: one place in 256 passes by chance.
    known = HashFilter.of(tests, "hash", bits=min(MOST_BITS, max(16, tests.count().bit_length() + 8)))
    hits = rows.mapInArrow(_hits(known, masks), "hash long, doc long, t1 long, t2 long, place int")
    met = hits.alias("d").join(tests.alias("t"), "hash").select("doc", "t1", "t2", "item", "length", F.expr("d.place - t.place").alias("diagonal"))
    # Copies of a text are one from here on; the one with the smallest id is read.
    met = met.groupBy("t1", "t2", "item", "length", "diagonal").agg(F.min("doc").alias("doc"))
    found = met.groupBy("t1", "t2").agg(F.min("doc").alias("doc"), F.collect_list(F.struct("item", "length", "diagonal")).alias("hits"))
    found = cut(found.withColumn("key", F.xxhash64("doc", "t1")), "bench-hits")
    involved = KeyCells.of(found, "key").split(rows.withColumn("key", F.xxhash64("doc", "t1")), "key", True)
    involved = involved.drop("key").join(found.drop("key"), ["doc", "t1", "t2"]).select("t1", "t2", "text", "hits")
    facing = involved.mapInArrow(T.map_slices("text", _stretches), "t1 long, t2 long, item long, diagonal int, own binary")
    # Dealt out anew, so that a text with many hits is compared in many tasks, none of which has workers for both steps.
    facing = facing.repartition("t1", "t2", "item", "diagonal")
    words = cut(items.mapInArrow(T.map_slices("text", _item_words), "item long, item_words binary"), "bench-words")
    compared = facing.join(words, "item").select("t1", "t2", "item", "diagonal", "own", "item_words")
    compared = compared.mapInArrow(_verify, "t1 long, t2 long, item long, n_same int, diagonal int, first_word int, end_word int")
    best = F.max(F.struct("n_same", (-F.col("diagonal")).alias("back"), "first_word", "end_word")).alias("best")
    return compared.groupBy("t1", "t2", "item").agg(best).select("t1", "t2", "item", "best.n_same", (-F.col("best.back")).alias("diagonal"), "best.first_word", "best.end_word")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Overlaps of documents (doc_id, text) with benchmark items (item_id, text).

    One row per document text and item: doc_id, key, item_id, first_word, end_word (in the document),
    item_first_word, item_end_word, n_same (agreeing words of the best overlap).
    """
    prepare(docs.sparkSession)
    text = F.col("text").cast("string")
    members = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text")).where("text is not null and item_id is not null")
    members = cut(members.select(F.xxhash64("text").alias("item"), "item_id", "text").dropDuplicates(["item", "item_id"]), "bench-items")
    items = members.select("item", "text").dropDuplicates(["item"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold_id("doc_id").alias("doc"), *text_key(text), text.alias("text")).where("text is not null")
    overlaps = cut(_text_overlaps(rows.drop("doc_id"), items), "bench-overlaps")
    copies = KeyCells.of(overlaps, "t1").split(rows.select("doc_id", row_key().alias("key"), "t1", "t2"), "t1", True).distinct()
    out = overlaps.join(members.drop("text"), "item").join(copies, ["t1", "t2"])
    return out.select(
        "doc_id", "key", "item_id", "first_word", "end_word", (F.col("first_word") - F.col("diagonal")).alias("item_first_word"), (F.col("end_word") - F.col("diagonal")).alias("item_end_word"), "n_same"
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that overlap with an item; same columns."""
    return without(docs, cut(contaminated(docs, benchmark).select("key").distinct(), "bench-found"))


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return contaminated(docs, benchmark).drop("key")
