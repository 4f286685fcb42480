"""Repeated passages removed by content-defined chunks over words, with exact edges.

1. **Chunks.** A gear hash (``h = 2h + gear[word]``) rolls over ``k`` words, and text is cut where the hash is the least
   of some ``w`` places in a row (of equal ones the last). Cuts depend on nearby words alone, so an insertion shifts
   none but those around it, and every ``min_words`` words hold two cuts or more that no word outside can move
   (``min_words >= k - 1 + 2 * w``). A chunk runs from one cut to the next, both cuts' words included; it is at most
   ``w + k`` words long, recurring words or not.
2. **De-duplication.** Chunks are de-duplicated by digest (equal ones of one text first, so that periodic text is a few
   rows), with partial sums before the shuffle; a chunk that two or more documents hold is shared.
3. **Edges.** A repeated passage is a run of shared chunks and up to ``w + k`` words on either side. So a window of
   ``min_words`` words is looked at only if all the chunks inside it are shared; it is hashed to 96 bits (10**13 windows
   share one by chance with probability 0.001), and equal
   windows are grouped like chunks. The smallest id that holds a window owns it. Each window has its own owner, so a
   passage may repeat parts of several earlier documents.
4. **Cut.** Words that lie in a window which an earlier document owns are removed; the owner keeps its text.

Words are the same if their bytes are; white space between them may differ. Only what repeats across
documents counts, not within one. The filter that tells shared chunks has sixteen bits a chunk and more, up to 8 MB;
beyond that more windows are hashed and the result stays the same.

Cases: a null text is left as it is, like any text shorter than ``min_words``; rows that repeat an
id count as one document (nothing is cut on account of each other); a null id sorts last; ties can't
occur, since the owner is the smallest id; an empty table gives an empty result; other columns pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from lineweave.llm import textops as T
from lineweave.llm.tables import HashFilter, cut, fold_id, prepare, read_table
from lineweave.llm.touched import KeyCells, fresh_name, row_key, with_key

MIN_WORDS = 50


def gear_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Gear hash of every ``k`` words in a row, put together from those of 1, 2, 4, ... words."""
    part = T.mix(h ^ T.U64(0x243F6A8885A308D3))
    out, have, n = np.zeros(len(h) + 1, T.U64), 0, 1
    while n <= k:
        if k & n:
            out, have = (out[: len(part) - have] << T.U64(n)) + part[have:], have + n
        part, n = (part[:-n] << T.U64(n)) + part[n:], 2 * n
    return out


def spacing(min_words: int) -> tuple[int, int]:
    """(k, w): words of a gear hash and places of which the least is a cut."""
    k = max(1, min_words // 6)
    return k, max(1, (min_words - k + 1) // 2)


def least_places(x: np.ndarray, n: int) -> np.ndarray:
    """Index of the least of every ``n`` values in a row, of equal ones the last."""
    m = len(x) - n + 1
    least, at = x[:m].copy(), np.zeros(m, np.int64)
    for j in range(1, n):
        later = x[j : j + m]
        better = later <= least
        least[better] = later[better]
        at[better] = j
    return at + np.arange(m)


class _Digests:
    """Digests of any range of words in constant time: differences of running sums of word times base to the place,
    divided by the power where the range begins (all modulo 2**64, so an odd base has an inverse)."""

    _powers: dict[int, np.ndarray] = {}

    def __init__(self, h: np.ndarray, seed: int):
        base = int(T.constants(1, seed)[0])
        self.inverse = self._power(pow(base, -1, 1 << 64), len(h))
        self.total = np.concatenate([[T.U64(0)], np.cumsum(T.mix(h + T.U64(seed)) * self._power(base, len(h))[: len(h)], dtype=T.U64)])

    @classmethod
    def _power(cls, base: int, n: int) -> np.ndarray:
        if len(cls._powers.get(base, ())) <= n:
            cls._powers[base] = np.cumprod(np.concatenate([[T.U64(1)], np.full(max(n, 1 << 14), T.U64(base))]), dtype=T.U64)
        return cls._powers[base]

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return T.mix((self.total[hi] - self.total[lo]) * self.inverse[lo] + (hi - lo).astype(T.U64))


class Chunks:
    """The chunks of a slice of texts: ``first`` and ``end`` words, ``digest``, and for every window of ``min_words``
    words inside one text (``at``: its first word) the chunks it holds, from ``lo`` up to ``hi``."""

    def __init__(self, words: T.Words, min_words: int):
        k, w = spacing(min_words)
        n = len(words.h)
        self.at = np.flatnonzero(words.doc[: max(0, n - min_words + 1)] == words.doc[min_words - 1 :])
        self.first = self.end = self.lo = self.hi = np.empty(0, np.int64)
        self.digest = np.empty(0, T.U64)
        if not len(self.at):
            return
        least = least_places(T.mix(gear_hashes(words.h, k)), w)
        span = w + k - 1
        inside = words.doc[: n - span + 1] == words.doc[span - 1 :]
        cuts = np.unique(least[inside])
        number = np.zeros(n, np.int64)
        number[cuts] = np.arange(len(cuts))
        # Between cuts of different texts lies no chunk; such a pair is never inside a window.
        self.first, self.end = cuts[:-1], cuts[1:] + k
        self.digest = _Digests(words.h, 701).of(self.first, self.end)
        self.real = words.doc[cuts[:-1]] == words.doc[cuts[1:]]
        self.lo, self.hi = number[least[self.at]], number[least[self.at + min_words - k + 1 - w]]


def _chunks(min_words: int):
    """(digest, doc) of all chunks, once for equal ones of a text."""

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        words = T.hash_words(texts, lower=False)
        chunks = Chunks(words, min_words)
        real = chunks.real if len(chunks.digest) else np.empty(0, bool)
        digest, run = T.distinct_per_row(chunks.digest[real], words.doc[chunks.first[real]], len(texts))
        doc = np.repeat(batch.column(0).to_numpy(), np.diff(run))
        return pa.RecordBatch.from_arrays([pa.array(T.signed(digest)), pa.array(doc)], names=["digest", "doc"])

    return T.map_slices("text", work)


def _windows(min_words: int, shared: HashFilter):
    """(x, y, doc, key, places) of the windows whose chunks are all shared, equal ones of a text together."""

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        words = T.hash_words(texts, lower=False)
        chunks = Chunks(words, min_words)
        alone = np.concatenate([[0], np.cumsum(~shared.maybe(chunks.digest))])
        at = chunks.at[alone[chunks.hi] == alone[chunks.lo]] if len(chunks.digest) else chunks.at[:0]
        x, y = (_Digests(words.h, seed).of(at, at + min_words) if len(at) else np.empty(0, T.U64) for seed in (702, 703))
        y, row = (y >> T.U64(32)).astype(np.uint32).view(np.int32), words.doc[at]
        order = np.lexsort((at, y, x, row))
        x, y, row, at = x[order], y[order], row[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        places = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), pa.array((at - words.first[row]).astype(np.int32)))
        doc, key = (batch.column(i).to_numpy()[row[first]] for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(T.signed(x[first])), pa.array(y[first]), pa.array(doc), pa.array(key), places], names=["x", "y", "doc", "key", "places"])

    return T.map_slices("text", work)


def covered(places: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Word ranges that the windows at ``places`` cover, merged where they touch."""
    if not len(places):
        return []
    places = np.unique(places)
    new = np.flatnonzero(np.diff(places) > min_words) + 1
    first, last = np.concatenate([[0], new]), np.append(new, len(places)) - 1
    return [(int(a), int(e) + min_words) for a, e in zip(places[first], places[last])]


def _remove(min_words: int, text: str, repeats: str, ranges: str):
    """Cuts the passages out of ``text`` and lists them in ``ranges``."""

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        words, original = T.hash_words(texts, lower=False), batch.column(batch.schema.get_field_index(text))
        wanted = batch.column(batch.schema.get_field_index(repeats))
        new_text, new_ranges = [], []
        for i, t in enumerate(texts):
            lo, hi = words.first[i], words.first[i + 1]
            cuts = covered(wanted[i].values.flatten().to_numpy(), min_words) if wanted[i].is_valid else []
            kept, at = [], 0
            for a, e in cuts:
                kept.append(t[at : words.start[lo + a] - words.base[i]])
                at = words.start[lo + e] - words.base[i] if lo + e < hi else len(t)
            kept.append(t[at:])
            new_text.append((b"".join(kept)).decode() if cuts else original[i].as_py())
            new_ranges.append([{"first_word": int(a), "end_word": int(e)} for a, e in cuts])
        kind = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32())]))
        columns = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != repeats}
        columns[text] = pa.array(new_text, original.type)
        columns[ranges] = pa.array(new_ranges, kind)
        return pa.RecordBatch.from_pydict(columns)

    return T.map_slices(text, work)


def _owned(found: DataFrame, *digest: str) -> DataFrame:
    """(digest, owner) of the digests that two or more documents hold."""
    found = found.groupBy(*digest).agg(F.min("doc").alias("owner"), F.max("doc").alias("last"))
    return found.where("owner <> last").select(*digest, "owner")


def _repeats(docs: DataFrame, min_words: int) -> DataFrame:
    """(key, repeats) of every document with windows that an earlier one owns: lists of their places."""
    chunks = docs.select("doc", "text").mapInArrow(_chunks(min_words), "digest long, doc long")
    shared = cut(_owned(chunks, "digest").select("digest"), "passage-chunks")
    known = HashFilter.of(shared, "digest", bits=min(26, max(16, shared.count().bit_length() + 4)))
    kind = "x long, y int, doc long, key long, places array<int>"
    windows = cut(docs.select("doc", "key", "text").mapInArrow(_windows(min_words, known), kind), "passage-windows")
    owners = cut(_owned(windows, "x", "y"), "passage-owners")
    later = windows.join(owners, ["x", "y"]).where("doc <> owner")
    return cut(later.groupBy("key").agg(F.collect_set("places").alias("repeats")), "passage-by-text")


def remove_repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, ranges: str | None = None) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``; all other columns as they are.

    ``ranges`` names a column to add: the removed word ranges (first_word, end_word) of each row.
    """
    prepare(docs.sparkSession)
    rows = docs.select(fold_id("doc_id").alias("doc"), row_key().alias("key"), F.col("text").cast("string").alias("text"))
    by_text = _repeats(rows, min_words)
    key, repeats = fresh_name(docs, "_key"), fresh_name(docs, "_repeats")
    listed = ranges or fresh_name(docs, "_ranges")
    kind = ArrayType(StructType([StructField("first_word", IntegerType()), StructField("end_word", IntegerType())]))
    maybe = KeyCells.of(by_text, "key")
    whole = with_key(docs, key)
    inside = maybe.split(whole, key, True).join(by_text.select(F.col("key").alias(key), F.col("repeats").alias(repeats)), key, "left")
    schema = StructType([*docs.schema.fields, StructField(listed, kind, True)])
    inside = inside.select(*docs.columns, repeats).mapInArrow(_remove(min_words, "text", repeats, listed), schema)
    outside = maybe.split(whole, key, False).select(*docs.columns).withColumn(listed, F.array().cast(kind))
    out = outside.unionByName(inside)
    return out if ranges else out.drop(listed)


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: what was removed (``first-end`` words, by commas), and the digest of the text that stays."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeated_passages(docs, ranges="removed")
    words = F.aggregate("removed", F.lit(0), lambda n, r: n + r["end_word"] - r["first_word"])
    listed = F.transform("removed", lambda r: F.concat_ws("-", r["first_word"].cast("string"), r["end_word"].cast("string")))
    kept = F.sha2("text", 256).alias("kept_sha256")
    return out.select("doc_id", F.size("removed").alias("n_passages"), words.alias("removed_words"), F.array_join(listed, ",").alias("removed"), kept)


#: DuckDB SQL of the query: all windows of 50 words; a unit is a word and the white space behind it.
OP7_SQL = r"""
    WITH w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') AS units FROM documents),
    u AS (SELECT doc_id, unnest(range(len(units))) AS i, unnest(units) AS unit FROM w),
    k AS (SELECT doc_id, i, md5(string_agg(regexp_extract(unit, '^[^\x20\x09-\x0D]+'), ' ') OVER o) AS digest
          FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) QUALIFY count(*) OVER o = 50),
    o AS (SELECT digest, min(doc_id) AS owner FROM k GROUP BY digest HAVING min(doc_id) <> max(doc_id)),
    c AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM k JOIN o USING (digest) WHERE doc_id <> owner),
    g AS (SELECT doc_id, i, sum(CASE WHEN step <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS passage FROM c),
    r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS e FROM g GROUP BY doc_id, passage),
    l AS (SELECT doc_id, count(*) AS n, sum(e - a) AS words, string_agg(a || '-' || e, ',' ORDER BY a) AS removed FROM r GROUP BY doc_id),
    x AS (SELECT doc_id, unnest(range(a, e)) AS i FROM r),
    t AS (SELECT u.doc_id, string_agg(unit, '' ORDER BY u.i) AS kept FROM u ANTI JOIN x ON u.doc_id = x.doc_id AND u.i = x.i GROUP BY u.doc_id)
    SELECT w.doc_id, coalesce(l.n, 0) AS n_passages, coalesce(l.words, 0) AS removed_words, coalesce(l.removed, '') AS removed,
           CASE WHEN text IS NOT NULL THEN sha256(regexp_extract(text, '^[\x20\x09-\x0D]*') || coalesce(kept, '')) END AS kept_sha256
    FROM w LEFT JOIN l ON l.doc_id = w.doc_id LEFT JOIN t ON t.doc_id = w.doc_id
"""
