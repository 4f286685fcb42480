"""Periodic runs of words, found with suffix trees, and texts collapsed to one period of each.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least
``least`` words and ``exponent`` periods long, that no neighbouring word extends. A collapsed text keeps
the first period of every run and all words outside runs, joined by one space.

1. **Stretches.** If k = min over q of (max(least, exponent * q) - 2q + 1), every run holds at least 2q
   k-grams of words for its period q, so each of them occurs twice or more inside the run. Words are thus
   cut into stretches whose k-grams all occur twice in the same stretch, again until nothing changes.
   No run is lost by it and no word of ordinary prose is left; it is numpy work on a slice of texts.
2. **Trees.** For every stretch, Ukkonen's suffix trees of it and of its reversal
   (:mod:`lineweave.llm.suffix_tree`); an Euler tour of each with constant-time lowest common ancestors
   gives the common extension of two places.
3. **Roots.** The longest Lyndon word at each place, in both orders of the words, is a candidate root; it
   is extended both ways and kept if the run is long enough.

Nothing is shuffled: a document's runs are its own. Words are equal if their 64-bit hashes are (inside one
document). Memory is a slice of texts plus about 300 bytes a word of the stretch at work.

Cases: a null, empty or white text has no words and no runs and collapses to the empty text; null ids,
ties and repeated rows each give their row; an empty table gives an empty result; other columns pass,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lineweave.llm import textops as T
from lineweave.llm.suffix_tree import runs
from lineweave.llm.tables import prepare, read_table
from lineweave.llm.touched import fresh_name

LEAST, EXPONENT = 6, 4


def gram_words(least: int, exponent: int) -> int:
    """Words of the grams that must occur twice in any run."""
    return max(1, min(max(least, exponent * q) - 2 * q + 1 for q in range(1, least + 2)))


def repeating_stretches(h: np.ndarray, doc: np.ndarray, least: int, exponent: int) -> list[tuple[int, int]]:
    """Ranges of words, inside one document each, that hold every run."""
    k = gram_words(least, exponent)
    n = len(h) - k + 1
    if n < 1:
        return []
    c = T.constants(k, 1201)
    gram = np.zeros(n, T.U64)
    for j in range(k):
        gram += h[j : j + n] * c[j]
    gram = T.mix(gram)
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    group = doc[at].astype(np.int64)
    while len(at):
        order = np.lexsort((gram[at], group))
        g, x = group[order], gram[at[order]]
        same = (g[1:] == g[:-1]) & (x[1:] == x[:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        kept, before = at[twice], len(at)
        # A stretch ends where a gram is missing or the text ends.
        breaks = np.ones(len(kept), bool)
        breaks[1:] = (np.diff(kept) != 1) | (np.diff(group[twice]) != 0)
        first = np.flatnonzero(breaks)
        size = np.diff(np.append(first, len(kept))) + k - 1
        long = np.repeat(size >= max(least, exponent), size - k + 1)
        group, at = (np.cumsum(breaks) - 1)[long], kept[long]
        if len(at) == before:
            break
    if not len(at):
        return []
    first = np.flatnonzero(np.concatenate([[True], np.diff(group) != 0]))
    last = np.append(first[1:], len(at)) - 1
    return [(int(a), int(b) + k) for a, b in zip(at[first], at[last])]


def slice_runs(h: np.ndarray, doc: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of a slice of texts; starts count the slice's words."""
    found = []
    for lo, hi in repeating_stretches(h, doc, least, exponent):
        own = runs(h[lo:hi], least, exponent)
        own[:, 0] += lo
        found.append(own)
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _find(text: str, out: str, collapsed: str, least: int, exponent: int):
    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        words = T.hash_words(texts, lower=False)
        found = slice_runs(words.h, words.doc, least, exponent)
        owner = words.doc[found[:, 0]]
        edges = np.searchsorted(owner, np.arange(len(texts) + 1))
        # Words behind the first period of a run go.
        change = np.zeros(len(words.h) + 1, np.int64)
        np.add.at(change, found[:, 0] + found[:, 2], 1)
        np.add.at(change, found[:, 0] + found[:, 1], -1)
        kept = np.cumsum(change)[:-1] == 0
        lists = pa.StructArray.from_arrays([pa.array(found[:, 0] - words.first[owner]), pa.array(found[:, 1]), pa.array(found[:, 2])], fields=list(_RUN))
        columns = dict(zip(batch.schema.names, batch.columns))
        columns.pop(text)
        columns[out] = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), lists)
        columns[collapsed] = _joined(words, kept, len(texts))
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return T.map_slices(text, work)


def _joined(words: T.Words, kept: np.ndarray, rows: int) -> pa.Array:
    """The kept words of every text, joined by one space."""
    start, size = words.start[kept], (words.end - words.start)[kept]
    doc = words.doc[kept]
    last = np.ones(len(doc), bool)
    last[:-1] = doc[1:] != doc[:-1]
    width = size + ~last
    edge = np.cumsum(width)
    place = np.arange(edge[-1] if len(edge) else 0) - np.repeat(edge - width, width)
    data = words.buf[np.repeat(start, width) + place]
    data[(edge - 1)[~last]] = 0x20
    ends = np.concatenate([[0], np.cumsum(np.bincount(doc, width, rows))]).astype(np.int32)
    return pa.StringArray.from_buffers(rows, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data)))


def periodic_runs(docs: DataFrame, out: str = "runs", collapsed: str = "collapsed", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """``docs`` (text) with two more columns: ``out``, the runs (start, length, period; starts are word
    numbers from 0) by start and period, and ``collapsed``, the text with one period of each."""
    prepare(docs.sparkSession)
    if exponent < 2:
        raise ValueError("a run is two periods long at least")
    taken = {c.lower() for c in docs.columns}
    if {out.lower(), collapsed.lower()} & taken:
        raise ValueError(f"the table has a column {out!r} or {collapsed!r}")
    work = fresh_name(docs, "_whole")
    rows = docs.withColumn(work, F.coalesce(F.col("text").cast("string"), F.lit("")))
    added = StructType.fromDDL(f"{out} array<struct<start:long,length:long,period:long>>, {collapsed} string")
    return rows.mapInArrow(_find(work, out, collapsed, least, exponent), StructType([*docs.schema.fields, *added.fields]))


def _with_repeats(docs: DataFrame) -> DataFrame:
    """The query's texts: in a tenth of the documents the words from one place on repeat a period."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    docs = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("long").alias("g"))
    word = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    docs = docs.withColumn("w", F.when(F.col("h") % 10 == 0, word)).withColumn("n", F.size("w").cast("long"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)) + 1)
    place = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    repeated = F.transform(place, lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Per document: its longest run, and digests of all runs and of the collapsed text."""
    out = periodic_runs(_with_repeats(read_table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    out = out.withColumn("best", best)
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: DuckDB SQL of the query; the crc32 of an id is folded over its digits, a byte and eight shifts (-1) each.
OP12_SQL = r"""
    WITH b AS (
        SELECT doc_id, coalesce(text, '') AS t,
               xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(CAST(doc_id AS VARCHAR), '')])),
                   lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295) AS h
        FROM documents),
    w AS (SELECT doc_id, h, h // 10 AS g, [x FOR x IN regexp_split_to_array(t, '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM b),
    a AS (SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN g % len(ws) END AS a FROM w),
    p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
    u AS (SELECT doc_id, n, a, p, unnest(range(n)) AS i, unnest(ws) AS word FROM p),
    v AS (SELECT doc_id, n, i, word FROM u WHERE a IS NULL OR i < a
          UNION ALL SELECT x.doc_id, x.n, x.i, y.word FROM u x JOIN u y ON x.doc_id = y.doc_id AND y.i = x.a + (x.i - x.a) % x.p WHERE x.i >= x.a),
    -- A run of period q holds five words in a row that are equal to the five q words on.
    k AS (SELECT doc_id, n, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS gram
          FROM v WINDOW o AS (PARTITION BY doc_id ORDER BY i) QUALIFY lead(word, 4) OVER o IS NOT NULL),
    e AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM k x JOIN k y ON x.doc_id = y.doc_id AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    f AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
    m AS (SELECT doc_id, q, min(i) AS s, max(i) + 5 + q - min(i) AS l FROM f GROUP BY doc_id, q, island HAVING max(i) + 5 + q - min(i) >= greatest(6, 4 * q)),
    r AS (SELECT doc_id, s, l, min(q) AS q FROM m GROUP BY doc_id, s, l),
    best AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
                    first(struct_pack(s := s, l := l, q := q) ORDER BY l DESC, s, q) AS top FROM r GROUP BY doc_id),
    x AS (SELECT doc_id, unnest(range(s + q, s + l)) AS i FROM r),
    kept AS (SELECT v.doc_id, string_agg(word, ' ' ORDER BY v.i) AS t FROM v ANTI JOIN x ON v.doc_id = x.doc_id AND v.i = x.i GROUP BY v.doc_id)
    SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.l AS length, top.q AS period, 1000 * top.l // top.q AS exponent_milli,
           sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
    FROM documents d LEFT JOIN best ON best.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
