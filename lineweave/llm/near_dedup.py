"""Near-duplicate documents by SetSketch registers, verified on full shingle sets.

A document's set is its distinct k-word shingles (A-Z lower-cased, words split at ASCII white
space). Documents with equal sets form one *node*, so a group of copies is one row from here on.

1. **Sketch.** Register i of a set holds ``floor(1 - log_b(x_i))``, clipped to 16 bits, where
   ``x_i`` is the smallest of the members' exponentially distributed hashes. Two sets' registers
   merge by maximum, and equal registers become likelier with the Jaccard similarity.
2. **Bands.** Groups of registers are hashed; nodes that agree on a band meet in a bucket. At
   similarity 0.85 a pair misses all 28 bands of 5 registers with probability 7e-8.
3. **Pivots.** No bucket is expanded to all its pairs. Four members become pivots and the others are
   compared with them. Then the members that lie outside their bucket's largest component are pivots
   too, compared with the members of other components in blocks of bounded size. Two members of
   different components can't both belong to the largest, so no link between components is left
   untested, while the members of the largest, of whom there may be very many, are never paired.
4. **Likelihood.** With exact set sizes, the counts of larger, smaller and equal registers give the
   likelihood of every similarity; a pair is dropped when the threshold is less likely than the best
   value by more than 18 log units (6 standard deviations).
5. **Verification.** The remaining pairs are intersected on full sets of 64-bit shingle hashes.

Cases: a null or empty text and a text without words have an empty set and no links; a row with a
null id takes part like any other, its component is the smallest id that is not null; repeated rows
are returned as often as they come in and share a component; an empty table gives an empty result.
Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.llm import textops as T
from lineweave.llm.components import connected_components, merged_roots
from lineweave.llm.tables import HashFilter, cut, fold_id, prepare, read_table
from lineweave.llm.touched import KeyCells, fresh_name, with_key, without

SHINGLE = 5
#: Registers: base, rate of the exponential hashes, largest value.
BASE, RATE, TOP = 1.001, 20.0, 65_535
BANDS, BAND_ROWS = 28, 5
REGISTERS = BANDS * BAND_ROWS
#: Members of a bucket that become pivots first; later pivots and members that meet in one task.
PIVOTS, BLOCK, PART = 4, 128, 256
#: Log-likelihood by which the threshold may fall short of the best similarity.
SLACK = 18.0

_SKETCH = "doc_id long, text_hash long, node binary, n_shingles long, sketch binary"


def registers(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SetSketch registers (rows x REGISTERS, uint16) of the runs of ``h`` that start at ``first``."""
    out = np.empty((len(first), REGISTERS), np.uint16)
    for i, factor in enumerate(T.constants(REGISTERS, 5)):
        low = np.minimum.reduceat(h * factor, first)
        x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / RATE
        out[:, i] = np.clip(np.floor(1.0 - np.log(x) / np.log(BASE)), 0, TOP)
    return out


def _node_ids(h: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """128 bits of each set: two sums over differently mixed members, and the size."""
    n = sizes.astype(T.U64)
    a = T.mix(np.add.reduceat(T.mix(h ^ T.U64(0x5DEECE66D)), first) + n)
    b = T.mix(np.add.reduceat(T.mix(h + T.U64(0x9E3779B97F4A7C15)), first) ^ (n << T.U64(32)))
    both = np.stack([a, b], axis=1).astype(">u8")
    return [row.tobytes() for row in both]


def _sets(texts: list[bytes]):
    """Distinct shingle hashes of the slice, their starts for non-empty sets, those rows, all sizes."""
    words = T.hash_words(texts)
    h, run = T.distinct_per_row(*T.shingle_hashes(words, SHINGLE), len(texts))
    sizes = np.diff(run)
    rows = np.flatnonzero(sizes)
    return h, run[:-1][rows], rows, sizes


def _sketch(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    h, first, rows, sizes = _sets(texts)
    node: list[bytes | None] = [None] * len(texts)
    sketch: list[bytes | None] = [None] * len(texts)
    if len(rows):
        ids, regs = _node_ids(h, first, sizes[rows]), registers(h, first)
        for at, i, r in zip(rows, ids, regs):
            node[at], sketch[at] = i, r.tobytes()
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(2), pa.array(node, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sketch, pa.binary())],
        names=["doc_id", "text_hash", "node", "n_shingles", "sketch"],
    )


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash"))


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    c = T.constants(BAND_ROWS + 1, 31)
    for batch in batches:
        nodes = batch.column(0)
        regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, BANDS, BAND_ROWS).astype(T.U64)
        if not len(regs):
            continue
        keys = np.arange(1, BANDS + 1, dtype=T.U64) * c[BAND_ROWS] + (regs * c[:BAND_ROWS]).sum(axis=2, dtype=T.U64)
        at = np.repeat(np.arange(len(regs)), BANDS)
        numbers = np.tile(np.arange(BANDS, dtype=np.int32), len(regs))
        yield pa.RecordBatch.from_arrays([pa.array(T.signed(T.mix(keys)).ravel()), pa.array(numbers), nodes.take(pa.array(at))], names=["band", "band_no", "node"])


def log_likelihood(j: np.ndarray, u: np.ndarray, v: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-likelihood of similarity ``j`` given relative sizes u, v (u + v = 1) and the numbers of
    registers that are larger, smaller and equal in the first set."""

    def p(x):
        return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1) / BASE) / np.log(BASE)

    more, less = p(u - v * j), p(v - u * j)
    parts = np.stack([more, less, 1.0 - more - less])
    return (counts * np.log(np.clip(parts, 1e-12, 1.0))).sum(axis=0)


def _not_ruled_out(n: np.ndarray, m: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets with sizes n, m and register counts may reach the threshold."""
    u, v = n / (n + m), m / (n + m)
    most = np.minimum(u / v, v / u)
    best, at_threshold = np.full(len(n), -np.inf), np.full(len(n), -np.inf)
    for j in (*np.linspace(0.0, 1.0, 51), threshold):
        here = np.where(j <= most + 1e-9, log_likelihood(np.minimum(j, most), u, v, counts), -np.inf)
        best = np.maximum(best, here)
        if j >= threshold:
            at_threshold = np.maximum(at_threshold, here)
    return (most >= threshold - 1e-9) & (at_threshold >= best - SLACK)


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _plausible(threshold: float):
    """Keeps pairs for which a similarity of ``threshold`` or more is not ruled out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = _sketches(batch.column(4)), _sketches(batch.column(5))
                n, m = (batch.column(i).to_numpy().astype(float) for i in (2, 3))
                counts = np.stack([(a > b).sum(axis=1), (a < b).sum(axis=1), (a == b).sum(axis=1)]).astype(float)
                yield batch.select([0, 1]).filter(pa.array(_not_ruled_out(n, m, counts, threshold)))

    return run


def _member_sets(wanted: HashFilter):
    """(node, set) of the documents whose node passes the filter."""

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch | None:
        h, first, rows, sizes = _sets(texts)
        if not len(rows):
            return None
        ids = _node_ids(h, first, sizes[rows])
        head = np.frombuffer(b"".join(i[:8] for i in ids), ">u8").astype(T.U64)
        hit = np.flatnonzero(wanted.maybe(head))
        if not len(hit):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i in hit], pa.binary()), T.binary_column(h[first[i] : first[i] + sizes[rows[i]]] for i in hit)], names=["node", "members"]
        )

    return T.map_slices("text", work)


def _are_linked(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union for two sorted sets."""
    shared = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
    return 100 * shared >= percent * (len(p) + len(q) - shared)


def _linked(percent: int):
    """Pairs whose full sets are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2), batch.column(3))
            keep = [_are_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in both]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _links_of_block(percent: int):
    """For cogrouped members and pivots of one part of a bucket: a link from every pivot to every
    other component in which it has one. A pair is looked at in the first band that it shares only."""

    def run(members: pa.Table, pivots: pa.Table) -> pa.Table:
        out: list[tuple[bytes, bytes]] = []
        if members.num_rows and pivots.num_rows:
            (nodes, sets), (p_nodes, p_sets) = ([t.column(c).to_pylist() for c in ("node", "members")] for t in (members, pivots))
            roots = pa.chunked_array([*members.column("root").chunks, *pivots.column("root").chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
            roots, p_roots = roots[: len(nodes)], roots[len(nodes) :]
            a, b = _sketches(pivots.column("sketch")), _sketches(members.column("sketch"))
            band, first, second, counts = members.column("band_no")[0].as_py(), [], [], []
            for i, own in enumerate(a):
                equal = own == b
                agree = equal.reshape(-1, BANDS, BAND_ROWS).all(axis=2)
                at = np.flatnonzero((np.argmax(agree, axis=1) == band) & (roots != p_roots[i]))
                first.append(np.full(len(at), i))
                second.append(at)
                counts.append(np.stack([(own > b[at]).sum(axis=1), (own < b[at]).sum(axis=1), equal[at].sum(axis=1)]))
            first, second, counts = np.concatenate(first), np.concatenate(second), np.concatenate(counts, axis=1).astype(float)
            n, m = (np.array([len(x) // 8 for x in both], float) for both in (p_sets, sets))
            likely = np.flatnonzero(_not_ruled_out(n[first], m[second], counts, percent / 100))
            done: set[tuple[int, int]] = set()
            for at in likely[np.argsort(-counts[2, likely], kind="stable")]:
                i, j = first[at], second[at]
                if (i, roots[j]) not in done and _are_linked(np.frombuffer(p_sets[i], np.uint64), np.frombuffer(sets[j], np.uint64), percent):
                    done.add((i, roots[j]))
                    out.append((max(p_nodes[i], nodes[j]), min(p_nodes[i], nodes[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    return run


def _across(open_: DataFrame, tested: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the members outside the largest component of their bucket and those of other
    components. ``minors`` bounds the number of the former, so blocks of both have a bounded size."""
    whole = open_.join(nodes.select("node", "sketch"), "node").join(sets, "node")
    whole = whole.withColumn("parts", F.expr(f"int(ceil(n / {PART}))")).withColumn("blocks", F.expr(f"int(ceil(minors / {BLOCK}))"))
    columns = ["band", "part", "block", "band_no", "node", "root", "sketch", "members"]
    members = whole.withColumn("part", F.expr("pmod(hash(node), parts)")).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).select(*columns)
    drawn = whole.where("root <> main").join(tested.withColumnRenamed("pivot", "node"), ["band", "node"], "left_anti")
    drawn = drawn.withColumn("block", F.expr("pmod(hash(node), blocks)")).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).select(*columns).toDF(*columns)
    place = ["band", "part", "block"]
    return cut(members.groupBy(*place).cogroup(drawn.groupBy(*place)).applyInArrow(_links_of_block(percent), "a binary, b binary").distinct(), "near-links")


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) that sizes and sketches don't rule out."""
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("sketch").alias(f"s_{s}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    return cut(rows.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(_plausible(percent / 100), "a binary, b binary"), "near-pairs")


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, members) of the wanted nodes, from one more pass over the texts."""
    maybe = HashFilter.of(wanted.select(_head("node").alias("h")), "h")
    sets = docs.select("text").mapInArrow(_member_sets(maybe), "node binary, members binary")
    return cut(sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("members").alias("members")), "near-sets")


def _verified(likely: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    full = likely.join(sets.select(F.col("node").alias("a"), F.col("members").alias("x")), "a")
    full = full.join(sets.select(F.col("node").alias("b"), F.col("members").alias("y")), "b")
    return cut(full.select("a", "b", "x", "y").mapInArrow(_linked(percent), "a binary, b binary"), "near-links")


def _head(column: str):
    """The first eight bytes of a binary as a long."""
    return F.conv(F.hex(F.substring(column, 1, 8)), 16, -10).cast("long")


def _salted_first(members: DataFrame, most: int) -> DataFrame:
    """The first ``most`` nodes of every bucket; a hot bucket is thinned in 64 parts beforehand."""
    ranked = F.expr(f"row_number() over (partition by band, part order by node) <= {most}")
    some = members.withColumn("part", F.pmod(F.hash("node"), F.lit(64))).select("band", "node", "part", ranked.alias("ok")).where("ok")
    last = F.expr(f"row_number() over (partition by band order by node) <= {most}")
    return some.select("band", "node", last.alias("ok")).where("ok").select("band", F.col("node").alias("pivot"))


def _pairs(members: DataFrame, pivots: DataFrame) -> DataFrame:
    met = members.join(pivots, "band").where("node <> pivot")
    return met.select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")).distinct()


def near_duplicate_components(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_hash, group, n_shingles, component_id, kept.

    Rows are linked when 100 * |intersection| >= percent * |union| of their shingle sets;
    group names the component (null for an empty set), component_id is the smallest doc_id reachable
    over links, kept is doc_id = component_id.
    """
    prepare(docs.sparkSession)
    docs = _documents(docs)
    rows = cut(docs.mapInArrow(T.map_slices("text", _sketch), _SKETCH), "near-sketch")
    # Equal nodes have equal sketches; a class is one row before anything is compared.
    nodes = cut(rows.where("node is not null").groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("low")), "near-nodes")
    bands = nodes.select("node", "sketch").mapInArrow(_band_rows, "band long, band_no int, node binary")
    crowded = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = cut(bands.join(crowded, "band"), "near-buckets")

    likely = _likely(_pairs(members.select("band", "node"), _salted_first(members, PIVOTS)), nodes, percent)
    # Buckets that the first pivots have not compared completely; their members may be needed later.
    large = members.where(f"n > {PIVOTS + 1}")
    ends = likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).union(large.select("node"))
    sets = _full_sets(docs, cut(ends.distinct(), "near-wanted"))
    links = _verified(likely, sets, percent)
    roots = cut(connected_components(links), "near-roots")
    placed = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = placed.groupBy("band", "root").agg(F.count("*").alias("size"))
    main = sizes.groupBy("band").agg(F.max(F.struct("size", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    open_ = cut(placed.join(main.select("band", F.col("main.root").alias("main"), F.col("main.size").alias("size")), "band").withColumn("minors", F.col("n") - F.col("size")).drop("size"), "near-open")
    found = _across(open_, _salted_first(large, PIVOTS), nodes, sets, percent)
    if not found.isEmpty():
        roots = cut(merged_roots(roots, found), "near-roots")

    # Both sides of the joins on a component are tables, so that a component of very many nodes is split.
    placed = cut(nodes.select("node", "low").join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root")), "near-placed")
    lowest = cut(placed.groupBy("root").agg(F.min("low").alias("component_id")), "near-lowest")
    by_node = cut(placed.join(lowest, "root").select("node", "component_id", F.col("root").alias("group")), "near-classes")
    joined = rows.drop("sketch").join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "text_hash", "group", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every group of near duplicates: the smallest id (then text hash), once
    even if the row repeats. Rows without words stay. Same columns."""
    found = near_duplicate_components(docs, percent).where("group is not null")
    found = found.select("group", "doc_id", "component_id", "text_hash", F.xxhash64(fold_id("doc_id"), "text_hash").alias("key"))
    by_key = cut(found.groupBy("group", "doc_id", "component_id", "text_hash", "key").agg(F.count("*").alias("n")), "near-keys")
    # All rows but those with the component's smallest id go without a look at the others.
    low = by_key.where("doc_id <=> component_id")
    best = cut(low.groupBy("group").agg(F.min(F.struct("text_hash", "key", "n")).alias("best"), F.count("*").alias("keys")), "near-best")
    # More than one text under that id: the first by its hash stays.
    tied = low.join(best.where("keys > 1"), "group").where("key <> best.key").select("key")
    removed = by_key.where("not (doc_id <=> component_id)").select("key").union(tied)
    repeated = cut(best.where("best.n > 1").select("best.key"), "near-repeated")
    out = without(docs, cut(removed.union(repeated), "near-removed"))
    key = fresh_name(docs, "_key")
    again = KeyCells.of(repeated, "key").split(with_key(docs, key), key, True).join(repeated.select(F.col("key").alias(key)), key, "left_semi")
    return out.unionByName(again.dropDuplicates([key]).drop(key))


def op3_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_components(read_table(spark, sf_dir, "documents")).drop("text_hash", "group")
