"""N-gram Jaccard join by a size-aware heavy-light split; components of the linked documents.

A document's set is its distinct k-word shingles (A-Z lower-cased, words split at ASCII white space; a text of
fewer words is one shingle). Two sets of sizes a <= b are linked at 100 * intersection >= percent * union, that is
at an overlap of ``needed(a, b) = ceil(percent * (a + b) / (100 + percent))`` or more. Equal sets are one *node*.

* **Light sets** (size up to a boundary) enumerate fixed-size subsets: for every partner size b each set gives all
  its subsets of ``needed(a, b)`` members. Two light sets are linked exactly if they share such a subset, so a
  subset's holders are linked with its least holder of either size and nothing has to be verified.
* **Heavy sets** scan inverted lists. Shingles have one global order, rare ones first (counted over the sets of one
  node in ``SAMPLE``; the order decides the cost, never the result). The smaller set of a linked pair has a shared
  shingle among its first ``a - needed(a, a) + 1`` (the *listed* ones), the larger among its first
  ``b - needed(ceil(percent * b / 100), b) + 1`` (the *scanned* ones).
* **The boundary** between them is the one of least cost: rows of subsets against rows listed and scanned (times the
  mean length of a list) and members to verify, from the histogram of set sizes.

No list is expanded to all pairs. Every node is first compared with the two pivots that it meets most often
(of every list: the holder with the fewest rarer shingles). Then, in lists that still hold several components, the members outside the list's largest
component are compared with those of other components; two members of different components can't both belong to the
largest, so no link between components is lost, while the many members of a group of near copies aren't paired.
A pair must share as many of the first shingles as its overlap implies before full sets are compared.

Cases: a null or empty text and a text without words have an empty set and no links; a row with a null id takes part
like any other, its component is the smallest id that is not null; repeated rows are returned as often as they come
in and share a component; an empty table gives an empty result. Other columns of the input are ignored. Shingles and
nodes are 64- and 128-bit hashes, subsets 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from lineweave.llm import textops as T
from lineweave.llm.components import connected_components, merged_roots
from lineweave.llm.tables import HashFilter, cut, prepare, read_table
from lineweave.llm.touched import filtered, key_filter, row_key

SHINGLE, PERCENT = 5, 80
#: Largest boundary that is considered: the subsets of larger sets outgrow any list.
LIGHT_MOST = 16
#: One node in so many has its shingles counted; counts in that sample from which a shingle is one level more frequent.
SAMPLE, LEVELS = 8, (2, 16, 128)
#: Pivots that a node is compared with first.
PIVOTS = 2


def needed(a, b, percent: int):
    """Least overlap of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def _least_partner(n, percent: int):
    return -(-percent * n // 100)


def listed(n, percent: int):
    """How many of its first shingles a set is listed under (as the smaller of a pair)."""
    return n - needed(n, n, percent) + 1


def scanned(n, percent: int):
    """How many of its first shingles a set scans the lists of (as the larger of a pair)."""
    return n - needed(_least_partner(n, percent), n, percent) + 1


def subset_sizes(n: int, most: int, percent: int) -> list[tuple[int, int]]:
    """(partner size, subset size) for the light partners of a set of ``n``; equal sizes that need all
    members are equal sets, which are one node."""
    sizes = [(b, needed(n, b, percent)) for b in range(_least_partner(n, percent), min(100 * n // percent, most) + 1)]
    return [(b, o) for b, o in sizes if o <= min(n, b) and not (b == n and o == n)]


@lru_cache(maxsize=None)
def _left_out(n: int, o: int) -> np.ndarray:
    """The members that each subset of size ``o`` leaves out, one row a subset."""
    rows = list(combinations(range(n), n - o))
    return np.array(rows, np.int64).reshape(len(rows), n - o)


def light_rows(n: int, most: int, percent: int) -> int:
    return sum(comb(n, o) for _, o in subset_sizes(n, most, percent))


def boundary(histogram: dict[int, int], members: int, scan: float, percent: int) -> int:
    """Size up to which sets are light: least cost in rows. ``histogram`` counts the nodes of each size up to the
    largest partner of a light set; ``members`` are those of all larger ones; ``scan`` is the mean length of a list."""
    costs = []
    for most in range(LIGHT_MOST + 1):
        light = sum(c * light_rows(n, most, percent) for n, c in histogram.items() if n <= most)
        heavy = sum(c * (scanned(n, percent) * scan + n) for n, c in histogram.items() if n > most)
        heavy += sum(c * listed(n, percent) for n, c in histogram.items() if _least_partner(most + 1, percent) <= n <= most)
        costs.append(light + heavy + members)
    return int(np.argmin(costs))


#: The first eight bytes of a node as a long.
_HEAD = "cast(conv(hex(substring(node, 1, 8)), 16, -10) as bigint)"


def _head(ids: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(i[:8] for i in ids), ">u8").astype(T.U64)


def _node_ids(h: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """128 bits of each set: two sums over differently mixed members, mixed with the size."""
    n = sizes.astype(T.U64)
    x, y = (T.mix(np.add.reduceat(T.mix(h * c), first) + n * c) for c in T.constants(2, 1101))
    return [row.tobytes() for row in np.stack([x, y], axis=1).astype(">u8")]


class _Sets:
    """The non-empty sets of a slice of texts."""

    def __init__(self, texts: list[bytes]):
        words = T.hash_words(texts)
        self.h, run = T.distinct_per_row(*T.shingle_hashes(words, SHINGLE), len(texts))
        self.sizes = np.diff(run)
        self.rows = np.flatnonzero(self.sizes)
        self.first, self.n = run[:-1][self.rows], self.sizes[self.rows]
        self.nodes = _node_ids(self.h, self.first, self.n) if len(self.rows) else []

    def members(self, i: int) -> np.ndarray:
        return self.h[self.first[i] : self.first[i] + self.n[i]]


def _classify(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    """doc_id, key, node, n, and the members of sets that are small or in the sample."""
    sets = _Sets(texts)
    node: list[bytes | None] = [None] * len(texts)
    few: list[bytes | None] = [None] * len(texts)
    if len(sets.rows):
        shown = (_head(sets.nodes) % T.U64(SAMPLE) == 0) | (sets.n <= LIGHT_MOST)
        for i, row in enumerate(sets.rows):
            node[row] = sets.nodes[i]
            if shown[i]:
                few[row] = sets.members(i).tobytes()
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(node, pa.binary()), pa.array(sets.sizes, pa.int64()), pa.array(few, pa.binary())], names=["doc_id", "key", "node", "n", "few"]
    )


def _longs(name: str):
    """One row for every 8-byte value of a binary column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values)], names=[name])

    return run


def _sized_filter(table: DataFrame, column: str) -> HashFilter:
    return HashFilter.of(table, column, bits=filter_bits(table.count()))


def filter_bits(rows: int) -> int:
    """Size of a bitmap (as a power of two) of sixteen bits a row or more, 8 MB at most."""
    return min(26, max(16, rows.bit_length() + 4))


def _levels(few: DataFrame) -> tuple[list[HashFilter], float]:
    """Filters of the frequent shingles, one a level, and the mean length of a list, from the sampled sets."""
    met = Observation()
    counts = few.where(f"pmod({_HEAD}, {SAMPLE}) = 0").select("few").mapInArrow(_longs("h"), "h long").groupBy("h").agg(F.count("*").alias("c"))
    counts = cut(counts.observe(met, F.count("*").alias("shingles"), F.sum("c").alias("places")).where(f"c >= {LEVELS[0]}"), "join-frequent")
    seen = met.get
    return [_sized_filter(counts.where(f"c >= {c}"), "h") for c in LEVELS], (seen["places"] or 0) / max(1, seen["shingles"])


def _firsts(levels: list[HashFilter], most: int, percent: int):
    """(node, n, keys): the first shingles of every heavy set, and of light ones that have heavy partners."""

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch | None:
        sets = _Sets(texts)
        wanted = np.flatnonzero(sets.n >= _least_partner(most + 1, percent))
        if not len(wanted):
            return None
        level = sum(f.maybe(sets.h).astype(np.int64) for f in levels)
        doc = np.repeat(np.arange(len(sets.n)), sets.n)
        # Members of a set are in the order of their hashes already.
        h = sets.h[np.argsort(doc * (len(LEVELS) + 1) + level, kind="stable")]
        n = sets.n[wanted]
        size = np.where(n > most, scanned(n, percent), listed(n, percent))
        keys = T.binary_column(h[a : a + k] for a, k in zip(sets.first[wanted], size))
        return pa.RecordBatch.from_arrays([pa.array([sets.nodes[i] for i in wanted], pa.binary()), pa.array(n), keys], names=["node", "n", "keys"])

    return T.map_slices("text", work)


def _postings(shared: HashFilter, percent: int):
    """(key, node, n, is_listed, place, rank) of the shingles that other nodes have among their first ones too:
    the place among all first shingles and among those that are given here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(k, T.U64) for k in batch.column(2).to_pylist()]
            if not lists:
                continue
            size = np.array([len(k) for k in lists])
            keys, row = np.concatenate(lists), np.repeat(np.arange(len(lists)), size)
            place = np.arange(len(keys)) - np.repeat(np.cumsum(size) - size, size)
            n = batch.column(1).to_numpy()[row]
            at = np.flatnonzero(shared.maybe(keys))
            own = row[at]
            rank = np.arange(len(at)) - np.searchsorted(own, own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(T.signed(keys[at])), batch.column(0).take(pa.array(own)), pa.array(n[at]), pa.array((place < listed(n, percent))[at]), pa.array(place[at].astype(np.int32)), pa.array(rank.astype(np.int32))],
                names=["key", "node", "n", "is_listed", "place", "rank"],
            )

    return run


_POSTING = "key long, node binary, n long, is_listed boolean, place int, rank int"


def _may_overlap(most: int, percent: int) -> str:
    """Condition on two members of a list (n, place, rank and m, place_, rank_), not both light: their sizes fit, and
    what both have before the shingle (given in both lists) and behind it can reach the needed overlap."""
    enough = f"least(rank, rank_) + 1 + least(n - place - 1, m - place_ - 1) >= ({percent} * (n + m) + {99 + percent}) div {100 + percent}"
    return f"greatest(n, m) > {most} and 100 * least(n, m) >= {percent} * greatest(n, m) and {enough}"


def _subsets(most: int, percent: int):
    """(x, y, is_small, is_large, node): the subsets of light sets under 128 bits of them and of the two sizes."""
    c = T.constants(4, 1301)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = batch.column(0), batch.column(1).to_pylist()
            size = np.array([len(s) // 8 for s in sets], np.int64)
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                members = np.frombuffer(b"".join(sets[i] for i in at), T.U64).reshape(len(at), n)
                for b, o in subset_sizes(int(n), most, percent):
                    left = _left_out(int(n), o)
                    pair = (np.array(sorted((n, b)), T.U64) * c[2:]).sum(dtype=T.U64)
                    both = []
                    for factor in c[:2]:
                        mixed = T.mix(members * factor)
                        both.append(T.mix(mixed.sum(axis=1, dtype=T.U64)[:, None] - mixed[:, left].sum(axis=2, dtype=T.U64) + pair).ravel())
                    owner = pa.array(np.repeat(at, len(left)))
                    flags = [pa.array(np.full(len(owner), f)) for f in (n <= b, n >= b)]
                    yield pa.RecordBatch.from_arrays([*(pa.array(T.signed(h)) for h in both), *flags, nodes.take(owner)], names=["x", "y", "is_small", "is_large", "node"])

    return run


def _light_links(few: DataFrame, most: int, percent: int) -> DataFrame:
    """Links that join all light sets which share a subset."""
    light = few.where(f"length(few) <= {8 * most}").select("node", "few")
    rows = cut(light.mapInArrow(_subsets(most, percent), "x long, y long, is_small boolean, is_large boolean, node binary"), "join-subsets")
    least = lambda flag: F.min(F.when(F.col(flag), F.col("node")))
    holders = rows.groupBy("x", "y").agg(least("is_small").alias("small"), least("is_large").alias("large"), F.count("*").alias("n"))
    # Both sides of the join are tables, so that a subset that very many sets hold is split.
    holders = cut(holders.where("n > 1 and small is not null and large is not null").drop("n"), "join-holders")
    met = rows.join(holders, ["x", "y"])
    links = met.where("is_small").select("node", F.col("large").alias("other")).union(met.where("is_large").select("node", F.col("small").alias("other")))
    return links.where("node <> other").select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct()


def _shared_firsts(x: bytes, y: bytes) -> int:
    return len(np.intersect1d(np.frombuffer(x, T.U64), np.frombuffer(y, T.U64), assume_unique=True))


def _may_link(most: int, percent: int):
    """Pairs (a, b) whose first shingles (x, y) agree often enough: what is not shared among the first ones lies
    behind those of one of the two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            x, y = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            rest = np.maximum(n - [len(k) // 8 for k in x], m - [len(k) // 8 for k in y])
            common = np.array([_shared_firsts(p, q) for p, q in zip(x, y)], np.int64)
            yield batch.select([0, 1]).filter(pa.array(common + rest >= needed(n, m, percent)))

    return run


def _sets_of(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    """(node, members) of documents."""
    sets = _Sets(texts)
    return pa.RecordBatch.from_arrays([pa.array(sets.nodes, pa.binary()), T.binary_column(sets.members(i) for i in range(len(sets.nodes)))], names=["node", "members"])


def _overlapping(percent: int):
    """Pairs whose full sets (x, y) overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), T.U64), np.frombuffer(y.as_buffer(), T.U64)
                shared = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
                keep.append(shared >= needed(len(p), len(q), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _with_sides(pairs: DataFrame, table: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``pairs`` (a, b) with columns of ``table`` for both nodes: named after the side."""
    for side in "ab":
        pairs = pairs.join(table.select(F.col("node").alias(side), *[F.col(c).alias(f"{to}_{side}") for c, to in columns.items()]), side)
    return pairs


def _linked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are linked; the sets come from one text of each node."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    ends = cut(ends.join(nodes.select("node", "key"), "node"), "join-wanted")
    texts = filtered(docs.select("key", "text"), "key", key_filter(ends, "key", filter_bits(ends.count())), True)
    sets = texts.mapInArrow(T.map_slices("text", _sets_of), "node binary, members binary").join(ends, "node", "left_semi")
    sets = cut(sets.groupBy("node").agg(F.first("members").alias("members")), "join-sets")
    both = _with_sides(pairs, sets, {"members": "s"}).select("a", "b", "s_a", "s_b")
    return cut(both.mapInArrow(_overlapping(percent), "a binary, b binary"), "join-links")


def _pivot_pairs(postings: DataFrame, most: int, percent: int) -> DataFrame:
    """Every node with the pivots that it meets in the most lists."""
    # The holder with the fewest rarer shingles stands in the middle of a group of near copies.
    least = F.min(F.struct("place", "n", "node", "rank")).alias("pivot")
    pivot = cut(postings.where("is_listed").groupBy("key").agg(least), "join-pivots")
    pivot = pivot.select("key", F.col("pivot.node").alias("other"), F.col("pivot.n").alias("m"), F.col("pivot.place").alias("place_"), F.col("pivot.rank").alias("rank_"))
    met = postings.join(pivot, "key").where(f"node <> other and {_may_overlap(most, percent)}")
    often = met.groupBy("node", "other").agg(F.count("*").alias("c"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("c"), "other"))
    best = often.select("node", "other", place.alias("place")).where(f"place <= {PIVOTS}")
    return best.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct()


def _open_pairs(postings: DataFrame, roots: DataFrame, tested: DataFrame, most: int, percent: int) -> DataFrame:
    """Pairs of different components that meet in a list, at least one outside the list's largest component, and
    share enough of their first shingles."""
    placed = cut(postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "join-placed")
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("size"), F.max("is_listed").alias("is_listed"))
    lists = sizes.groupBy("key").agg(F.max(F.struct("size", "root")).alias("main"), F.count("*").alias("roots"), F.max("is_listed").alias("is_listed"))
    lists = cut(lists.where("roots > 1 and is_listed").select("key", F.col("main.root").alias("main")), "join-open")
    left = cut(placed.join(lists, "key").drop("is_listed"), "join-members")
    minor = left.where("root <> main").select("key", F.col("node").alias("other"), F.col("n").alias("m"), F.col("root").alias("own"), F.col("place").alias("place_"), F.col("rank").alias("rank_"))
    met = left.join(minor, "key").where(f"root <> own and {_may_overlap(most, percent)}")
    # Two members outside the largest component meet twice, once from either side.
    met = met.where("root = main or node < other")
    pairs = met.groupBy(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).agg(F.min(F.least("n", "m")).alias("n"), F.max(F.greatest("n", "m")).alias("m"), F.count("*").alias("c"))
    rest = lambda c: F.when(F.col(c) > most, F.col(c) - _column(scanned, c, percent)).otherwise(F.col(c) - _column(listed, c, percent))
    enough = F.col("c") + F.greatest(rest("n"), rest("m")) >= F.expr(f"({percent} * (n + m) + {99 + percent}) div {100 + percent}")
    return pairs.where(enough).select("a", "b").join(tested, ["a", "b"], "left_anti")


def _column(rule, name: str, percent: int):
    """:func:`listed` or :func:`scanned` of a long column."""
    ceil = lambda x, y: f"(({x}) + {y - 1}) div {y}"
    low = name if rule is listed else ceil(f"{percent} * {name}", 100)
    return F.expr(f"{name} - ({ceil(f'{percent} * ({low} + {name})', 100 + percent)}) + 1")


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (the smallest doc_id reachable
    over links, itself included)."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), F.col("text").cast("string").alias("text"))
    rows = cut(docs.mapInArrow(T.map_slices("text", _classify), "doc_id long, key long, node binary, n long, few binary"), "join-rows")
    # ``key`` names one of a node's texts.
    nodes = cut(rows.where("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.min("doc_id").alias("low"), F.min("key").alias("key")), "join-nodes")
    few = cut(rows.where("few is not null").groupBy("node").agg(F.first("few").alias("few")), "join-few")
    levels, scan = _levels(few)
    top = 100 * LIGHT_MOST // percent + 1
    sizes = {r["size"]: r for r in nodes.groupBy(F.least("n", F.lit(top)).alias("size")).agg(F.count("*").alias("c"), F.sum("n").alias("members")).collect()}
    most = boundary({n: r["c"] for n, r in sizes.items() if n < top}, sizes[top]["members"] if top in sizes else 0, scan, percent)

    firsts = docs.select("text").mapInArrow(_firsts(levels, most, percent), "node binary, n long, keys binary")
    firsts = cut(firsts.groupBy("node").agg(F.first("n").alias("n"), F.first("keys").alias("keys")), "join-firsts")
    shared = firsts.select("keys").mapInArrow(_longs("key"), "key long").groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    shared = _sized_filter(cut(shared.select("key"), "join-shared"), "key")
    postings = cut(firsts.select("node", "n", "keys").mapInArrow(_postings(shared, percent), _POSTING), "join-postings")

    met = cut(_pivot_pairs(postings, most, percent), "join-pairs")
    likely = _with_sides(met, firsts, {"n": "n", "keys": "k"}).select("a", "b", "n_a", "n_b", "k_a", "k_b")
    likely = cut(likely.mapInArrow(_may_link(most, percent), "a binary, b binary"), "join-likely")
    links = _linked(likely, docs, nodes, percent).union(_light_links(few, most, percent))
    roots = cut(connected_components(links), "join-roots")
    more = cut(_open_pairs(postings, roots, met, most, percent), "join-pairs")
    if not more.isEmpty():
        found = _linked(more, docs, nodes, percent)
        if not found.isEmpty():
            roots = cut(merged_roots(roots, found), "join-roots")

    placed = cut(nodes.select("node", "low").join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root")), "join-placed")
    lowest = cut(placed.groupBy("root").agg(F.min("low").alias("component_id")), "join-lowest")
    by_node = cut(placed.join(lowest, "root").select("node", "component_id"), "join-classes")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.drop("few", "key").join(by_node, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op11_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def components_sql(percent: int) -> str:
    """DuckDB SQL: doc_id, n_shingles and component_id of ``documents``, all pairs with a shingle in common compared."""
    return f"""
    WITH RECURSIVE w AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS ws FROM documents),
    s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) < {SHINGLE} THEN [array_to_string(ws, ' ')]
                 ELSE [array_to_string(ws[i:i + {SHINGLE - 1}], ' ') FOR i IN range(1, len(ws) - {SHINGLE - 2})] END)) AS shingle FROM w WHERE len(ws) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    l AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
          JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
          GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= {percent} * (p.n + q.n - count(*))),
    r AS (SELECT doc_id AS node, doc_id AS low FROM documents UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.node WHERE r.low < l.b)
    SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.low) AS component_id
    FROM documents d JOIN r ON r.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
    """


OP11_SQL = components_sql(PERCENT)
