"""Fill-in-the-middle transformation as a pipeline of pyarrow.compute kernels.

Each text is cut into units (code points, words or lines), two cuts split the units into prefix, middle
and suffix, and the pieces are put in another order behind sentinels, so that a model learns to fill a
gap. Per slice of texts:

1. the units become a list array, one list a text (a text over ``BLOCK_BYTES`` is several lists, cut
   between units, so that memory doesn't grow with a text's length);
2. the lists are flattened with their parent indices, and a unit's ordinal is its place in the flat
   array less its list's first place, plus the units of its text's earlier blocks;
3. for every role the units whose ordinals lie between the role's bounds are filtered, lists are rebuilt
   from the parent indices that are left, and ``binary_join`` turns them into the role's pieces;
4. pieces of one text are joined over its blocks, then with the sentinels, element by element.

Where the cuts lie and which form a text takes follow from a sha256 over a seed and the document's id,
so a task that runs again gives the same rows.

Cases: a null text is an empty one, and an empty text is plain; a text that holds a sentinel is plain, so
that every output can be turned back (:func:`restored`); a null id is hashed as no digits; repeated rows and
ties each give their row; an empty table gives an empty result; other columns pass, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lineweave.llm import textops as T
from lineweave.llm.tables import prepare, read_table
from lineweave.llm.touched import fresh_name

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT, SPM_PERCENT, SEED = 10, 20, 1
#: Bytes of a text that become one list of units.
BLOCK_BYTES = 1 << 20

FIELDS = "n_units long, form string, prefix_units long, middle_units long, output string"


def unit_starts(buf: np.ndarray, unit: str) -> np.ndarray:
    """Which bytes of a UTF-8 text begin a unit; the first byte always does. A line keeps its line feed, a
    word the white space behind it; white space before the first word is a unit of its own."""
    if unit == "char":
        return (buf & 0xC0) != 0x80
    starts = np.ones(len(buf), bool)
    if unit == "line":
        starts[1:] = buf[:-1] == 0x0A
    elif unit == "word":
        white = T.WHITE[buf]
        starts[1:] = white[:-1] & ~white[1:]
    else:
        raise ValueError(f"unit must be char, word or line, not {unit!r}")
    return starts


#: What ends right before a unit's first byte, to be looked for from one byte before a place.
_ENDS = {"char": re.compile(rb"[\x00-\xFF](?![\x80-\xBF])"), "line": re.compile(rb"\n"), "word": re.compile(rb"[\x20\x09-\x0D](?=[^\x20\x09-\x0D])")}


def blocks_of(text: bytes, unit: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Byte ranges of ``limit`` bytes, or as many more as the last unit needs."""
    lo = 0
    while len(text) - lo > limit:
        end = _ENDS[unit].search(text, lo + limit - 1)
        if end is None or end.end() >= len(text):
            break
        yield lo, end.end()
        lo = end.end()
    yield lo, len(text)


def unit_lists(blocks: list[bytes], unit: str) -> pa.ListArray:
    """One list of units for every block."""
    data = b"".join(blocks)
    edges = np.concatenate([[0], np.cumsum([len(b) for b in blocks], dtype=np.int64)])
    mask = unit_starts(np.frombuffer(data, np.uint8), unit)
    mask[edges[:-1][np.diff(edges) > 0]] = True
    starts = np.flatnonzero(mask)
    offsets = np.append(starts, len(data)).astype(np.int32)
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, edges).astype(np.int32)), units)


def role_pieces(lists: pa.ListArray, base: np.ndarray, bounds: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
    """For every pair of bounds (first ordinal, end ordinal; one of each a list): the joined units between
    them. ``base`` holds the ordinal of each list's first unit."""
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    shift = pa.array(base - lists.offsets.to_numpy()[: len(lists)])
    ordinal = pc.add(pa.array(np.arange(len(units), dtype=np.int64)), pc.take(shift, parent))
    out = []
    for lo, hi in bounds:
        inside = pc.and_(pc.greater_equal(ordinal, pc.take(pa.array(lo), parent)), pc.less(ordinal, pc.take(pa.array(hi), parent)))
        kept = pc.filter(parent, inside).to_numpy()
        rebuilt = pa.ListArray.from_arrays(pa.array(np.searchsorted(kept, np.arange(len(lists) + 1)).astype(np.int32)), pc.filter(units, inside))
        out.append(pc.binary_join(rebuilt, ""))
    return out


def _arranged(lists: pa.ListArray, owner: np.ndarray, rows: int, plain: np.ndarray, spm: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> dict[str, pa.Array]:
    counts = np.diff(lists.offsets.to_numpy())
    n = np.bincount(owner, counts, rows).astype(np.int64)
    before = np.cumsum(counts) - counts
    base = before - np.concatenate([[0], np.cumsum(n)])[owner]
    one, two = h1 % (n + 1), h2 % (n + 1)
    a, b = np.minimum(one, two), np.maximum(one, two)
    zero = np.zeros(rows, np.int64)
    # A plain text is its own prefix.
    a = np.where(plain, n, a)
    b = np.where(plain, n, b)
    edges = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
    whole = [
        pc.binary_join(pa.ListArray.from_arrays(pa.array(edges), pieces), "")
        for pieces in role_pieces(lists, base, [(lo[owner], hi[owner]) for lo, hi in ((zero, a), (a, b), (b, n))])
    ]
    prefix, middle, suffix = whole
    psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    spm_ = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    is_plain, is_spm = pa.array(plain), pa.array(spm)
    form = pc.if_else(is_plain, "plain", pc.if_else(is_spm, "spm", "psm"))
    none = pa.scalar(None, pa.int64())
    return {
        "n_units": pa.array(n),
        "form": form,
        "prefix_units": pc.if_else(is_plain, none, pa.array(a)),
        "middle_units": pc.if_else(is_plain, none, pa.array(b - a)),
        "output": pc.if_else(is_plain, prefix, pc.if_else(is_spm, spm_, psm)),
    }


_DRAWS = ("plain", "spm", "h1", "h2")


def _transform(unit: str, text: str, draws: str, out: str):
    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        drawn = batch.column(batch.schema.get_field_index(draws))
        plain, spm, h1, h2 = (drawn.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        blocks, owner = [], []
        for i, t in enumerate(texts):
            for lo, hi in blocks_of(t, unit):
                blocks.append(t[lo:hi])
                owner.append(i)
        found = _arranged(unit_lists(blocks, unit), np.array(owner, np.int64), len(texts), plain, spm, h1, h2)
        columns = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != draws}
        columns[out] = pa.StructArray.from_arrays(list(found.values()), names=list(found))
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return T.map_slices(text, work)


def _draw(digest: Column, group: int) -> Column:
    """The ``group``-th eight hexadecimal digits as an unsigned number."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame, out: str = "fim", unit: str = "char", seed: int = SEED, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """``docs`` (doc_id, text) with a column ``out``: n_units, form (plain, psm or spm), prefix_units and
    middle_units (null if plain) and the output text."""
    prepare(docs.sparkSession)
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the table has a column {out!r}")
    draws, work = fresh_name(docs, "_draws"), fresh_name(docs, "_whole")
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    marked = whole.contains(PREFIX) | whole.contains(SUFFIX) | whole.contains(MIDDLE)
    plain = (whole == "") | marked | (_draw(digest, 2) % 100 >= 100 - plain_percent)
    picked = F.struct(plain.alias(_DRAWS[0]), (_draw(digest, 3) % 100 < spm_percent).alias(_DRAWS[1]), _draw(digest, 0).alias(_DRAWS[2]), _draw(digest, 1).alias(_DRAWS[3]))
    rows = docs.withColumns({draws: picked, work: whole})
    kept = [c for c in rows.columns if c != draws]
    schema = StructType([*rows.select(*kept).schema.fields, *StructType.fromDDL(f"{out} struct<{FIELDS.replace(' ', ':').replace(',:', ',')}>").fields])
    return rows.mapInArrow(_transform(unit, work, draws, out), schema).drop(work)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. Texts with sentinels are plain, so the three pieces lie between them."""
    piece = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(piece[1], piece[3], piece[2]))
        .otherwise(F.concat(piece[2], piece[3], piece[1]))
    )


def op13_fill_middle(spark, sf_dir: str) -> DataFrame:
    """Per document: form, sizes in code points, and digests of the output and of the text rebuilt from it."""
    out = fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    f = F.col("fim")
    return out.select(
        "doc_id",
        f["n_units"].alias("n"),
        f["form"].alias("form"),
        f["prefix_units"].alias("prefix_chars"),
        f["middle_units"].alias("middle_chars"),
        F.sha2(f["output"], 256).alias("output_sha256"),
        F.sha2(restored(f["output"], f["form"]), 256).alias("restored_sha256"),
    )


OP13_SQL = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    r AS (SELECT *, ('0x' || substr(h, 1, 8))::UBIGINT % (n + 1)::UBIGINT AS x, ('0x' || substr(h, 9, 8))::UBIGINT % (n + 1)::UBIGINT AS y,
                 ('0x' || substr(h, 17, 8))::UBIGINT AS h3, ('0x' || substr(h, 25, 8))::UBIGINT AS h4 FROM d),
    c AS (SELECT doc_id, t, n, CAST(least(x, y) AS BIGINT) AS a, CAST(greatest(x, y) AS BIGINT) AS b,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
    p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p
"""
