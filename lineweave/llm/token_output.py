"""Packed token-id matrices in binary files, by best-fit-decreasing packing inside bounded windows.

Each task tokenises its documents, adds the end id, splits documents longer than a row losslessly
(whole rows, the first piece takes the remainder) and collects pieces until a window holds
``window_rows`` rows of ids. The window's pieces go, longest first, into the fullest row with room; a
segment tree over the rooms 0..width finds it in log(width) steps. Nothing is shuffled, memory is
one window, and what a window leaves empty is about one row.

For every window one shard of four files is written under ``path``:

* ``<shard>.ids``: rows x width ids, unsigned little-endian, 16 bits if the vocabulary fits, padded
  with the end id;
* ``<shard>.cu``: for every row the cumulative segment lengths from 0 to the row's filled length,
  signed 32-bit, all rows one after another;
* ``<shard>.ptr``: where each row begins in ``.cu``, signed 64-bit, one entry more than rows;
* ``<shard>.rst``: position resets, one bit an id (rows x width bits, the first in the highest bit): set where the
  position within a segment is 0 again, and where the padding begins.

:func:`position_ids` and :func:`positions_of_resets` give the positions that a model is fed. Files are written under a
temporary name and renamed, and a shard's name depends on its place in the input, so a task that runs
again after a lost executor replaces its own shards.

Cases: null or empty texts are the end id alone; null ids, ties and repeated rows are packed like any
others; an empty table writes no shard and gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.llm.files import Store
from lineweave.llm.packing import END_ID, WIDTH, CapacityTree
from lineweave.llm.tables import cut, prepare, read_table
from lineweave.llm.tokens import VOCABULARY, encoder, piece_sizes
from lineweave.session import shared_dir

WINDOW_ROWS = 2048

_SEGMENT = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32())])
_SCHEMA = pa.schema(
    [("shard", pa.string()), ("row", pa.int32()), ("n_ids", pa.int32()), ("n_segments", pa.int32()), ("ids_crc32", pa.int64()), ("cu_lengths", pa.list_(pa.int32())), ("segments", pa.list_(_SEGMENT))]
)
_DDL = "shard string, row int, n_ids int, n_segments int, ids_crc32 long, cu_lengths array<int>, segments array<struct<doc_id:long,piece:int,start:long,length:int>>"


def best_fit_rows(lengths: list[int], width: int) -> list[list[int]]:
    """Rows of item numbers: longest first, each into the fullest row with room."""
    tree, by_room, rows = CapacityTree(width), {}, []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.first_at_least(lengths[item])
        if room is None:
            row, room = len(rows), width
            rows.append([])
        else:
            row = by_room[room].pop()
            tree.add(room, -1)
        rows[row].append(item)
        room -= lengths[item]
        if room:
            by_room.setdefault(room, []).append(row)
            tree.add(room, 1)
    return rows


def position_ids(cu: np.ndarray, width: int) -> np.ndarray:
    """Position of every id of a row within its own segment; the padding counts from 0 again."""
    edges = np.unique(np.concatenate([np.asarray(cu, np.int64), [width]]))
    return np.arange(width) - np.repeat(edges[:-1], np.diff(edges))


def resets_of(cu: np.ndarray, width: int) -> np.ndarray:
    """Which places of a row a segment, or the padding, begins at."""
    out = np.zeros(width + 1, bool)
    out[cu] = True
    return out[:width]


def positions_of_resets(resets: np.ndarray) -> np.ndarray:
    """Position ids of a row from its resets."""
    at = np.arange(len(resets))
    return at - np.maximum.accumulate(np.where(resets, at, 0))


def _window(store: Store, shard: str, pieces: list[tuple], width: int, end_id: int, kind: str) -> pa.RecordBatch:
    rows = best_fit_rows([p[3] for p in pieces], width)
    matrix = np.full((len(rows), width), end_id, kind)
    resets = np.zeros((len(rows), width), bool)
    cu, pointer, out = [], [0], {n: [] for n in _SCHEMA.names}
    for r, items in enumerate(rows):
        own = [0]
        for i in items:
            matrix[r, own[-1] : own[-1] + pieces[i][3]] = pieces[i][4]
            own.append(own[-1] + pieces[i][3])
        cu += own
        resets[r] = resets_of(np.array(own), width)
        pointer.append(len(cu))
        values = (shard, r, own[-1], len(items), zlib.crc32(matrix[r, : own[-1]].astype("<u4").tobytes()), own, [dict(zip(("doc_id", "piece", "start", "length"), pieces[i][:4])) for i in items])
        for n, v in zip(_SCHEMA.names, values):
            out[n].append(v)
    store.write(f"{shard}.ids", matrix.tobytes())
    store.write(f"{shard}.cu", np.array(cu, "<i4").tobytes())
    store.write(f"{shard}.ptr", np.array(pointer, "<i8").tobytes())
    store.write(f"{shard}.rst", np.packbits(resets, axis=1).tobytes())
    return pa.RecordBatch.from_pydict(out, _SCHEMA)


def _pack(path: str, vocabulary: str, width: int, end_id: int, window_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, store = encoder(vocabulary), Store(path)
        kind = "<u2" if tokens.full.get_vocab_size() <= 1 << 16 else "<u4"
        end = np.array([end_id], "<u4").tobytes()
        task, window, held, pieces = TaskContext.get().partitionId(), 0, 0, []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(tokens.ids(text.as_py() or "") + end, "<u4").astype(kind)
                start = 0
                for piece, size in enumerate(piece_sizes(len(ids), width)):
                    pieces.append((doc_id, piece, start, size, ids[start : start + size]))
                    start += size
                held += len(ids)
                if held >= window_rows * width:
                    yield _window(store, f"shard-{task:06d}-{window:06d}", pieces, width, end_id, kind)
                    window, held, pieces = window + 1, 0, []
        if pieces:
            yield _window(store, f"shard-{task:06d}-{window:06d}", pieces, width, end_id, kind)

    return run


def write_packed_ids(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, width: int = WIDTH, end_id: int = END_ID, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Writes the shards of ``docs`` (doc_id, text) under ``path``; one row per matrix row: shard, row,
    n_ids, n_segments, ids_crc32 (unsigned 32-bit ids), cu_lengths, segments."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The table is cut so that the files are written once, whatever reads the result.
    return cut(rows.mapInArrow(_pack(path, vocabulary, width, end_id, window_rows), _DDL), "packed-rows")


def read_shard(path: str, shard: str, width: int = WIDTH, kind: str = "<u2") -> tuple[np.ndarray, list[np.ndarray]]:
    """The id matrix of a shard and the cumulative lengths of its rows."""
    store = Store(path)
    ids = np.frombuffer(store.read(f"{shard}.ids"), kind).reshape(-1, width)
    cu, pointer = np.frombuffer(store.read(f"{shard}.cu"), "<i4"), np.frombuffer(store.read(f"{shard}.ptr"), "<i8")
    return ids, [cu[a:b] for a, b in zip(pointer[:-1], pointer[1:])]


def read_resets(path: str, shard: str, width: int = WIDTH) -> np.ndarray:
    """The resets of a shard's rows (rows x width)."""
    packed = np.frombuffer(Store(path).read(f"{shard}.rst"), np.uint8).reshape(-1, -(-width // 8))
    return np.unpackbits(packed, axis=1, count=width).astype(bool)


def op5_token_ids(spark, sf_dir: str) -> DataFrame:
    return write_packed_ids(read_table(spark, sf_dir, "documents"), shared_dir(spark, "token-ids"))
