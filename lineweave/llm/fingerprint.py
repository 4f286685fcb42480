"""Document fingerprints: a quartile digest of hashed byte triplets.

Every triplet (three neighbouring bytes, and the first two with the fourth) falls into one of 256
buckets. A bucket's count is coded by the quartile it lies in among the text's own 256 counts, two
bits each; in front stand the logarithm of the length and the ratios of the quartiles. Two digests
differ by the sum of their buckets' differences (opposite quartiles count double) plus those of the
head; the likeness is 1 minus the difference over a fixed bound, not below 0.

For every document the query also fingerprints an edited text that needs the next document (ascending
id). Documents are range-partitioned by id and sorted, so the next one is the next row; only the last
and first rows of each partition, two per partition, are matched up in a second step.

Cases: a null text is an empty one (digest of zero counts, likeness 1 to another empty text); a null id
comes last; rows that repeat an id are ordered by their text, and a repeated row's next is its twin; a
single row is its own next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineweave.llm import textops as T
from lineweave.llm.tables import cut, fold_id, prepare, read_table

BUCKETS = 256
#: Difference at which the likeness is 0 (unrelated texts differ by about 400).
BOUND = 512
HEAD = 4

#: 100 000 000 bytes and more share the last length code.
_LENGTH_STEP = 255 / np.log1p(1e8)


def digests(texts: list[bytes]) -> np.ndarray:
    """Rows x (HEAD + BUCKETS) codes: length, two quartile ratios, spread, then 0..3 per bucket."""
    n = len(texts)
    raw = np.frombuffer(b"".join(texts) + b"\0\0\0", np.uint8).astype(np.uint32)
    sizes = np.fromiter((len(t) for t in texts), np.int64, n)
    row = np.repeat(np.arange(n, dtype=np.int64), sizes)
    total = len(row)
    counts = np.zeros((n + 1, BUCKETS), np.int64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(total)
    for far, factor, need in ((2, np.uint32(0x9E3779B1), 3), (3, np.uint32(0x85EBCA6B), 4)):
        value = raw[:total] | (raw[1 : total + 1] << np.uint32(8)) | (raw[far : total + far] << np.uint32(16))
        value = (value * factor) ^ (value >> np.uint32(7))
        at = np.where(left >= need, row, n) * BUCKETS + ((value * factor) >> np.uint32(24))
        counts += np.bincount(at, minlength=(n + 1) * BUCKETS).reshape(n + 1, BUCKETS)
    counts = counts[:n]
    q = np.partition(counts, [63, 127, 191], axis=1)[:, [63, 127, 191]]
    out = np.zeros((n, HEAD + BUCKETS), np.uint8)
    out[:, 0] = np.minimum(255, np.round(np.log1p(sizes) * _LENGTH_STEP))
    top = np.maximum(q[:, 2], 1)
    out[:, 1], out[:, 2] = np.minimum(15, 16 * q[:, 0] // top), np.minimum(15, 16 * q[:, 1] // top)
    out[:, 3] = np.minimum(15, (counts == 0).sum(axis=1) // 16)
    out[:, HEAD:] = (counts > q[:, :1]).astype(np.uint8) + (counts > q[:, 1:2]) + (counts > q[:, 2:3])
    return out


def encode(codes: np.ndarray) -> list[str]:
    """Hex text of digests: the length, the rest of the head, two bits per bucket."""
    packed = codes[:, HEAD::4] | (codes[:, HEAD + 1 :: 4] << 2) | (codes[:, HEAD + 2 :: 4] << 4) | (codes[:, HEAD + 3 :: 4] << 6)
    head = np.stack([codes[:, 0], codes[:, 1] | (codes[:, 2] << 4), codes[:, 3]], axis=1)
    return [row.tobytes().hex() for row in np.concatenate([head, packed], axis=1)]


def decode(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    out = np.zeros((1, HEAD + BUCKETS), np.uint8)
    out[0, 0], out[0, 1], out[0, 2], out[0, 3] = raw[0], raw[1] & 15, raw[1] >> 4, raw[2]
    for k in range(4):
        out[0, HEAD + k :: 4] = (raw[3:] >> (2 * k)) & 3
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness (0 to 1) of digests, row by row."""
    gap = np.abs(a.astype(np.int16) - b.astype(np.int16))
    body = gap[:, HEAD:].sum(axis=1) + 3 * (gap[:, HEAD:] == 3).sum(axis=1)
    return 1.0 - np.minimum(BOUND, body + gap[:, :HEAD].sum(axis=1)) / BOUND


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(ids: list, texts: list[str], codes: np.ndarray, following: list[str], next_codes: np.ndarray) -> list[pa.Array]:
    edited = [edited_text(t, f).encode() for t, f in zip(texts, following)]
    new = digests(edited)
    columns = [ids, [len(t) for t in texts], [hashlib.sha256(e).hexdigest() for e in edited], encode(codes), encode(new), likeness(codes, new), likeness(codes, next_codes)]
    return [pa.array(c, k) for c, k in zip(columns, _KINDS)]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    return T.slices(texts, T.SLICE_BYTES // 2)  # type: ignore[arg-type]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with the row behind; its first and last row are also handed on."""
    part, last = TaskContext.get().partitionId(), None

    def edge(which: int, doc_id, text: str) -> pa.RecordBatch:
        row = [pa.array([doc_id], pa.int64()), *[pa.nulls(1, k) for k in _KINDS[1:]], pa.array([part], pa.int32()), pa.array([which], pa.int32()), pa.array([text], pa.string())]
        return pa.RecordBatch.from_arrays(row, names=[*_NAMES, "part", "edge", "text"])

    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        for lo, hi in _slices(texts):
            codes = digests([t.encode() for t in texts[lo:hi]])
            own_ids, own = ids[lo:hi], texts[lo:hi]
            if last is None:
                yield edge(0, own_ids[0], own[0])
            else:
                own_ids, own, codes = [last[0], *own_ids], [last[1], *own], np.concatenate([last[2], codes])
            if len(own) > 1:
                columns = _compare(own_ids[:-1], own[:-1], codes[:-1], own[1:], codes[1:])
                n = len(own) - 1
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())], names=[*_NAMES, "part", "edge", "text"])
            last = (own_ids[-1], own[-1], codes[-1:])
    if last is not None:
        yield edge(1, last[0], last[1])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            ids, texts, following = (batch.column(i).to_pylist() for i in range(3))
            codes, next_codes = (digests([t.encode() for t in x]) for x in (texts, following))
            yield pa.RecordBatch.from_arrays(_compare(ids, texts, codes, following, next_codes), names=_NAMES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [fold_id("doc_id"), F.col("text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, fold_id("doc_id"), F.xxhash64("text")).sortWithinPartitions(fold_id("doc_id"), F.xxhash64("text"), *order[1:])
    table = cut(ordered.mapInArrow(_in_order, f"{_DDL}, part int, edge int, text string"), "fingerprints")
    # The last row of a partition meets the first of the next one that has rows: only numbers of partitions are ordered.
    edges = table.where("edge is not null").select("doc_id", "text", "part", "edge")
    numbers = cut(edges.where("edge = 0").select("part"), "fingerprint-parts")
    line = Window.orderBy("part")
    numbers = numbers.select("part", F.coalesce(F.lead("part").over(line), F.first("part").over(line)).alias("next_part"))
    first = edges.where("edge = 0").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    pairs = edges.where("edge = 1").join(numbers, "part").join(first, "next_part").select("doc_id", "text", "following")
    return table.where("edge is null").select(*_NAMES).union(pairs.mapInArrow(_edges, _DDL))


def op2_fingerprint(spark, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))
