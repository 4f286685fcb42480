"""Joins of whole documents with a (usually small) table of findings, without shuffling the rest.

A fixed-size filter over the findings' keys separates the documents that may have findings; only
those are shuffled to the exact join. With more findings than the filter can tell apart, more
documents are shuffled and the result stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lineweave.llm import textops as T
from lineweave.llm.tables import HashFilter, bitmap, cell_and_bit, cut, fold_id


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Key of a document: its id and its text, so that rows that repeat an id stay apart."""
    return F.xxhash64(fold_id(doc_id), F.xxhash64(F.col(text).cast("string")))


def with_key(docs: DataFrame, key: str) -> DataFrame:
    return docs.withColumn(key, row_key())


def keyed(docs: DataFrame, key: str) -> StructType:
    return StructType([*docs.schema.fields, StructField(key, LongType(), True)])


def filtered(docs: DataFrame, key: str, maybe: HashFilter, inside: bool) -> DataFrame:
    """Rows whose ``key`` may be (or surely isn't) among the filter's members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False).astype(np.int64).view(T.U64)
            yield batch.filter(pa.array(maybe.maybe(T.mix(h)) == inside))

    return docs.mapInArrow(run, docs.schema)


def key_filter(keys: DataFrame, key: str, bits: int = 23) -> HashFilter:
    """Filter over a table's ``key`` column. The finaliser spreads keys over the bitmap, in Python."""
    mixed = keys.select(key).mapInArrow(_mixed, "h long")
    return HashFilter.of(mixed, "h", bits)


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(T.U64)
        yield pa.RecordBatch.from_arrays([pa.array(T.signed(T.mix(h)))], names=["h"])


@dataclass
class KeyCells:
    """The bitmap of :func:`key_filter` as a table (cell, word). Documents meet it in a join with at most ``2**(bits - 6)``
    small rows, so they pass no Python worker, and the step around it keeps its workers for its own work."""

    cells: DataFrame
    bits: int

    @classmethod
    def of(cls, keys: DataFrame, key: str, bits: int = 23) -> "KeyCells":
        return cls(cut(bitmap(keys.select(F.xxhash64(key).alias("h")), "h", bits), "key-cells"), bits)

    def split(self, docs: DataFrame, key: str, inside: bool) -> DataFrame:
        """Rows whose ``key`` may be (or surely isn't) among the members; same columns."""
        h, cell, bit, word = (fresh_name(docs, f"_{n}") for n in ("h", "cell", "bit", "word"))
        at, own = cell_and_bit(h, self.bits)
        rows = docs.withColumn(h, F.xxhash64(key)).withColumns({cell: at, bit: own})
        # The table is bounded by ``bits`` alone.
        met = rows.join(F.broadcast(self.cells.toDF(cell, word)), cell, "inner" if inside else "left")
        hit = F.col(word).bitwiseAND(F.col(bit)) != 0
        return met.where(hit if inside else ~F.coalesce(hit, F.lit(False))).drop(h, cell, bit, word)


def without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose document key is in ``found`` (column ``key``); same columns."""
    key = fresh_name(docs, "_key")
    maybe = KeyCells.of(found, "key")
    rows = with_key(docs, key)
    checked = maybe.split(rows, key, True).join(found.select(F.col("key").alias(key)).distinct(), key, "left_anti")
    return maybe.split(rows, key, False).unionByName(checked).select(*docs.columns)
