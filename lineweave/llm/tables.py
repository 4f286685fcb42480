"""Intermediate tables and fixed-size filters shared by the operators of this subpackage."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweave.session import shared_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage in a place that outlives any executor, and gives the planner the table's real
    size, so that a join broadcasts it only if it is below Spark's own threshold.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Workers serve many tasks. Arrays of a megabyte and more go back to the system when they are freed (glibc would keep
#: up to 32 MB each for later), and no worker holds an arena or a pool for every thread.
WORKER_MEMORY = {"MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system", "OPENBLAS_NUM_THREADS": "1"}


#: Bytes of an Arrow batch (a larger row is a batch of its own); Spark's own bound is 64 MB on both sides of a task.
BATCH_BYTES = 4 << 20


def prepare(spark, rows: int = 1000) -> None:
    """Session settings that the operators with Python tasks need.

    Arrow batches hold at most ``rows`` rows and about ``BATCH_BYTES`` bytes, so that a batch of long texts or of
    large sets stays small. Python
    workers find this package where the driver found it (an installed package or ``--py-files``
    needs nothing; this covers a source tree that executors share), and give freed memory back.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, *known]))
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)


def cell_and_bit(column: str, bits: int) -> tuple[Column, Column]:
    """Where a 64-bit hash stands in a bitmap of ``2**bits`` bits: the cell, and its bit in the cell's long."""
    slot = F.shiftrightunsigned(F.col(column), 64 - bits)
    bit = F.call_function("shiftleft", F.expr("1L"), F.pmod(slot, F.lit(64)).cast("int"))
    return F.shiftright(slot, 6).cast("int"), bit


def bitmap(hashes: DataFrame, column: str, bits: int) -> DataFrame:
    """(cell, word) of the cells that are not empty, at most ``2**(bits - 6)`` rows."""
    cell, bit = cell_and_bit(column, bits)
    return hashes.where(F.col(column).isNotNull()).select(cell.alias("cell"), bit.alias("word")).groupBy("cell").agg(F.bit_or("word").alias("word"))


class HashFilter:
    """One-hash bitmap over 64-bit hashes, of fixed size whatever the number of members.

    It never misses a member; others pass with a probability that rises with the fill, so it only
    thins rows out before an exact join. The bits are gathered by a grouped ``bit_or``: at most
    ``2**(bits - 6)`` rows reach the driver (the default is 1 MB of bits), which bounds the broadcast.
    """

    def __init__(self, cells: np.ndarray, bits: int):
        self.cells, self.bits = cells, bits

    @classmethod
    def of(cls, hashes: DataFrame, column: str, bits: int = 23) -> "HashFilter":
        rows = bitmap(hashes, column, bits).toArrow()
        cells = np.zeros(1 << (bits - 6), np.uint64)
        cells[rows["cell"].to_numpy()] = rows["word"].to_numpy().view(np.uint64)
        return cls(cells, bits)

    def maybe(self, h: np.ndarray) -> np.ndarray:
        slot = h >> np.uint64(64 - self.bits)
        return (self.cells[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def fold_id(column: str) -> Column:
    """Document key for ordering: a null id sorts behind every other."""
    return F.coalesce(F.col(column).cast("long"), F.lit((1 << 63) - 1))
