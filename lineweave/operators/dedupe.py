"""Deterministic de-duplication (A1, A2): one row per key, the smallest by an ordering wins.

``groupBy(keys).agg(min(struct(order..., rest...)))`` is an aggregation with map-side partials:
a key holding a third of all rows is reduced to one row per map task before the shuffle, so no
task receives the hot group whole (unlike ``row_number()`` over a window on the key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` columns (then the smallest of the
    remaining columns, so the survivor is fully deterministic)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order or [])
    tail = [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c) for c in tail])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_m"))
    return agg.select(*keys, *[F.col(f"_m._o{i}").alias(c) for i, c in enumerate(order)],
                      *[F.col(f"_m.{c}").alias(c) for c in tail]).select(*df.columns)
