"""Joins with dimensions that are too large to broadcast, spread over salts where a line is hot.

Without a broadcast a join shuffles the hops on their line, and a line of a third of all trips is one task. The hot
lines are found first (a grouped count of the plan elements' lines, from partial sums; at most ``2 * partitions`` lines hold
half a task's share or more, so the list is bounded). Hops on a hot line get a salt from their trip, and the
dimension's rows of these lines (and of no others) are repeated for every salt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweave.operators.dims import materialized

SALT = "_salt"
SALTS = 32


def hot_values(df: DataFrame, column: str, partitions: int | None = None, clean: Callable[[str], Column] | None = None) -> list:
    """The values that hold more than half of one partition's even share of the rows. ``clean``: their final form, made
    of the counted values instead of every row's."""
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if clean is not None:
        counts = counts.groupBy(clean(column).alias(column)).agg(F.sum("n").alias("n"))
    counts = materialized(counts, "line-counts")  # a row for each line; the plans are folded once for both readers
    total = F.sum("n").alias("total")
    whole = counts.agg(total).first()["total"] or 0
    least = max(1, whole // (2 * partitions) + 1)
    return [r[column] for r in counts.where(F.col("n") >= least).select(column).collect()]


def _is_hot(column: str, hot: list) -> Column:
    return F.col(column).isin(hot) if hot else F.lit(False)


def salted(df: DataFrame, hot: list, by: str, column: str = "route", salts: int = SALTS) -> DataFrame:
    """``df`` (the large side) with a salt that follows from ``by``; 0 on lines that aren't hot."""
    spread = F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")
    return df.withColumn(SALT, F.when(_is_hot(column, hot), spread).otherwise(F.lit(0)))


def replicated(dim: DataFrame, hot: list, column: str = "route", salts: int = SALTS) -> DataFrame:
    """``dim`` with every row of a hot line once for each salt."""
    each = F.when(_is_hot(column, hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return dim.withColumn(SALT, F.explode(each))
