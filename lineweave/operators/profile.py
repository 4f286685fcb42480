"""The line profile as a block-wise scan (W5, W6): a line of very many stations is many tasks.

:func:`lineweave.operators.dims.line_profile` walks a line in one window. Here the stations of all lines are dealt out
by ranges of (line, position, name) into blocks; running sums and "last located" states are taken inside a
block, then over one summary row for each block of a line, and put together. Two rounds are needed: the first carries
points over the blocks' edges, so that every segment is known, the second carries sums and what lies ahead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineweave.functions.geo import point, point_distance_m
from lineweave.operators.dims import attach_coordinates, materialized

_KEY = ["route", "_block"]


def _running(value: Column, window, end: int = 0) -> Column:
    """The last value that is not null, up to ``end`` rows from this one."""
    return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, end))


def line_profile_split(line_index: DataFrame, locations: DataFrame, parts: int | None = None) -> DataFrame:
    """The columns of ``line_profile``, for lines of any length; ``parts`` blocks (default: the session's shuffle
    partitions)."""
    parts = parts or int(line_index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    located = attach_coordinates(line_index, locations, size_check=False).withColumn("pt", point("longitude", "latitude"))
    ranged = located.repartitionByRange(parts, "route", "num", "station").withColumn("_block", F.spark_partition_id())
    # Written, so that every later step sees the same blocks.
    ranged = materialized(ranged, "profile-blocks")
    rows = materialized(_with_segments(ranged), "profile-segments")
    same = Window.partitionBy("route", "num")
    out = _with_sums(rows).withColumns({"idx_first": F.min("idx").over(same), "idx_last": F.max("idx").over(same)})
    return out.select(
        *line_index.columns, "longitude", "latitude", "pt", "prev_pt", "prev_loc_num", "seg_m", "cum_m", "idx", "prev_loc_pt",
        "next_cum_m", "next_loc", "next_loc_after", "pair", "idx_first", "idx_last",
    )


def _with_segments(ranged: DataFrame) -> DataFrame:
    """Places, neighbours and segments, with what a block needs of the blocks before and behind it."""
    here = F.struct("num", "station", "pt")
    on_map = F.when(F.col("pt").isNotNull(), here)
    blocks = ranged.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("_n"), F.min(here).alias("_first"), F.max(here).alias("_end"), F.max(on_map).alias("_end_on_map")
    )
    line = Window.partitionBy("route").orderBy("_block")
    blocks = blocks.select(
        *_KEY,
        "_n",
        F.coalesce(F.sum("_n").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        _running(F.col("_end_on_map"), line, -1).alias("_before"),
        F.lag("_end").over(line).alias("_previous"),
        F.lead("_first").over(line).alias("_following"),
    )
    inside = Window.partitionBy(*_KEY).orderBy("num", "station")
    rows = ranged.withColumns({
        "_place": F.row_number().over(inside) - 1,
        "_prev_in": F.lag("pt").over(inside),
        "_next_in": F.lead(F.struct("num", "pt")).over(inside),
        "_last_in": _running(F.when(F.col("pt").isNotNull(), F.struct("num", "pt")), inside, -1),
    }).join(blocks, _KEY)
    last = F.coalesce(F.col("_last_in"), F.when(F.col("_before").isNotNull(), F.struct(F.col("_before.num").alias("num"), F.col("_before.pt").alias("pt"))))
    rows = rows.withColumns({
        "_last": last,
        "idx": (F.col("_offset") + F.col("_place")).cast("int"),
        "prev_pt": F.when(F.col("_place") == 0, F.col("_previous.pt")).otherwise(F.col("_prev_in")),
        "_next_num": F.when(F.col("_place") == F.col("_n") - 1, F.col("_following.num")).otherwise(F.col("_next_in.num")),
        "_next_pt": F.when(F.col("_place") == F.col("_n") - 1, F.col("_following.pt")).otherwise(F.col("_next_in.pt")),
    })
    segment = F.when(F.col("pt").isNotNull() & F.col("_last").isNotNull(), point_distance_m(F.col("_last.pt"), F.col("pt"))).otherwise(F.lit(0))
    rows = rows.withColumns({"prev_loc_num": F.col("_last.num"), "prev_loc_pt": F.col("_last.pt"), "seg_m": segment})
    return rows.drop("_n", "_offset", "_before", "_previous", "_following", "_place", "_prev_in", "_next_in", "_last_in", "_last")


def _with_sums(rows: DataFrame) -> DataFrame:
    """Running sums from the line's start, and the first located station and pair ahead."""
    inside = Window.partitionBy(*_KEY).orderBy("num", "station")
    rows = rows.withColumn("_sum", F.sum("seg_m").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    on_map, is_pair = F.col("pt").isNotNull(), F.col("pt").isNotNull() & F.col("_next_pt").isNotNull()
    blocks = rows.groupBy(*_KEY).agg(
        F.sum("seg_m").alias("_metres"),
        F.min(F.when(on_map, F.struct("num", "station", "idx", "pt", "_sum"))).alias("_loc"),
        F.min(F.when(is_pair, F.struct("num", "station", "_sum", "_next_num"))).alias("_pair"),
    )
    line = Window.partitionBy("route").orderBy("_block")
    blocks = blocks.withColumn("_so_far", F.coalesce(F.sum("_metres").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    loc, pair, so_far = F.col("_loc"), F.col("_pair"), F.col("_so_far")
    first = F.when(loc.isNotNull(), F.struct(loc["num"].alias("num"), loc["idx"].alias("idx"), loc["pt"].alias("pt"), (so_far + loc["_sum"]).alias("cum_m")))
    first_pair = F.when(pair.isNotNull(), F.struct(pair["num"].alias("num"), (so_far + pair["_sum"]).alias("cum_m"), pair["_next_num"].alias("end_num")))
    back = Window.partitionBy("route").orderBy(F.desc("_block"))
    blocks = blocks.select(*_KEY, "_so_far", _running(first, back, -1).alias("_loc_ahead"), _running(first_pair, back, -1).alias("_pair_ahead"))
    rows = rows.join(blocks, _KEY).withColumn("cum_m", F.col("_so_far") + F.col("_sum"))
    behind = Window.partitionBy(*_KEY).orderBy(F.desc("num"), F.desc("station"))
    here = F.when(on_map, F.struct("num", "idx", "pt", "cum_m"))
    starts = F.when(is_pair, F.struct("num", "cum_m", F.col("_next_num").alias("end_num")))
    rows = rows.withColumns({
        "next_loc": F.coalesce(_running(here, behind), F.col("_loc_ahead")),
        "next_loc_after": F.coalesce(_running(here, behind, -1), F.col("_loc_ahead")),
        "pair": F.coalesce(_running(starts, behind), F.col("_pair_ahead")),
    })
    return rows.withColumn("next_cum_m", F.col("next_loc.cum_m"))
