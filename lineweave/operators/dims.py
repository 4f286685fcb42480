"""Dimension tables: station index, resolved coordinates, line profile (small, broadcast).

The dimensions do not grow with the trips (a network has hundreds to thousands of stations),
so the trip side never shuffles on a line or station key; a line used by a third of all trips
is just a hot entry in a broadcast hash table. Dimensions are written to the shared folder once and
read back, so the planner knows their size in bytes: it broadcasts them below its own threshold
(``spark.sql.autoBroadcastJoinThreshold``) and leaves larger ones to adaptive execution (skew-join
splitting). No hint forces a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineweave.functions.geo import point, point_distance_m
from lineweave.functions.names import canonicalize
from lineweave.session import shared_dir


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back: computed once, safe from
    lost executors, and of known size for the planner."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled_beyond(df: DataFrame, max_rows: int | None) -> DataFrame:
    """``df``, marked for a shuffle join if it has more than ``max_rows`` rows (None: never)."""
    if max_rows is None or df.count() <= max_rows:
        return df
    return df.hint("shuffle_merge")


def broadcastable(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether the planner may broadcast a written table: by Spark's own size limit and by ``max_rows``."""
    if max_rows is not None and df.count() > max_rows:
        return False
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def clean_line_stations(line_stations: DataFrame, extra_aliases=None) -> DataFrame:
    cols = line_stations.columns
    sid = F.col("station_id") if "station_id" in cols else F.lit(None).cast("string")
    ls = line_stations.select("route", F.col("num").cast("int").alias("num"), "station", sid.alias("station_id"))
    return canonicalize(ls, ["route", "station"], extra_aliases)


def first_station_per_line(line_stations: DataFrame) -> DataFrame:
    """One row per (route, station): the smallest position wins (a station listed twice).

    A hash aggregation with map-side partials: a line or station that dominates the input is
    pre-reduced before the shuffle.
    """
    return (
        line_stations.filter(F.col("route").isNotNull() & F.col("station").isNotNull() & F.col("num").isNotNull())
        .groupBy("route", "station")
        .agg(F.min("num").alias("num"))
    )


def dedupe_coordinates(locations: DataFrame) -> DataFrame:
    """One coordinate per (route_name, station_name): the smallest located (lng, lat).

    Rows whose coordinates are all missing keep one row with nulls. A coordinate counts as
    located only if both longitude and latitude are present.
    """
    pt = point("longitude", "latitude")
    agg = locations.groupBy("route_name", "station_name").agg(F.min(pt).alias("pt"))
    return agg.select(
        "route_name", "station_name", F.col("pt.lng").alias("longitude"), F.col("pt.lat").alias("latitude")
    )


def clean_locations(locations: DataFrame, extra_aliases=None) -> DataFrame:
    locs = locations.select("route_name", "station_name", "longitude", "latitude")
    return canonicalize(locs, ["route_name", "station_name"], extra_aliases)


def attach_coordinates(
    df: DataFrame, locations: DataFrame, route_col: str = "route", station_col: str = "station",
    max_broadcast_rows: int | None = None, size_check: bool = True,
) -> DataFrame:
    """Left-join coordinates: exact (route, station) first, else the smallest for the name.

    Adds ``longitude``, ``latitude`` (null when the station has no located coordinate).
    ``size_check``: materialise the two coordinate tables first, so that their real size decides
    between broadcast and shuffle (use it when ``df`` is large); without it the optimizer estimates
    (dimension-to-dimension joins).
    """
    located = dedupe_coordinates(locations).filter(F.col("longitude").isNotNull())
    exact = located.select(
        F.col("route_name").alias("_lr"), F.col("station_name").alias("_ls"),
        F.struct(F.col("longitude").alias("lng"), F.col("latitude").alias("lat")).alias("_pe"),
    )
    by_name = located.groupBy("station_name").agg(
        F.min(F.struct(F.col("longitude").alias("lng"), F.col("latitude").alias("lat"))).alias("_pn")
    ).withColumnRenamed("station_name", "_ln")
    if size_check:
        exact = shuffled_beyond(materialized(exact, "coordinates"), max_broadcast_rows)
        by_name = shuffled_beyond(materialized(by_name, "coordinates-by-name"), max_broadcast_rows)
    out = df.join(exact, (F.col(route_col) == F.col("_lr")) & (F.col(station_col) == F.col("_ls")), "left")
    out = out.join(by_name, F.col(station_col) == F.col("_ln"), "left")
    pt = F.coalesce(F.col("_pe"), F.col("_pn"))
    return out.withColumn("longitude", pt["lng"]).withColumn("latitude", pt["lat"]).drop(
        "_lr", "_ls", "_pe", "_ln", "_pn"
    )


def attach_coordinate_variants(df: DataFrame, locations: DataFrame, station_col: str = "station") -> DataFrame:
    """Left-join coordinates by station name only, whatever the line: a name with several distinct
    coordinates gives a row for each; rows equal in every column are kept once."""
    variants = locations.select(F.col("station_name").alias("_ln"), "longitude", "latitude").distinct()
    return df.join(variants, F.col(station_col) == F.col("_ln"), "left").drop("_ln").distinct()


def line_profile(line_index: DataFrame, locations: DataFrame) -> DataFrame:
    """Per (route, num): station, coordinates and prefix sums for O(1) leg distances.

    * ``pt`` / ``prev_pt``: this and the previous listed station's point (null if unlocated);
      the previous listed station of a station inside a leg is always inside the leg.
    * ``seg_m``: metres from the last located station before this one (0 if none or unlocated).
    * ``prev_loc_num``: position of that last located station.
    * ``cum_m``: running sum of ``seg_m`` up to this station.
    * ``next_cum_m``: ``cum_m`` at the first located station at or after this one.
    * ``idx``: dense place on the line; ``idx_first`` / ``idx_last``: those of the first and last station
      that share the position.

    With gaps bridged inside a leg, the leg lo..hi measures ``max(0, cum_m[hi] - next_cum_m[lo])``.
    Windows here run over the small dimension only, all with running frames (what lies ahead is the
    last value seen in reverse order), so the cost is linear in a line's stations. Stations that share
    a position are ordered by name.
    """
    prof = attach_coordinates(line_index, locations, size_check=False)
    w = Window.partitionBy("route").orderBy("num", "station")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    prof = prof.withColumn("pt", point("longitude", "latitude"))
    prof = prof.withColumns(
        {
            "prev_pt": F.lag("pt").over(w),
            "_last": F.last(F.when(F.col("pt").isNotNull(), F.struct("num", "pt")), ignorenulls=True).over(before),
        }
    )
    prof = prof.withColumns(
        {
            "prev_loc_num": F.col("_last.num"),
            "seg_m": F.when(
                F.col("pt").isNotNull() & F.col("_last").isNotNull(), point_distance_m(F.col("_last.pt"), F.col("pt"))
            ).otherwise(F.lit(0)),
        }
    )
    prof = prof.withColumns(
        {
            "cum_m": F.sum("seg_m").over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "idx": (F.row_number().over(w) - 1).cast("int"),
            "prev_loc_pt": F.col("_last.pt"),
            "_next_pt": F.lead("pt").over(w),
            "_next_num": F.lead("num").over(w),
        }
    )
    back = Window.partitionBy("route").orderBy(F.desc("num"), F.desc("station"))
    ahead = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = back.rowsBetween(Window.unboundedPreceding, -1)
    located = F.struct("num", "idx", "pt", "cum_m")
    prof = prof.withColumns(
        {
            "next_cum_m": F.last(F.when(F.col("pt").isNotNull(), F.col("cum_m")), ignorenulls=True).over(ahead),
            # first located station at / strictly after this one
            "next_loc": F.last(F.when(F.col("pt").isNotNull(), located), ignorenulls=True).over(ahead),
            "next_loc_after": F.last(F.when(F.col("pt").isNotNull(), located), ignorenulls=True).over(after),
            # first pair of consecutive listed stations, both located, starting here or later
            "pair": F.last(
                F.when(F.col("pt").isNotNull() & F.col("_next_pt").isNotNull(),
                       F.struct("num", "cum_m", F.col("_next_num").alias("end_num"))),
                ignorenulls=True,
            ).over(ahead),
        }
    )
    same = Window.partitionBy("route", "num")
    prof = prof.withColumns({"idx_first": F.min("idx").over(same), "idx_last": F.max("idx").over(same)})
    return prof.drop("_last", "_next_pt", "_next_num")
