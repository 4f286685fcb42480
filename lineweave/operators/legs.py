"""Legs: from hop rows to the stations each leg passes.

A leg i runs from hop i's station to hop i+1's station on hop i's line. Bounds are looked up
first and only the stations between them are taken from the line's array, so a hop is never expanded to
its whole line and the last hop is never expanded at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweave.operators.hops import trip_window, whole_trip
from lineweave.operators.skew import SALT

#: Stations of a line that make one row of :func:`line_arrays`.
LINE_PART = 1024


def expand_hop_stations(hops: DataFrame, line_stations: DataFrame) -> DataFrame:
    """Every station of each hop's line (left join on route), one row per (trip, hop, station).

    This is the full expansion; the pipeline itself uses :func:`leg_stations`. ``line_stations``
    must be one row per (route, station) (see ``first_station_per_line``) and is expected to be
    a size-checked broadcast, so hops never shuffle on the (possibly hot) route key.
    """
    ls = line_stations.select("route", F.col("num").alias("sub_station_num"), F.col("station").alias("sub_station"))
    return hops.join(ls, "route", "left")


def transfer_stations(expanded: DataFrame) -> DataFrame:
    """Rows where the passed station is the hop's own station."""
    return expanded.filter(F.col("sub_station") == F.col("station"))


def leg_destinations(hops: DataFrame, line_index: DataFrame) -> DataFrame:
    """Hop rows with the leg bounds looked up on the hop's line.

    Adds ``next_station`` / ``is_last`` (lead over hop order; :func:`fold_hops` brings them along), ``o_*`` (the hop's own station on
    its line) and ``d_*`` (the next hop's station on this hop's line) from ``line_index`` (one
    row per (route, station), optionally with prefix-sum columns), ``lo``/``hi`` (direction
    normalised) and ``bad`` (the hop cannot be resolved; its trip is set aside). With :func:`line_lookup` of the
    index both bounds come out of one join on the line.
    """
    legs = hops
    if "next_station" not in hops.columns:
        w = trip_window()
        legs = hops.withColumns({"next_station": F.lead("station").over(w), "is_last": F.lead("hop").over(w).isNull()})
    salt = [SALT] if SALT in hops.columns and SALT in line_index.columns else []
    if "names" in line_index.columns:
        legs = legs.join(line_index, ["route", *salt], "left")
        legs = legs.withColumns({side: F.get("found", F.array_position("names", F.col(s)) - 1) for side, s in (("_o", "station"), ("_d", "next_station"))})
        cols = line_index.schema["found"].dataType.elementType.names
        kept = [c for c in legs.columns if c not in ("names", "found", "_o", "_d")]
        legs = legs.select(*kept, *[F.col(f"_{side}")[c].alias(f"{side}_{c}") for side in "od" for c in cols])
    else:
        cols = [c for c in line_index.columns if c not in ("route", "station", SALT)]
        origin = line_index.select("route", "station", *salt, *[F.col(c).alias(f"o_{c}") for c in cols])
        dest = line_index.select(
            "route", F.col("station").alias("next_station"), *salt, *[F.col(c).alias(f"d_{c}") for c in cols]
        )
        legs = legs.join(origin, ["route", "station", *salt], "left").join(dest, ["route", "next_station", *salt], "left")
    bad = (
        F.col("route").isNull()
        | F.col("station").isNull()
        | F.col("o_num").isNull()
        | (~F.col("is_last") & F.col("d_num").isNull())
    )
    return legs.withColumns(
        {
            "lo": F.least("o_num", "d_num"),
            "hi": F.greatest("o_num", "d_num"),
            "bad": bad,
        }
    )


def line_lookup(line_index: DataFrame) -> DataFrame:
    """route, names, found: the index with one row per line, its stations and, in the same places, their columns. For
    lines of at most ``LINE_PART`` stations, as a row grows with its line."""
    cols = [c for c in line_index.columns if c not in ("route", "station")]
    lines = line_index.groupBy("route").agg(F.collect_list(F.struct("station", F.struct(*cols).alias("found"))).alias("_l"))
    return lines.select("route", F.col("_l.station").alias("names"), F.col("_l.found").alias("found"))


def resolved_legs(legs: DataFrame) -> DataFrame:
    """Legs of trips whose every hop resolves (window over the trip, no join); last hops dropped."""
    trip_bad = F.max(F.col("bad").cast("int")).over(whole_trip())
    return legs.withColumn("_trip_bad", trip_bad).filter(
        (F.col("_trip_bad") == 0) & ~F.col("is_last")
    ).drop("_trip_bad")


def line_arrays(profile: DataFrame, fields: Sequence[str] | None = None, size: int = LINE_PART) -> DataFrame:
    """route, part, stations: every line as arrays of up to ``size`` stations in line order (from the dense
    ``idx`` of the profile), so that no row grows with a line. ``fields`` of a station; ``num`` and
    ``sub_station`` are always there."""
    fields = [c for c in profile.columns if c not in ("route", "station", "num", "idx", "idx_first", "idx_last")] if fields is None else fields
    station = F.struct("idx", "num", F.col("station").alias("sub_station"), *fields)
    parts = profile.groupBy("route", F.expr(f"idx div {size}").cast("int").alias("part")).agg(F.array_sort(F.collect_list(station)).alias("stations"))
    bare = F.transform("stations", lambda x: F.struct(*[x[c].alias(c) for c in ("num", "sub_station", *fields)]))
    return parts.select("route", "part", bare.alias("stations"))


def leg_ends(legs: DataFrame) -> DataFrame:
    """``_first`` and ``_last``: the places on the line between which the leg's stations are, ``_first`` <= ``_last``."""
    o_low = F.col("o_num") <= F.col("d_num")
    first = F.when(o_low, F.col("o_idx_first")).otherwise(F.col("d_idx_first"))
    last = F.when(o_low, F.col("d_idx_last")).otherwise(F.col("o_idx_last"))
    return legs.withColumns({"_first": first, "_last": last})


def leg_slices(legs: DataFrame, lines: DataFrame, size: int = LINE_PART, how: str = "inner") -> DataFrame:
    """``legs`` with ``passed``, the stations between the bounds: a slice of the line's array, one row for
    every part of the line that the leg touches (mostly one). The cost follows the stations passed,
    whatever the numbers of their positions."""
    if "_first" not in legs.columns:
        legs = leg_ends(legs)
    legs = legs.withColumn("part", F.explode_outer(F.expr(f"sequence(cast(_first div {size} as int), cast(_last div {size} as int))")))
    begin = F.greatest(F.col("_first") - F.col("part") * size, F.lit(0))
    end = F.least(F.col("_last") - F.col("part") * size, F.lit(size - 1))
    salt = [SALT] if SALT in legs.columns and SALT in lines.columns else []
    met = legs.join(lines, ["route", "part", *salt], how)
    return met.withColumn("passed", F.slice("stations", begin + 1, end - begin + 1)).drop("_first", "_last", "part", "stations")


def leg_stations(legs: DataFrame, lines: DataFrame, size: int = LINE_PART, per_leg: dict[str, Column] | None = None) -> DataFrame:
    """Stations of every leg, from :func:`line_arrays`. Interchange stations appear once per adjoining leg
    (a bag, as each leg is complete). ``per_leg``: columns made after the join, while a leg is still one row."""
    met = leg_slices(legs, lines, size)
    if per_leg:
        met = met.withColumns(per_leg)
    return met.select(*[c for c in met.columns if c != "passed"], F.inline("passed"))
