"""Segment and trip distances.

Two ways to treat a station without coordinates:

* ``bridge`` (default): inside a leg, measure from the last located station before it.
  With the line profile's prefix sums a leg costs O(1): ``max(0, cum[hi] - next_cum[lo])``.
* ``exact``: the sequential rule of the original job, state carried across legs: walking the
  trip's consecutive station pairs in (leg, position) order, a missing end is replaced by the
  corresponding end of the last measured pair; nothing is measured before the first pair with
  both ends located. That is a running ``last(..., ignorenulls)`` over the trip, so it is a
  window (no per-trip list, no UDF).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineweave.functions.geo import point_distance_m


def segment_distance(stations: DataFrame) -> DataFrame:
    """``segment_m``: metres from the previous station of the leg (ordered by position) to this
    one; null on the leg's first station or when either end has no coordinate."""
    is_pair = F.col("num") > F.col("lo")
    return stations.withColumn(
        "segment_m",
        F.when(is_pair & F.col("pt").isNotNull() & F.col("prev_pt").isNotNull(),
               point_distance_m(F.col("prev_pt"), F.col("pt"))),
    )


def bridge_missing_coordinates(stations: DataFrame) -> DataFrame:
    """``bridged_m``: metres from the last located station of the same leg before this one
    (0 when this station is unlocated or none is located before it in the leg)."""
    return stations.withColumn(
        "bridged_m",
        F.when(F.col("pt").isNotNull() & (F.col("prev_loc_num") >= F.col("lo")), F.col("seg_m")).otherwise(F.lit(0)),
    )


def leg_distance(legs: DataFrame) -> DataFrame:
    """``leg_m`` from the prefix sums looked up with the bounds (needs o_/d_ cum columns)."""
    o_low = F.col("o_num") <= F.col("d_num")
    cum_hi = F.when(o_low, F.col("d_cum_m")).otherwise(F.col("o_cum_m"))
    next_cum_lo = F.when(o_low, F.col("o_next_cum_m")).otherwise(F.col("d_next_cum_m"))
    return legs.withColumn("leg_m", F.greatest(F.lit(0), F.coalesce(cum_hi - next_cum_lo, F.lit(0))))


def with_trip_distance(legs: DataFrame) -> DataFrame:
    """``distance`` on every leg row: the trip's total of ``leg_m`` (window on the trip)."""
    return legs.withColumn("distance", F.sum("leg_m").over(Window.partitionBy("trip_id")).cast("int"))


def trip_distance(legs: DataFrame) -> DataFrame:
    """One row per trip: (trip_id, distance) in whole metres (bridge mode)."""
    return leg_distance(legs).groupBy("trip_id").agg(F.sum("leg_m").cast("int").alias("distance"))


def with_exact_distance(stations: DataFrame) -> DataFrame:
    """``distance`` on every station row by the exact sequential rule (see module doc)."""
    order = Window.partitionBy("trip_id").orderBy("hop", "num")
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_pair = F.col("num") > F.col("lo")
    a = F.when(is_pair, F.col("prev_pt"))
    b = F.when(is_pair, F.col("pt"))
    s = stations.withColumns(
        {
            "_started": F.max(F.when(a.isNotNull() & b.isNotNull(), 1).otherwise(0)).over(run),
            "_a": F.last(a, ignorenulls=True).over(run),
            "_b": F.last(b, ignorenulls=True).over(run),
        }
    )
    s = s.withColumn(
        "_contrib",
        F.when(is_pair & (F.col("_started") == 1), point_distance_m(F.col("_a"), F.col("_b"))).otherwise(F.lit(0)),
    )
    s = s.withColumn("distance", F.sum("_contrib").over(Window.partitionBy("trip_id")).cast("int"))
    return s.drop("_started", "_a", "_b", "_contrib")


def trip_distance_exact(stations: DataFrame) -> DataFrame:
    """One row per trip: (trip_id, distance) by the exact sequential rule, walked over station rows
    (the reference form; :func:`exact_trip_distance` needs none)."""
    return with_exact_distance(stations).groupBy("trip_id").agg(F.first("distance").alias("distance"))


def exact_trip_distance(legs: DataFrame) -> DataFrame:
    """One row per trip: (trip_id, distance) by the exact sequential rule, from the legs alone."""
    return with_exact_leg_distance(legs).groupBy("trip_id").agg(F.first("distance").alias("distance"))


def with_exact_leg_distance(legs: DataFrame) -> DataFrame:
    """``distance`` on every leg row by the exact sequential rule, without station rows.

    Per leg (stations s_0..s_m between the bounds, in line order) the rule has a closed form
    from the line profile looked up at the bounds: before the trip's first pair with both ends
    located nothing counts; after it every located station adds its segment from the last
    located one (prefix sums); stations at the leg start before the first located a- / b-end
    reuse the previous legs' last ends A / B. A, B and "started" are carried across legs with
    running windows over the trip's legs (a few rows), so station rows are never sorted.
    Needs the o_/d_ profile columns from ``leg_destinations``, or :func:`exact_leg_terms` of them.
    """
    if "_kind" not in legs.columns:
        legs = exact_leg_terms(legs)
    before = Window.partitionBy("trip_id").orderBy("hop").rowsBetween(Window.unboundedPreceding, -1)
    legs = legs.withColumns(
        {
            "_started": F.coalesce(F.max("_has_pair").over(before), F.lit(0)),
            "_A": F.last("_last_a", ignorenulls=True).over(before),
            "_B": F.last("_last_b", ignorenulls=True).over(before),
        }
    )
    kind, n, p, c, a, b = (F.col(x) for x in ("_kind", "_n", "_p", "_c", "_A", "_B"))
    ab = point_distance_m(a, b)
    started_m = (
        F.when(kind == _NONE_LOCATED, n * ab)
        .when(kind == _FIRST_LOCATED, n * point_distance_m(p, b) + c)
        .otherwise(n * ab + point_distance_m(a, p) + c)
    )
    leg_m = F.when(kind == _NO_PAIR, F.lit(0)).when(F.col("_started") == 1, started_m).otherwise(F.col("_first_m"))
    legs = legs.withColumn("leg_m", leg_m)
    legs = legs.withColumn("distance", F.sum("leg_m").over(Window.partitionBy("trip_id")).cast("int"))
    return legs.drop(*LEG_TERMS, "_started", "_A", "_B")


#: What :func:`exact_leg_terms` says of a leg.
LEG_TERMS = ["_kind", "_n", "_p", "_c", "_first_m", "_has_pair", "_last_a", "_last_b"]
_NO_PAIR, _NONE_LOCATED, _FIRST_LOCATED, _LATER_LOCATED = range(4)


def exact_leg_terms(legs: DataFrame) -> DataFrame:
    """The ``LEG_TERMS`` of every leg, all that the exact rule takes from its bounds, so that legs can be dealt out to
    their trips without what was looked up. ``_first_m``: its metres if nothing was measured before it. Else, with the
    ends A and B carried to it, by ``_kind``: nothing if it has no pair; n * |AB| if none of its stations is located;
    n * |pB| + c if the first one is; n * |AB| + |Ap| + c if a later one is. ``_has_pair``, ``_last_a``, ``_last_b``:
    what it carries on."""
    o_low = F.col("o_num") <= F.col("d_num")

    def at_lo(c):
        return F.when(o_low, F.col(f"o_{c}")).otherwise(F.col(f"d_{c}"))

    def at_hi(c):
        return F.when(o_low, F.col(f"d_{c}")).otherwise(F.col(f"o_{c}"))

    lo, hi = F.col("lo"), F.col("hi")
    m = at_hi("idx") - at_lo("idx")
    pair = at_lo("pair")
    prev_num_hi, prev_pt_hi, pt_hi = at_hi("prev_loc_num"), at_hi("prev_loc_pt"), at_hi("pt")
    legs = legs.withColumns(
        {
            "_m": m,
            "_lo_idx": at_lo("idx"),
            "_pt_lo": at_lo("pt"),
            "_cum_lo": at_lo("cum_m"),
            "_cum_hi": at_hi("cum_m"),
            "_f": at_lo("next_loc"),
            "_g": at_lo("next_loc_after"),
            "_pair_cum": pair["cum_m"],
            "_has_pair": ((m > 0) & pair.isNotNull() & (pair["end_num"] <= hi)).cast("int"),
            "_last_a": F.when((m > 0) & (prev_num_hi >= lo), prev_pt_hi),
            "_last_b": F.when(m > 0, F.when(pt_hi.isNotNull(), pt_hi).when(prev_num_hi > lo, prev_pt_hi)),
        }
    )
    m, f, g, cum_hi, lo_idx = F.col("_m"), F.col("_f"), F.col("_g"), F.col("_cum_hi"), F.col("_lo_idx")
    none = ~(f.isNotNull() & (f["num"] <= hi))  # nothing located in the leg: every pair re-measures A-B
    at_first = f["num"] == lo  # the first station is located: pairs before the first located b-end use B
    g_in = g.isNotNull() & (g["num"] <= hi)
    # otherwise pairs before the first located station use A-B, then A-f
    legs = legs.withColumns(
        {
            "_kind": F.when(m <= 0, _NO_PAIR).when(none, _NONE_LOCATED).when(at_first, _FIRST_LOCATED).otherwise(_LATER_LOCATED),
            "_n": F.when(none | (at_first & ~g_in), m).when(at_first, g["idx"] - lo_idx - 1).otherwise(f["idx"] - lo_idx - 1),
            "_p": F.when(none, F.lit(None)).when(at_first, F.col("_pt_lo")).otherwise(f["pt"]),
            "_c": F.when(none | (at_first & ~g_in), F.lit(0)).when(at_first, cum_hi - F.col("_cum_lo")).otherwise(cum_hi - f["cum_m"]),
            "_first_m": F.when(F.col("_has_pair") == 1, cum_hi - F.col("_pair_cum")).otherwise(F.lit(0)),
        }
    )
    return legs.drop("_m", "_lo_idx", "_pt_lo", "_cum_lo", "_cum_hi", "_f", "_g", "_pair_cum")
