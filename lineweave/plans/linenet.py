"""The whole job: trip plans + station lists + coordinates -> one row per (trip, leg, station).

Physical shape (see ``explain``): the trip rows are hash-partitioned once on ``trip_id`` (a
unique, hence unskewed key) right after the scan, while they are still one row per trip; every
later step is partition-local. Hops come complete out of a fold over the plan array, the bounds and the
stations between them out of size-checked broadcasts, and windows partition by the trip for what concerns
the whole trip (is every hop resolved, the total). Nothing is collected to the driver and no Python runs
per row. Results and rejects can leave in one frame (:func:`line_net_frame`), so that the sink scans,
shuffles and computes once.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lineweave.functions.names import canonical_name
from lineweave.operators.dims import (
    broadcastable,
    clean_line_stations,
    clean_locations,
    first_station_per_line,
    line_profile,
    materialized,
    shuffled_beyond,
)
from lineweave.operators.distance import LEG_TERMS, exact_leg_terms, leg_distance, with_exact_leg_distance, with_trip_distance
from lineweave.operators.fold import fold_hops, plan_lines
from lineweave.operators.hops import TRIP_ATTRS, by_trip, clean_trip_names, mark_shared_ids, trip_identity, whole_trip
from lineweave.operators.legs import leg_destinations, leg_ends, leg_slices, leg_stations, line_arrays, line_lookup, resolved_legs
from lineweave.operators.profile import line_profile_split
from lineweave.operators.skew import SALT, hot_values, replicated, salted
from lineweave.schemas import RESULT_COLUMNS
from lineweave.sources.locations import location_scan
from lineweave.sources.trips import trip_scan

GAP_MODES = ("bridge", "exact")


@dataclass
class LineNetDims:
    index: DataFrame  # (route, station) -> num, prefix sums
    profile: DataFrame  # (route, num) -> station, coordinates, segment columns
    routes: DataFrame  # known routes
    lines: DataFrame  # (route, part) -> stations with coordinates and segment columns
    large: bool = False  # joins with them shuffle
    hot: list | None = None  # the hot lines, if rows of the dimensions are repeated for their salts
    lookup: DataFrame | None = None  # route -> the index of its stations; if large, and no line is split into parts

    def bare_lines(self) -> DataFrame:
        """``lines`` with the columns that the result shows only."""
        shown = ("num", "sub_station", "longitude", "latitude")
        return self.lines.withColumn("stations", F.transform("stations", lambda x: F.struct(*[x[c].alias(c) for c in shown])))


def prepare_dims(line_stations: DataFrame, locations: DataFrame, extra_aliases=None,
                 max_broadcast_rows: int | None = None, split_lines: bool = False) -> LineNetDims:
    """Clean, de-duplicate and profile the (small) dimensions, written once to the shared folder;
    the planner broadcasts them if their size allows it (``max_broadcast_rows`` forbids it beyond).
    ``split_lines``: profile by blocks, for networks with lines of very many (100,000 or more) stations."""
    idx = first_station_per_line(clean_line_stations(line_stations, extra_aliases))
    locs = clean_locations(location_scan(locations), extra_aliases)
    # The profile is read by three joins.
    profile_of = line_profile_split if split_lines else line_profile
    prof = materialized(profile_of(idx, locs), "line-profile")
    large = not broadcastable(prof, max_broadcast_rows)
    prof = shuffled_beyond(prof, max_broadcast_rows)
    index = prof.select(
        "route", "station", "num", "cum_m", "next_cum_m",
        "idx", "idx_first", "idx_last", "pt", "prev_loc_num", "prev_loc_pt", "next_loc", "next_loc_after", "pair",
    )
    profile = prof.select(
        "route", "num", "station", "longitude", "latitude", "pt", "prev_pt", "prev_loc_num", "seg_m"
    )
    routes = prof.select("route").distinct()
    fields = ["longitude", "latitude", "pt", "prev_pt", "prev_loc_num", "seg_m"]
    lines = shuffled_beyond(materialized(line_arrays(prof, fields), "line-arrays"), max_broadcast_rows)
    lookup = None
    if large and not lines.agg(F.max("part")).first()[0]:
        lookup = shuffled_beyond(materialized(line_lookup(index), "line-lookup"), max_broadcast_rows)
    return LineNetDims(index, profile, materialized(routes, "line-routes"), lines, large, lookup=lookup)


def spread_dims(dims: LineNetDims, trips: DataFrame, extra_aliases=None) -> LineNetDims:
    """``dims`` as they are if they are broadcast; else with the rows of hot lines repeated for every salt. Finding the
    hot lines is one more pass over the plans (a count for each line)."""
    if not dims.large or dims.hot is not None:
        return dims
    lines = plan_lines(trip_scan(trips).select("lines_result"))
    hot = hot_values(lines, "route", clean=lambda name: canonical_name(name, extra_aliases))
    lookup = None if dims.lookup is None else replicated(dims.lookup, hot)
    return replace(dims, index=replicated(dims.index, hot), lines=replicated(dims.lines, hot), routes=replicated(dims.routes, hot), hot=hot, lookup=lookup)


def partitioned_trips(trips: DataFrame, key_cols=None, extra_aliases=None, rows: int | None = None) -> DataFrame:
    """Plan rows with ``trip_id``, hash-partitioned on it, names cleaned.

    The one shuffle of the job: trips are still one row each and ``trip_id`` is unique, so
    partitions are even whatever the input file sizes; all per-row work runs after it. Rows that
    share a given key are marked there, never merged. The number of partitions follows the number of
    ``rows``, which is counted if it isn't given (for Parquet a look at the footers).
    """
    t = by_trip(trip_identity(trip_scan(trips), key_cols), trips.count() if rows is None else rows)
    return clean_trip_names(mark_shared_ids(t) if key_cols is not None else t, extra_aliases)


def hop_legs(trips: DataFrame, dims: LineNetDims, key_cols=None, extra_aliases=None,
             prepared: DataFrame | None = None, mark_malformed: bool = False, rows: int | None = None, covered: bool = True) -> DataFrame:
    """Hop rows with bounds and the ``bad`` flag (all hops, last ones included, see :func:`fold_hops` for ``covered``)."""
    t = prepared if prepared is not None else partitioned_trips(trips, key_cols, extra_aliases, rows)
    hops = fold_hops(t, extra_aliases=extra_aliases, mark_malformed=mark_malformed, covered=covered)
    index = dims.index if dims.lookup is None else dims.lookup
    legs = leg_destinations(hops if dims.hot is None else salted(hops, dims.hot, by="trip_id"), index)
    return legs.withColumn("bad", F.col("bad") | F.col("_shared")) if "_shared" in legs.columns else legs


def project_result(stations: DataFrame) -> DataFrame:
    """The 19 output columns (``dest_station_id`` is the destination's own id)."""
    return stations.select(*_result_columns())


def _result_columns() -> list[Column]:
    return [
        F.col("trip_id").alias("uuid"),
        F.col("line_name").alias("from_route_name"),
        F.col("stage_id").alias("from_station_id"),
        F.col("stage_name").alias("from_station_name"),
        F.col("end_line_name").alias("dest_route_name"),
        F.col("end_stage_id").alias("dest_station_id"),
        F.col("end_stage_name").alias("dest_station_name"),
        *[F.col(c) for c in ("distance", "count", "price", "spend_time")],
        F.col("code").alias("transfer_code"),
        F.col("hop").alias("transfer_order"),
        F.col("route").alias("transfer_route_name"),
        F.col("station").alias("transfer_station_name"),
        F.col("num").alias("sub_station_num"),
        F.col("sub_station").alias("sub_station_name"),
        F.col("longitude"),
        F.col("latitude"),
    ]


def build_line_net(
    trips: DataFrame,
    line_stations: DataFrame,
    locations: DataFrame,
    gap_mode: str = "bridge",
    key_cols=None,
    extra_aliases=None,
    max_broadcast_rows: int | None = None,
    dims: LineNetDims | None = None,
) -> DataFrame:
    """One row per (trip, leg, station passed) with the trip's total distance on every row.

    ``trips``: plan rows (see ``lineweave.sources.read_trips``); ``line_stations``: route, num,
    station[, station_id]; ``locations``: route_name, station_name, longitude, latitude.
    ``gap_mode``: ``"bridge"`` or ``"exact"`` (see ``lineweave.operators.distance``).
    Trips with an unresolvable hop are left out; ``unresolved_hops`` lists them with a reason.
    """
    if gap_mode not in GAP_MODES:
        raise ValueError(f"gap_mode must be one of {GAP_MODES}")
    if dims is None:
        dims = prepare_dims(line_stations, locations, extra_aliases, max_broadcast_rows)
    dims = spread_dims(dims, trips, extra_aliases)
    if dims.hot is not None:
        return _spread_line_net(trips, dims, gap_mode, key_cols, extra_aliases)
    legs = resolved_legs(hop_legs(trips, dims, key_cols, extra_aliases))
    if gap_mode == "bridge":
        legs = with_trip_distance(leg_distance(legs))
    else:
        legs = with_exact_leg_distance(legs)
    return project_result(leg_stations(legs, dims.bare_lines()))


def _spread_line_net(trips: DataFrame, dims: LineNetDims, gap_mode: str, key_cols=None, extra_aliases=None) -> DataFrame:
    """:func:`build_line_net` where hops have to be shuffled to the dimensions and back, so their rows are kept narrow.

    A hop takes its trip's id there (as bytes), not its columns, and brings back the terms of its distance and its
    places on the line, not the profile at its bounds; last hops come back only if they are bad. The trip's columns wait
    in the same partitioning and meet the legs after the distance is known. Trips that share a key are left out there.
    """
    rows = trips.count()
    ids = trip_identity(trip_scan(trips), key_cols).withColumn("trip_id", F.unhex("trip_id"))
    plans = by_trip(ids.select("trip_id", "lines_result"), rows)
    legs = hop_legs(None, dims, extra_aliases=extra_aliases, prepared=plans, covered=False)
    legs = leg_ends(legs.where(~F.col("is_last") | F.col("bad")))
    legs, terms = (leg_distance(legs), ["leg_m"]) if gap_mode == "bridge" else (exact_leg_terms(legs), LEG_TERMS)
    legs = legs.select("trip_id", "hop", "route", "station", "code", "is_last", "bad", SALT, "_first", "_last", *terms)
    legs = resolved_legs(by_trip(legs, rows))
    legs = with_trip_distance(legs) if gap_mode == "bridge" else with_exact_leg_distance(legs)
    own = by_trip(ids.select("trip_id", *TRIP_ATTRS), rows)
    if key_cols is not None:
        own = mark_shared_ids(own).where(~F.col("_shared")).drop("_shared")
    # both sides lie in the same partitions; files that compress well must not make the planner broadcast all trips
    legs = legs.join(clean_trip_names(own, extra_aliases).hint("shuffle_merge"), "trip_id")
    return project_result(leg_stations(legs, dims.bare_lines(), per_leg={"trip_id": F.lower(F.hex("trip_id"))}))


def unresolved_hops(
    trips: DataFrame,
    line_stations: DataFrame,
    locations: DataFrame | None = None,
    key_cols=None,
    extra_aliases=None,
    max_broadcast_rows: int | None = None,
    dims: LineNetDims | None = None,
) -> DataFrame:
    """Rows set aside instead of failing the job: (trip_id, hop, route, station, reason).

    ``hop`` is null for a plan that is not a JSON array of hops ("malformed plan").
    """
    if dims is None:
        if locations is None:
            locations = line_stations.sparkSession.createDataFrame(
                [], "route_name string, station_name string, longitude double, latitude double"
            )
        dims = prepare_dims(line_stations, locations, extra_aliases, max_broadcast_rows)
    dims = spread_dims(dims, trips, extra_aliases)
    legs = _with_reasons(hop_legs(trips, dims, key_cols, extra_aliases, mark_malformed=True), dims)
    return legs.select("trip_id", "hop", "route", "station", "reason").filter(F.col("reason").isNotNull())


def _with_reasons(legs: DataFrame, dims: LineNetDims) -> DataFrame:
    """``reason``: why a hop (or, with a null hop, the plan) can't be resolved; null if it can."""
    salt = [SALT] if dims.hot is not None else []
    known = dims.routes.select("route", F.col("route").alias("_known"), *salt)
    legs = legs.join(known, ["route", *salt], "left")
    reason = (
        F.when(F.col("malformed"), F.lit("malformed plan"))
        .when(F.col("_shared") if "_shared" in legs.columns else F.lit(False), F.lit("key shared by several trips"))
        .when(F.col("route").isNull(), F.lit("first hop has no line"))
        .when(F.col("station").isNull(), F.lit("hop has no station"))
        .when(F.col("_known").isNull(), F.lit("unknown line"))
        .when(F.col("o_num").isNull(), F.lit("station not on its line"))
        .when(~F.col("is_last") & F.col("d_num").isNull(), F.lit("next station not on this line"))
    )
    return legs.withColumn("reason", reason).drop("_known")


RESULT, REJECT = "result", "reject"


def line_net_frame(
    trips: DataFrame,
    line_stations: DataFrame | None,
    locations: DataFrame | None,
    gap_mode: str = "bridge",
    key_cols=None,
    extra_aliases=None,
    max_broadcast_rows: int | None = None,
    dims: LineNetDims | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Results and rejects of one pass over the trips: the 19 columns of :func:`build_line_net`, ``reason``
    and ``kind`` (result or reject).

    A reject has its trip in ``uuid``, its hop in ``transfer_order`` (null for a malformed plan), its line
    and station in ``transfer_route_name`` and ``transfer_station_name``, and the trip's plan columns. One
    generator makes both: the stations between a leg's bounds, or one empty station for a hop with a reason.
    ``rows``: the number of trips, if it is known (see :func:`partitioned_trips`).
    """
    if gap_mode not in GAP_MODES:
        raise ValueError(f"gap_mode must be one of {GAP_MODES}")
    if dims is None:
        dims = prepare_dims(line_stations, locations, extra_aliases, max_broadcast_rows)
    dims = spread_dims(dims, trips, extra_aliases)
    hops = hop_legs(trips, dims, key_cols, extra_aliases, mark_malformed=True, rows=rows)
    # A hop without a reason is resolved, so a trip is left out exactly if one of its hops has one.
    legs = _with_reasons(hops, dims).withColumn("bad", F.col("reason").isNotNull())
    trip_bad = F.max("bad").over(whole_trip())
    legs = legs.withColumn("_trip_bad", trip_bad).filter(F.col("bad") | (~F.col("_trip_bad") & ~F.col("is_last")))
    legs = with_trip_distance(leg_distance(legs)) if gap_mode == "bridge" else with_exact_leg_distance(legs)
    # Legs without bounds meet no part of a line; they keep one row.
    legs = legs.withColumns({c: F.when(~F.col("bad"), F.col(c)) for c in ("o_num", "d_num", "distance")})
    legs = legs.withColumns({f"{side}_idx_{edge}": F.when(~F.col("bad"), F.col(f"{side}_idx_{edge}")) for side in "od" for edge in ("first", "last")})
    met = leg_slices(legs, dims.bare_lines(), how="left")
    passed = F.when(F.col("bad"), F.array(F.lit(None).cast(met.schema["passed"].dataType.elementType))).otherwise(F.col("passed"))
    stations = met.select(*[c for c in met.columns if c != "passed"], F.inline(passed))
    kind = F.when(F.col("bad"), F.lit(REJECT)).otherwise(F.lit(RESULT))
    columns = [*_result_columns(), F.col("reason"), kind.alias("kind")]
    return stations.select(*columns)


def split_frame(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results, rejects) of a frame, in the columns of :func:`build_line_net` and :func:`unresolved_hops`."""
    rejects = frame.filter(F.col("kind") == REJECT).select(
        F.col("uuid").alias("trip_id"),
        F.col("transfer_order").alias("hop"),
        F.col("transfer_route_name").alias("route"),
        F.col("transfer_station_name").alias("station"),
        "reason",
    )
    return frame.filter(F.col("kind") == RESULT).select(*RESULT_COLUMNS), rejects


def write_line_net_frame(frame: DataFrame, path: str, mode: str = "errorifexists") -> dict[str, int]:
    """The job's sink: one action writes the frame as Parquet under ``path``, a folder for each ``kind``, and
    counts what it writes: result_rows and reject_rows, as observed by that action."""
    met = Observation()
    kind = F.col("kind")
    counted = frame.observe(
        met,
        F.count(F.when(kind == RESULT, 1)).alias("result_rows"),
        F.count(F.when(kind == REJECT, 1)).alias("reject_rows"),
    )
    counted.write.mode(mode).partitionBy("kind").parquet(path)
    return {k: int(v) for k, v in met.get.items()}


def write_line_net(result: DataFrame, rejects: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The job's sink: Parquet under ``path/result`` and ``path/rejects``."""
    result.write.mode(mode).parquet(f"{path.rstrip('/')}/result")
    rejects.write.mode(mode).parquet(f"{path.rstrip('/')}/rejects")
