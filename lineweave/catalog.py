"""Registered queries: one per operator of the inventory, each reading the driver's tables.

Each entry takes (spark, sf_dir) and returns a DataFrame whose columns match the oracle SQL of
the same name in :mod:`lineweave.fixtures_sql`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweave import fixtures as fx
from lineweave.functions.names import canonicalize
from lineweave.operators import (
    attach_coordinate_variants,
    attach_coordinates,
    bridge_missing_coordinates,
    clean_locations,
    collect_trip_stations,
    dedupe_coordinates,
    exact_trip_distance,
    expand_hop_stations,
    explode_hops,
    first_station_per_line,
    fold_hops,
    keep_first,
    leg_stations,
    line_profile_split,
    plan_elements,
    prepare_trips,
    resolved_legs,
    segment_distance,
    transfer_stations,
    trip_distance,
    trip_identity,
)
from lineweave.plans import build_line_net, hop_legs, line_net_frame, prepare_dims, unresolved_hops
from lineweave.plans.naive import build_line_net_naive
from lineweave.plans.stored import store_trips, stored_line_net
from lineweave.session import shared_dir
from lineweave.sources import (
    accepted,
    line_stations_from_markup,
    line_stations_from_pages,
    line_stations_from_payload,
    location_scan,
    markup_rejects,
    read_csv_records,
    read_line_stations_csv,
    rejected,
    trip_scan,
    trip_value_rejects,
    write_line_stations_csv,
)

Query = Callable[[SparkSession, str], DataFrame]


def _pages(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet")


def _dims(spark, d, gap=0):
    return prepare_dims(fx.grid_line_stations(spark, d), fx.grid_locations(spark, d, gap))


def _hops(spark, d, dedupe=True):
    t = prepare_trips(trip_scan(fx.grid_trips(spark, d)), fx.GRID_KEY)
    return fold_hops(t, dedupe=dedupe)


def _legs(spark, d, gap=0):
    dims = _dims(spark, d, gap)
    return dims, resolved_legs(hop_legs(fx.grid_trips(spark, d), dims, fx.GRID_KEY))


def _leg_stations(spark, d, gap=0):
    dims, legs = _legs(spark, d, gap)
    return leg_stations(legs, dims.lines)


def q_trip_scan(spark, d):
    return trip_scan(fx.grid_trips(spark, d, null_status="P"))


def q_location_scan(spark, d):
    return location_scan(fx.customer_locations(spark, d))


def q_line_stations_from_payload(spark, d):
    return line_stations_from_payload(fx.pages_payload(spark, d))


def q_line_stations_from_pages(spark, d):
    return line_stations_from_pages(_pages(spark, d))


def q_line_stations_csv(spark, d):
    path = shared_dir(spark, "line_stations_csv")
    write_line_stations_csv(line_stations_from_pages(_pages(spark, d), clean=False), path)
    return read_line_stations_csv(spark, path)


def q_canonical_names(spark, d):
    names = fx.part_names(spark, d)
    return canonicalize(names.withColumn("name_out", F.col("name_in")), ["name_out"])


def q_explode_hops(spark, d):
    t = prepare_trips(trip_scan(fx.grid_trips(spark, d, spaced=True)), fx.GRID_KEY)
    return explode_hops(t).select("trip_id", "hop", "route_raw", "station", "code")


def q_carry_forward_route(spark, d):
    return _hops(spark, d, dedupe=False).select("trip_id", "hop", "route", "station")


def q_trip_identity(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    keys = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    return trip_identity(orders, keys).select("o_orderkey", "trip_id")


def q_dedupe_hop_stations(spark, d):
    return _hops(spark, d).select("trip_id", "hop", "route", "station")


def q_expand_hop_stations(spark, d):
    dims = _dims(spark, d)
    return expand_hop_stations(_hops(spark, d), dims.index).select(
        "trip_id", "hop", "route", "station", "sub_station_num", "sub_station"
    )


def q_transfer_stations(spark, d):
    dims = _dims(spark, d)
    return transfer_stations(expand_hop_stations(_hops(spark, d), dims.index)).select(
        "trip_id", "hop", "route", "station", "sub_station_num"
    )


def q_leg_destinations(spark, d):
    _, legs = _legs(spark, d)
    return legs.select("trip_id", "hop", "route", "station", "next_station", "o_num", "d_num", "lo", "hi")


def q_leg_stations(spark, d):
    return _leg_stations(spark, d).select("trip_id", "hop", "route", "num", "sub_station")


def q_attach_coordinates(spark, d):
    st = _leg_stations(spark, d, gap=17).select("trip_id", "hop", "num", "route", "sub_station")
    locs = clean_locations(location_scan(fx.grid_locations(spark, d, 17)))
    return attach_coordinates(st, locs, "route", "sub_station").select(
        "trip_id", "hop", "num", "sub_station", "longitude", "latitude"
    )


def q_segment_distance(spark, d):
    return segment_distance(_leg_stations(spark, d, gap=17)).select("trip_id", "hop", "num", "segment_m")


def q_bridge_missing_coordinates(spark, d):
    return bridge_missing_coordinates(_leg_stations(spark, d, gap=17)).select("trip_id", "hop", "num", "bridged_m")


def q_trip_distance(spark, d):
    _, legs = _legs(spark, d, gap=17)
    return trip_distance(legs)


def q_trip_distance_exact(spark, d):
    _, legs = _legs(spark, d, gap=17)
    return exact_trip_distance(legs)


def q_collect_trip_stations(spark, d):
    return collect_trip_stations(_leg_stations(spark, d))


def q_line_net_result(spark, d):
    return build_line_net(
        fx.grid_trips(spark, d), fx.grid_line_stations(spark, d), fx.grid_locations(spark, d), key_cols=fx.GRID_KEY
    )


def q_line_net_exact(spark, d):
    return build_line_net(
        fx.grid_trips(spark, d), fx.grid_line_stations(spark, d), fx.grid_locations(spark, d, 17),
        gap_mode="exact", key_cols=fx.GRID_KEY,
    )


def q_line_net_naive(spark, d):
    return build_line_net_naive(
        fx.grid_trips(spark, d), fx.grid_line_stations(spark, d), fx.grid_locations(spark, d, 17), key_cols=fx.GRID_KEY
    )


def q_unresolved_hops(spark, d):
    return unresolved_hops(
        fx.grid_trips(spark, d, broken=True), fx.grid_line_stations(spark, d), fx.grid_locations(spark, d),
        key_cols=fx.GRID_KEY,
    )


def q_line_net_frame(spark, d):
    return line_net_frame(
        fx.grid_trips(spark, d, broken=True), fx.grid_line_stations(spark, d), fx.grid_locations(spark, d, 17),
        gap_mode="exact", key_cols=fx.GRID_KEY,
    )


def q_dedupe_lineitem_keys(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"
    )
    return keep_first(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


def q_first_station_per_line(spark, d):
    return first_station_per_line(line_stations_from_pages(_pages(spark, d))).select("route", "station", "num")


def q_dedupe_coordinates(spark, d):
    return dedupe_coordinates(location_scan(fx.customer_locations(spark, d, duplicates=True)))


def q_line_net_from_payload(spark, d):
    stations = line_stations_from_payload(fx.grid_payload(spark, d))
    return build_line_net(fx.grid_trips(spark, d), stations, fx.grid_locations(spark, d), key_cols=fx.GRID_KEY)


def q_line_net_from_pages(spark, d):
    stations = line_stations_from_pages(
        fx.grid_pages(spark, d), block_pattern=fx.GRID_BLOCK_PATTERN, line_pattern=fx.GRID_LINE_PATTERN
    )
    return build_line_net(fx.grid_trips(spark, d), stations, fx.grid_locations(spark, d), key_cols=fx.GRID_KEY)


def q_trip_identity_duplicates(spark, d):
    """Trips and distinct ids per plan text, for plans without a key and with equal rows."""
    ids = trip_identity(trip_scan(fx.plain_plans(spark, d)))
    return ids.groupBy("stage_name", "lines_result").agg(
        F.count("*").alias("n_trips"), F.countDistinct("trip_id").alias("n_ids")
    )


def q_coordinate_variants(spark, d):
    locs = location_scan(fx.customer_locations(spark, d, duplicates=True))
    stations = locs.select(F.col("route_name").alias("route"), F.col("station_name").alias("station")).distinct()
    return attach_coordinate_variants(stations, locs)


def q_line_stations_from_markup(spark, d):
    return line_stations_from_markup(fx.markup_pages(spark, d))


def q_markup_rejects(spark, d):
    return markup_rejects(fx.markup_pages(spark, d), ["page_id"])


def q_plan_elements(spark, d):
    return plan_elements(fx.element_plans(spark, d))


def _order_records(spark, d):
    path = shared_dir(spark, "order_records")
    fx.order_records(spark, d).write.text(path)
    types = {"order_key": "bigint", "num": "int", "price": "int", "count": "int", "note": "string"}
    return read_csv_records(spark, path, types, required=("order_key", "num", "count"))


def q_csv_records(spark, d):
    return accepted(_order_records(spark, d))


def q_csv_rejects(spark, d):
    return rejected(_order_records(spark, d)).select("order_key", "field", "value", "reason")


def q_trip_value_rejects(spark, d):
    trips = fx.grid_trips(spark, d)
    price = F.when(F.col("price") == 5, F.lit("five")).otherwise(F.col("price").cast("string"))
    return trip_value_rejects(trips.withColumns({"price": price, "count": F.concat(F.lit(" "), F.col("count").cast("string"))}), ["trip_key"])


def q_line_net_stored(spark, d):
    table = f"line_net_trips_{uuid.uuid4().hex[:12]}"
    store_trips(fx.grid_trips(spark, d), table, shared_dir(spark, table), key_cols=fx.GRID_KEY)
    return stored_line_net(spark, table, _dims(spark, d, 17), gap_mode="exact")


def q_line_net_spread(spark, d):
    return build_line_net(
        fx.grid_trips(spark, d), fx.grid_line_stations(spark, d), fx.grid_locations(spark, d, 17),
        gap_mode="exact", key_cols=fx.GRID_KEY, max_broadcast_rows=0,
    )


def q_line_profile_split(spark, d):
    stations, locations = fx.customer_line(spark, d)
    prof = line_profile_split(first_station_per_line(stations), locations)
    return prof.select(
        "num", "station", "idx", "idx_first", "idx_last", "prev_loc_num", "seg_m", F.col("cum_m").cast("long").alias("cum_m"),
        F.col("next_cum_m").cast("long").alias("next_cum_m"), F.col("next_loc_after.idx").alias("next_idx"), F.col("pair.end_num").alias("pair_end"),
    )


QUERIES: dict[str, Query] = {
    "trip_scan": q_trip_scan,
    "location_scan": q_location_scan,
    "line_stations_from_payload": q_line_stations_from_payload,
    "line_stations_from_pages": q_line_stations_from_pages,
    "line_stations_csv": q_line_stations_csv,
    "canonical_names": q_canonical_names,
    "explode_hops": q_explode_hops,
    "carry_forward_route": q_carry_forward_route,
    "trip_identity": q_trip_identity,
    "dedupe_hop_stations": q_dedupe_hop_stations,
    "expand_hop_stations": q_expand_hop_stations,
    "transfer_stations": q_transfer_stations,
    "leg_destinations": q_leg_destinations,
    "leg_stations": q_leg_stations,
    "attach_coordinates": q_attach_coordinates,
    "segment_distance": q_segment_distance,
    "bridge_missing_coordinates": q_bridge_missing_coordinates,
    "trip_distance": q_trip_distance,
    "trip_distance_exact": q_trip_distance_exact,
    "collect_trip_stations": q_collect_trip_stations,
    "line_net_result": q_line_net_result,
    "line_net_exact": q_line_net_exact,
    "line_net_naive": q_line_net_naive,
    "unresolved_hops": q_unresolved_hops,
    "line_net_frame": q_line_net_frame,
    "first_station_per_line": q_first_station_per_line,
    "dedupe_lineitem_keys": q_dedupe_lineitem_keys,
    "dedupe_coordinates": q_dedupe_coordinates,
    "line_net_from_payload": q_line_net_from_payload,
    "line_net_from_pages": q_line_net_from_pages,
    "trip_identity_duplicates": q_trip_identity_duplicates,
    "coordinate_variants": q_coordinate_variants,
    "line_stations_from_markup": q_line_stations_from_markup,
    "markup_rejects": q_markup_rejects,
    "plan_elements": q_plan_elements,
    "csv_records": q_csv_records,
    "csv_rejects": q_csv_rejects,
    "trip_value_rejects": q_trip_value_rejects,
    "line_net_stored": q_line_net_stored,
    "line_net_spread": q_line_net_spread,
    "line_profile_split": q_line_profile_split,
}
