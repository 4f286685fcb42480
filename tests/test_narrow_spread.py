"""Hops are shuffled to dimensions that are not broadcast, and back, in narrow rows and as seldom as possible."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lineweave import build_line_net
from lineweave import fixtures as fx
from lineweave.functions.names import canonical_name
from lineweave.operators import fold_hops, leg_destinations
from lineweave.operators import legs as legs_module
from lineweave.operators.fold import plan_lines
from lineweave.operators.legs import line_lookup
from lineweave.operators.skew import hot_values
from lineweave.plans import linenet, prepare_dims
from tests.conftest import SF001
from tests.test_edges import TRIP_SCHEMA


def _rows(df):
    return Counter(map(tuple, df.collect()))


def _spread(spark, trips, ls, locs, mode, **more):
    return build_line_net(trips, ls, locs, gap_mode=mode, key_cols=fx.GRID_KEY, max_broadcast_rows=0, **more)


def _exchanged(df):
    """Columns of every row that goes through an exchange on the trips' side, by the exchange's keys."""
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(p):
        if p.nodeName() == "Exchange":
            names = [p.output().apply(i).name() for i in range(p.output().size())]
            if "trip_id" in names:
                found.append((re.search(r"hashpartitioning\(([^)]*)\)", p.outputPartitioning().toString()).group(1), names))
        inner = [p.executedPlan()] if p.nodeName() == "AdaptiveSparkPlan" else [p.children().apply(i) for i in range(p.children().size())]
        for x in inner:
            walk(x)

    walk(plan)
    return found


@pytest.mark.parametrize("mode", ["bridge", "exact"])
def test_hops_travel_without_their_trip_and_come_back_without_the_profile(spark, mode):
    trips, ls, locs = fx.grid_trips(spark, SF001), fx.grid_line_stations(spark, SF001), fx.grid_locations(spark, SF001, 17)
    met = _exchanged(_spread(spark, trips, ls, locs, mode))
    keys = sorted(re.sub(r"#\d+|, _salt|, \d+$", "", k) for k, _ in met)  # no line is hot in so few partitions
    # plans and trips' columns by trip, hops by line once for both bounds, legs by trip, legs by line to their stations
    assert keys == ["route", "route, part", "trip_id", "trip_id", "trip_id"]
    for key, names in met:
        if "part" not in key:
            assert not {"stage_name", "end_stage_name"} & set(names) or not {"hop", "lines_result"} & set(names)
        assert not [n for n in names if re.match("[od]_", n)], names


@pytest.mark.parametrize("mode, seed", [("bridge", 0), ("exact", 1), ("exact", 2)])
def test_random_networks_with_gaps(spark, mode, seed):
    trips, ls, locs = _random_network_frames(spark, seed)
    assert _rows(_spread(spark, trips, ls, locs, mode)) == _rows(build_line_net(trips, ls, locs, gap_mode=mode, key_cols=fx.GRID_KEY))


def _random_network_frames(spark, seed):
    rng = random.Random(seed)
    stations, places = [], []
    for line in range(4):
        for i, s in enumerate(rng.sample(range(10), 7)):
            stations.append((f"L{line}", i // 2 if line == 3 else i, f"n{s}"))  # line 3: two stations at a position
    for s in range(10):
        there = rng.random() < 0.6
        places.append(("L0", f"n{s}", 113 + rng.random() if there else None, 23 + rng.random() if there else None))
    trips = []
    for k in range(120):
        hops = []
        for j in range(rng.randint(1, 5)):
            line, _, s = rng.choice(stations)
            parts = [f'"stationName":"{s}"'] if rng.random() < 0.95 else []
            if j == 0 or rng.random() < 0.6:
                parts.append(f'"lineName":" {line}"')
            hops.append("{" + ",".join([*parts, f'"stationCode":"{j}"']) + "}")
        key = str(k // 2 if k < 10 else k)  # some trips share a key
        trips.append(("a", "1", f"x{k}", "b", "2", "y", k, 1, "t", "[" + ",".join(hops) + "]", key))
    return (spark.createDataFrame(trips, TRIP_SCHEMA), spark.createDataFrame(stations, "route string, num int, station string"),
            spark.createDataFrame(places, "route_name string, station_name string, longitude double, latitude double"))


def test_trips_without_a_key_and_equal_plans(spark):
    trips, ls, locs = _random_network_frames(spark, 9)
    trips = trips.drop("trip_key").unionByName(trips.drop("trip_key").limit(30))
    plain, spread = (build_line_net(trips, ls, locs, gap_mode="exact", max_broadcast_rows=n) for n in (None, 0))
    assert _rows(spread) == _rows(plain)


def test_lines_of_several_parts_are_not_one_row(spark, monkeypatch):
    trips, ls, locs = _random_network_frames(spark, 4)
    whole = prepare_dims(ls, locs, max_broadcast_rows=0)
    assert whole.lookup is not None and whole.lookup.count() == 4
    monkeypatch.setattr(linenet, "line_arrays", lambda prof, fields: legs_module.line_arrays(prof, fields, 3))
    assert prepare_dims(ls, locs, max_broadcast_rows=0).lookup is None
    assert prepare_dims(ls, locs).lookup is None  # broadcast


def test_both_forms_of_the_index_give_the_same_bounds(spark):
    trips, ls, locs = _random_network_frames(spark, 5)
    index = prepare_dims(ls, locs).index
    hops = fold_hops(trips.withColumnRenamed("trip_key", "trip_id"))
    a, b = leg_destinations(hops, index), leg_destinations(hops, line_lookup(index))
    assert set(a.columns) == set(b.columns) and _rows(a) == _rows(b.select(*a.columns))


def test_a_last_hop_is_left_out_only_if_the_leg_before_it_looks_it_up(spark):
    plans = [
        '[{"lineName":"A","stationName":"s"},{"stationName":"t"}]',
        '[{"lineName":"A","stationName":"s"},{"lineName":" A ","stationName":"t"},{"lineName":"B","stationName":"u"}]',
        '[{"lineName":"A","stationName":"s"}]', '[{"stationName":"s"},{"stationName":"t"}]', "[]", "oops",
    ]
    df = spark.createDataFrame(list(enumerate(plans)), "trip_id int, lines_result string")
    kept = {i: sorted(r.hop for r in fold_hops(df, covered=False).where(F.col("trip_id") == i).collect()) for i in range(len(plans))}
    assert kept == {0: [0], 1: [0, 1, 2], 2: [0], 3: [0, 1], 4: [], 5: []}


def test_lines_are_counted_under_their_clean_names(spark):
    plans = ['[{"lineName":" APM"},{},{"lineName":"B"}]', '[{},{"lineName":"APM线"}]', "[]", "oops", None]
    df = spark.createDataFrame([(p,) for p in plans], "lines_result string")
    assert Counter(r.route for r in plan_lines(df).collect()) == Counter([" APM", " APM", "B", None, "APM线"])
    assert hot_values(plan_lines(df), "route", 1, clean=canonical_name) == ["APM线"]
