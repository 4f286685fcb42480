import random

import pytest
from pyspark.sql import functions as F

from lineweave import build_line_net
from lineweave.functions.geo import distance_m
from tests.model import bridge, dist_m, exact_fold

# Single-leg gap cases: six stations 0.01 degree apart on one line (1 = located).
GAP_TABLE = {"111111": 5120, "101111": 3072, "110111": 5121, "110011": 5122,
             "011111": 4096, "111110": 4096, "100111": 2048}


def test_distance_expression_matches_model(spark):
    rng = random.Random(7)
    pts = [(113 + rng.random(), 23 + rng.random(), 113 + rng.random(), 23 + rng.random()) for _ in range(300)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r.m for r in df.select(distance_m("a", "b", "c", "d").alias("m")).collect()]
    assert got == [dist_m(*p) for p in pts]


def _line_trip(spark, mask, reverse=False):
    stations = [f"s{i}" for i in range(6)]
    ls = spark.createDataFrame([("L", i, s) for i, s in enumerate(stations)], "route string, num int, station string")
    locs = spark.createDataFrame(
        [("L", s, f"{113.0 + 0.01 * i:.2f}" if m == "1" else None, "23.0" if m == "1" else None)
         for i, (s, m) in enumerate(zip(stations, mask))],
        "route_name string, station_name string, longitude string, latitude string")
    a, b = ("s5", "s0") if reverse else ("s0", "s5")
    plan = f'[{{"lineName":"L","stationName":"{a}","stationCode":"1"}},{{"stationName":"{b}","stationCode":"2"}}]'
    trips = spark.createDataFrame([("L", "1", a, "L", "2", b, 1, 2, "t", plan, "k")],
                                  "line_name string, stage_id string, stage_name string, end_line_name string, "
                                  "end_stage_id string, end_stage_name string, count int, price int, "
                                  "spend_time string, lines_result string, trip_key string")
    return trips, ls, locs


@pytest.mark.parametrize("mask,metres", sorted(GAP_TABLE.items()))
def test_single_leg_gap_table_exact(spark, mask, metres):
    trips, ls, locs = _line_trip(spark, mask)
    res = build_line_net(trips, ls, locs, gap_mode="exact", key_cols=["trip_key"])
    got = {r.distance for r in res.collect()}
    assert got == {metres}
    legs = [[(113.0 + 0.01 * i, 23.0) if m == "1" else None for i, m in enumerate(mask)]]
    assert exact_fold(legs) == metres


def test_direction_does_not_change_distance(spark):
    for mask in ("111111", "110111"):
        d = [{r.distance for r in build_line_net(*_line_trip(spark, mask, rev), key_cols=["trip_key"]).collect()}
             for rev in (False, True)]
        assert d[0] == d[1]


def _random_network(seed):
    rng = random.Random(seed)
    names = [f"n{i}" for i in range(10)]
    lines = {}
    for li in range(4):
        st = rng.sample(names, rng.randint(4, 8))
        lines[f"L{li}"] = st
    coords = {n: (None if rng.random() < 0.25 else (113 + rng.random() * 0.2, 23 + rng.random() * 0.2)) for n in names}
    trips = []
    for t in range(60):
        hops = []
        line = rng.choice(list(lines))
        cur = rng.choice(lines[line])
        hops.append((line, cur))
        for _ in range(rng.randint(1, 3)):
            # next station on the current line, then maybe change to a line through it
            nxt = rng.choice(lines[line])
            others = [l for l, st in lines.items() if nxt in st and l != line]
            line = rng.choice(others) if others and rng.random() < 0.7 else line
            hops.append((line, nxt))
        trips.append(hops)
    return lines, coords, trips


def _model_distance(lines, coords, hops, fold):
    # drop a hop whose (line, station) occurred before; legs between consecutive hops
    seen, kept = set(), []
    for h in hops:
        if h not in seen:
            seen.add(h)
            kept.append(h)
    legs = []
    for (line, a), (_, b) in zip(kept, kept[1:]):
        pos = {s: i for i, s in reversed(list(enumerate(lines[line])))}
        if a not in pos or b not in pos:
            return None, 0  # the trip cannot be resolved and is set aside
        lo, hi = sorted((pos[a], pos[b]))
        legs.append([coords[s] for s in lines[line][lo:hi + 1]])
    return fold(legs), sum(len(leg) for leg in legs)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_networks_against_model(spark, seed):
    lines, coords, trips = _random_network(seed)
    ls = spark.createDataFrame([(l, i, s) for l, st in lines.items() for i, s in enumerate(st)],
                               "route string, num int, station string")
    locs = spark.createDataFrame([("X", n, None if c is None else str(c[0]), None if c is None else str(c[1]))
                                  for n, c in coords.items()],
                                 "route_name string, station_name string, longitude string, latitude string")
    rows = []
    for i, hops in enumerate(trips):
        els = [f'{{"lineName":"{hops[0][0]}","stationName":"{hops[0][1]}","stationCode":"0"}}']
        prev = hops[0][0]
        for line, st in hops[1:]:
            ln = "" if line == prev else f'"lineName":"{line}",'
            els.append(f'{{{ln}"stationName":"{st}","stationCode":"x"}}')
            prev = line
        rows.append(("a", "1", "b", "c", "2", "d", 1, 1, "t", "[" + ",".join(els) + "]", str(i)))
    trips_df = spark.createDataFrame(rows, "line_name string, stage_id string, stage_name string, "
                                           "end_line_name string, end_stage_id string, end_stage_name string, "
                                           "count int, price int, spend_time string, lines_result string, trip_key string")
    for mode, fold in (("exact", exact_fold), ("bridge", bridge)):
        res = build_line_net(trips_df, ls, locs, gap_mode=mode, key_cols=["trip_key"])
        got = {r.k: (r.d, r.n) for r in res.groupBy(F.col("uuid").alias("k")).agg(
            F.first("distance").alias("d"), F.count("*").alias("n")).collect()}
        ids = {r.trip_key: r.h for r in trips_df.select("trip_key", F.sha2("trip_key", 256).alias("h")).collect()}
        for i, hops in enumerate(trips):
            want, n = _model_distance(lines, coords, hops, fold)
            if n == 0:
                assert ids[str(i)] not in got
            else:
                assert got[ids[str(i)]] == (want, n), (mode, i, hops)
