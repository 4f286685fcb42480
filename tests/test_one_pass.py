"""Hops by a fold, legs by slices, equal rows numbered in blocks, results and rejects in one frame."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lineweave import build_line_net, unresolved_hops
from lineweave import fixtures as fx
from lineweave.operators import carry_forward_route, dedupe_hop_stations, explode_hops, first_station_per_line, fold_hops, leg_destinations, leg_stations, line_arrays, line_profile, trip_identity
from lineweave.operators.hops import COPIES
from lineweave.plans import line_net_frame, prepare_dims, split_frame, write_line_net_frame
from lineweave.plans.linenet import hop_legs
from lineweave.session import shared_dir
from lineweave.streaming import start_line_net_stream
from tests.conftest import SF001
from tests.test_edges import _net, _trips, hop


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _inputs(spark, broken=True):
    return fx.grid_trips(spark, SF001, broken=broken), fx.grid_line_stations(spark, SF001), fx.grid_locations(spark, SF001, 17)


def _random_plans(n):
    rng = random.Random(11)
    part = lambda: rng.choice(['"lineName":"A",', '"lineName":" B ",', '"lineName":null,', "", '"lineName":"C(x段)",'])
    element = lambda: "{" + part() + rng.choice(['"stationName":"s1"', '"stationName":"s2 "', '"stationName":"s(3)"', '"stationCode":"9"']) + "}"
    return {str(i): "[" + ",".join(element() for _ in range(rng.randrange(7))) + "]" for i in range(n)}


def test_fold_equals_windows(spark):
    """The fold against the operators it stands for: explode, carry forward, drop repeats."""
    plans = _random_plans(300) | {"none": None, "text": "oops", "object": '{"a":1}', "long": "[" + ",".join(hop('"A"', f"t{i % 40}") for i in range(300)) + "]"}
    trips = trip_identity(_trips(spark, plans), ["trip_key"])
    shown = ["trip_key", "hop", "route", "station", "code"]
    for dedupe in (False, True):
        windows = carry_forward_route(explode_hops(trips))
        windows = (dedupe_hop_stations(windows) if dedupe else windows).select(*shown)
        folded = fold_hops(trips, dedupe=dedupe)
        assert sorted(map(str, folded.select(*shown).collect())) == sorted(map(str, windows.collect()))
    w = {}
    for r in sorted(fold_hops(trips).collect(), key=lambda r: (r.trip_key, r.hop)):
        w.setdefault(r.trip_key, []).append(r)
    for rows in w.values():
        assert [r.next_station for r in rows] == [r.station for r in rows[1:]] + [None]
        assert [r.is_last for r in rows] == [False] * (len(rows) - 1) + [True]
    marked = fold_hops(trips, mark_malformed=True).where("malformed").collect()
    assert {r.trip_key for r in marked} == {"none", "text", "object"} and all(r.hop is None for r in marked)


def test_hops_need_no_window_and_no_sort(spark):
    trips, ls, locs = _inputs(spark)
    plan = _plan(hop_legs(trips, prepare_dims(ls, locs), fx.GRID_KEY))
    # What is left is the count of rows that share a given key.
    assert plan.count("Window ") <= 1 and "windowspecdefinition(trip_id" in plan and "hop#" not in "".join(x for x in plan.splitlines() if "Sort [" in x)
    keyless = _plan(hop_legs(trips, prepare_dims(ls, locs)))
    assert "Window" not in keyless and "Sort" not in keyless


def _leg(spark, a, b):
    return spark.createDataFrame([("t", 0, "L", a, "c", b, False)], "trip_id string, hop int, route string, station string, code string, next_station string, is_last boolean")


@pytest.mark.parametrize("size", [1, 2, 3, 1024])
def test_legs_cost_stations_not_positions(spark, size):
    """Positions 0, 10^6, 2 * 10^6 and shared ones, in parts of a line of any size."""
    ls = spark.createDataFrame([("L", 0, "a"), ("L", 10**6, "b"), ("L", 10**6, "b2"), ("L", 2 * 10**6, "c"), ("L", 2 * 10**6, "c2"), ("L", 2_000_000_001, "d")], "route string, num int, station string")
    empty = spark.createDataFrame([], "route_name string, station_name string, longitude double, latitude double")
    prof = line_profile(first_station_per_line(ls), empty)
    index = prof.select("route", "station", "num", "idx_first", "idx_last")
    lines = line_arrays(prof, size=size)
    for a, b, passed in [("a", "c", ["a", "b", "b2", "c", "c2"]), ("d", "b2", ["b", "b2", "c", "c2", "d"]), ("b", "b", ["b", "b2"]), ("a", "a", ["a"])]:
        rows = leg_stations(leg_destinations(_leg(spark, a, b), index), lines, size).collect()
        assert sorted(r.sub_station for r in rows) == passed and all(r.lo <= r.num <= r.hi for r in rows)
    plan = _plan(leg_stations(leg_destinations(_leg(spark, "a", "d"), index), lines, size))
    assert "sequence(lo" not in plan


def test_a_plan_on_a_third_of_the_rows_is_spread(spark):
    """3 million plans, a third of them equal: no task numbers more than twice the median."""
    n = 3_000_000
    plan = F.when(F.col("id") % 3 == 0, F.lit("[]")).otherwise(F.concat(F.lit("["), F.col("id").cast("string"), F.lit("]")))
    rows = spark.range(n).select(plan.alias("lines_result"))
    ids = trip_identity(rows)
    per_task = [r["count"] for r in ids.where("lines_result = '[]'").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == n // 3 and max(per_task) <= 2 * sorted(per_task)[len(per_task) // 2] and len(per_task) >= 4
    assert ids.select("trip_id").distinct().count() == n


def test_numbers_of_equal_rows_around_a_block(spark):
    sizes = [1, 2, COPIES - 1, COPIES, COPIES + 1, 3 * COPIES]
    rows = spark.createDataFrame([(f"[{i}]", k) for i, k in enumerate(sizes)], "lines_result string, k int").select("lines_result", F.explode(F.expr("sequence(1, k)")).alias("_")).drop("_")
    got = trip_identity(rows).groupBy("lines_result").agg(F.count("*"), F.countDistinct("trip_id")).collect()
    assert sorted(map(tuple, got)) == sorted((f"[{i}]", k, k) for i, k in enumerate(sizes))
    from hashlib import sha256

    ids = {r.trip_id for r in trip_identity(rows).where("lines_result = '[4]'").collect()}
    assert ids == {sha256(f"[4]\u0001{i}".encode()).hexdigest() for i in range(1, COPIES + 2)}


@pytest.mark.parametrize("mode", ["bridge", "exact"])
def test_frame_holds_results_and_rejects(spark, mode):
    trips, ls, locs = _inputs(spark)
    res, bad = split_frame(line_net_frame(trips, ls, locs, gap_mode=mode, key_cols=fx.GRID_KEY))
    expected = build_line_net(trips, ls, locs, gap_mode=mode, key_cols=fx.GRID_KEY)
    assert res.schema.fieldNames() == expected.schema.fieldNames() and dict(res.dtypes) == dict(expected.dtypes)
    assert res.exceptAll(expected).isEmpty() and expected.exceptAll(res).isEmpty()
    rejects = unresolved_hops(trips, ls, locs, key_cols=fx.GRID_KEY)
    assert bad.columns == rejects.columns and bad.count() > 100
    assert bad.exceptAll(rejects).isEmpty() and rejects.exceptAll(bad).isEmpty()


def test_frame_of_edge_plans(spark):
    ls, locs = _net(spark)
    a = '"A"'
    plans = {"ok": f"[{hop(a, 'a0')},{hop(None, 'x')}]", "oops": "oops", "empty": "[]", "one": f"[{hop(a, 'a0')}]", "two": f"[{hop(a, 'nowhere')},{hop(chr(34) + 'Z' + chr(34), 'x')}]", "null": None}
    rows = line_net_frame(_trips(spark, plans), ls, locs, key_cols=["trip_key"]).collect()
    assert Counter((r.kind, r.reason) for r in rows) == {("result", None): 3, ("reject", "malformed plan"): 1, ("reject", "station not on its line"): 1, ("reject", "unknown line"): 1}
    assert all((r.sub_station_name is None) == (r.kind == "reject") == (r.distance is None) for r in rows)
    none = line_net_frame(_trips(spark, {"x": None}).where("false"), ls, locs, key_cols=["trip_key"])
    assert none.count() == 0


def test_frame_reads_and_shuffles_the_trips_once(spark):
    trips, ls, locs = _inputs(spark)
    plan = _plan(line_net_frame(trips, ls, locs, gap_mode="exact", key_cols=fx.GRID_KEY))
    assert sum("Exchange hashpartitioning(trip_id" in line for line in plan.splitlines()) == 1
    assert plan.count("FileScan parquet [o_orderkey") == 1 and "SortMergeJoin" not in plan and plan.count("Generate inline") == 2


def test_sink_counts_what_it_writes(spark):
    trips, ls, locs = _inputs(spark)
    path = shared_dir(spark, "test-frame")
    counts = write_line_net_frame(line_net_frame(trips, ls, locs, key_cols=fx.GRID_KEY), path)
    back = spark.read.parquet(path)
    assert counts == {"result_rows": back.where("kind = 'result'").count(), "reject_rows": back.where("kind = 'reject'").count()}
    assert counts["result_rows"] == build_line_net(trips, ls, locs, key_cols=fx.GRID_KEY).count()
    assert counts["reject_rows"] == unresolved_hops(trips, ls, locs, key_cols=fx.GRID_KEY).count() == spark.read.parquet(path + "/kind=reject").count()


def test_stream_into_one_place(spark):
    src, out = shared_dir(spark, "test-frame-in"), shared_dir(spark, "test-frame-out")
    trips, ls, locs = _inputs(spark)
    trips.write.parquet(src + "/a")
    stream = spark.readStream.schema(trips.schema).parquet(src + "/*")
    start_line_net_stream(stream, ls, locs, out, shared_dir(spark, "test-frame-ckpt"), key_cols=fx.GRID_KEY, available_now=True).awaitTermination(300)
    back = spark.read.parquet(out)
    assert back.where("kind = 'reject'").count() == unresolved_hops(trips, ls, locs, key_cols=fx.GRID_KEY).count()
    assert back.where("kind = 'result'").count() == build_line_net(trips, ls, locs, key_cols=fx.GRID_KEY).count()
