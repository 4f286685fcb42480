"""One trip per input row, with and without a key; input edges; readers; rejects; the sink."""

import time

import pytest
from pyspark.sql import functions as F

from lineweave import build_line_net, unresolved_hops
from lineweave import fixtures as fx
from lineweave.operators import clean_locations, explode_hops, first_station_per_line, line_profile, trip_identity
from lineweave.plans import write_line_net
from lineweave.session import shared_dir
from lineweave.sources import line_stations_from_payload, location_scan, read_locations, read_payload, read_trips, trip_scan
from tests.conftest import SF001
from tests.test_edges import TRIP_SCHEMA, _net, _trips, hop

PLAN = f'[{hop(chr(34) + "A" + chr(34), "a0")},{hop(None, "x")}]'


def test_equal_rows_without_a_key_are_trips_of_their_own(spark):
    ls, locs = _net(spark)
    path = shared_dir(spark, "test-equal-trips")
    trips = _trips(spark, {"t": PLAN}).drop("trip_key")
    trips.unionByName(trips).write.parquet(path)
    for source in (spark.read.parquet(path), read_trips(spark, path), trips.unionByName(trips)):
        rows = build_line_net(source, ls, locs).collect()
        assert len(rows) == 6 and len({r.uuid for r in rows}) == 2
    again = build_line_net(spark.read.parquet(path).repartition(3), ls, locs)
    assert {r.uuid for r in again.collect()} == {r.uuid for r in build_line_net(spark.read.parquet(path), ls, locs).collect()}


def test_rows_that_share_a_key_are_set_aside_not_merged(spark):
    ls, locs = _net(spark)
    plan = ("A", "1", "a0", "B", "2", "b2", 1, 1, "t")
    trips = spark.createDataFrame([(*plan, PLAN, "same"), (*plan, PLAN, "same"), (*plan, PLAN, "own")], TRIP_SCHEMA)
    assert build_line_net(trips, ls, locs, key_cols=["trip_key"]).count() == 3
    bad = unresolved_hops(trips, ls, locs, key_cols=["trip_key"]).collect()
    assert len({r.trip_id for r in bad}) == 1 and {r.reason for r in bad} == {"key shared by several trips"}


def test_a_plan_that_fills_the_table_is_numbered_without_one_task(spark):
    plan = trip_identity(trip_scan(fx.plain_plans(spark, SF001)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Window" not in plan


@pytest.mark.parametrize("lead", ["", " ", "\n", "\t", "\r\n \t"])
def test_white_space_before_a_plan(spark, lead):
    ls, locs = _net(spark)
    trips = _trips(spark, {"t": lead + PLAN})
    assert build_line_net(trips, ls, locs, key_cols=["trip_key"]).count() == 3
    assert unresolved_hops(trips, ls, locs, key_cols=["trip_key"]).count() == 0


@pytest.mark.parametrize("bad", ["NaN", "Infinity", "-Infinity", "text", None])
def test_only_finite_coordinates_count(spark, bad):
    ls, locs = _net(spark)
    spoiled = locs.withColumn("longitude", F.when(F.col("station_name") == "a1", F.lit(bad)).otherwise(F.col("longitude")))
    rows = build_line_net(_trips(spark, {"t": PLAN}), ls, spoiled, key_cols=["trip_key"]).collect()
    assert {r.distance for r in rows} == {2049}
    doubles = spark.createDataFrame([("A", "s", float("nan"), 1.0), ("A", "t", 2.0, float("inf"))], "route_name string, station_name string, longitude double, latitude double")
    assert {(r.longitude, r.latitude) for r in location_scan(doubles).collect()} == {(None, 1.0), (2.0, None)}


def test_stations_at_one_position_give_one_distance(spark):
    ls, locs = _net(spark)
    twice = [("A", 1, "q"), ("A", 1, "a1"), ("A", 0, "a0"), ("A", 2, "x")]
    more = locs.unionByName(spark.createDataFrame([("A", "q", "113.015", "23.1")], locs.schema))
    found = set()
    for rows in (twice, twice[::-1]):
        net = spark.createDataFrame(rows, "route string, num int, station string").coalesce(1)
        found |= {r.distance for r in build_line_net(_trips(spark, {"t": PLAN}), net, more, key_cols=["trip_key"]).collect()}
    assert len(found) == 1


def test_line_profile_is_linear_in_a_line(spark):
    empty = clean_locations(location_scan(spark.createDataFrame([], "route_name string, station_name string, longitude string, latitude string")))

    def seconds(n):
        line = spark.range(n).select(F.lit("L").alias("route"), F.col("id").cast("int").alias("num"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("station"))
        t = time.perf_counter()
        line_profile(first_station_per_line(line), empty).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    seconds(1000)
    assert seconds(64_000) < 30


def test_keep_empty_keeps_null_plans_only(spark):
    trips = _trips(spark, {"null": None, "empty": "[]", "bad": "oops", "ok": PLAN})
    rows = explode_hops(trip_identity(trips, ["trip_key"]), keep_empty=True).collect()
    assert sorted((r.trip_key, r.hop, r.station) for r in rows if r.trip_key != "ok") == [("null", 0, None)]
    assert sum(r.trip_key == "ok" for r in rows) == 2
    assert {r.trip_key for r in explode_hops(trip_identity(trips, ["trip_key"])).collect()} == {"ok"}


def test_readers(spark):
    ls, locs = _net(spark)
    path = shared_dir(spark, "test-readers")
    trips = _trips(spark, {"t": PLAN})
    trips.select(*[F.col(c).cast("binary") if t == "string" else c for c, t in trips.dtypes]).write.parquet(path + "/trips")
    locs.write.parquet(path + "/locations")
    payload = 'cb({"lines":[{"lineName":"A","stages":[{"stageId":"1","stageName":"a0"},{"stageId":"2","stageName":"a1"},{"stageId":"3","stageName":"x"}]},{"lineName":"B","stages":[{"stageId":"4","stageName":"b0"}]}]});'
    spark.createDataFrame([(payload,)], "value string").coalesce(1).write.text(path + "/payload")
    read = read_trips(spark, path + "/trips")
    assert dict(read.dtypes)["lines_result"] == "string" and dict(read.dtypes)["line_name"] == "string"
    stations = read_payload(spark, path + "/payload")
    assert sorted(map(tuple, stations.collect())) == sorted(map(tuple, line_stations_from_payload(spark.createDataFrame([(payload,)], "value string")).collect()))
    assert sorted((r.route, r.num, r.station) for r in stations.collect()) == [("A", 0, "a0"), ("A", 1, "a1"), ("A", 2, "x"), ("B", 0, "b0")]
    rows = build_line_net(read, stations, read_locations(spark, path + "/locations")).collect()
    assert len(rows) == 3 and {r.distance for r in rows} == {2048}


def test_rejects_read_and_shuffle_the_trips_once(spark):
    bad = unresolved_hops(fx.grid_trips(spark, SF001, broken=True), fx.grid_line_stations(spark, SF001), fx.grid_locations(spark, SF001), key_cols=fx.GRID_KEY)
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning(trip_id" in line for line in plan.splitlines()) == 1
    assert plan.count("FileScan parquet [o_orderkey") == 1


def test_sink_writes_results_and_rejects(spark):
    ls, locs = _net(spark)
    trips = _trips(spark, {"ok": PLAN, "bad": "oops"})
    path = shared_dir(spark, "test-sink")
    write_line_net(build_line_net(trips, ls, locs, key_cols=["trip_key"]), unresolved_hops(trips, ls, locs, key_cols=["trip_key"]), path)
    assert spark.read.parquet(path + "/result").count() == 3
    assert [r.reason for r in spark.read.parquet(path + "/rejects").collect()] == ["malformed plan"]


def test_dimensions_leave_nothing_persisted(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    ls, locs = _net(spark)
    build_line_net(_trips(spark, {"t": PLAN}), ls, locs, key_cols=["trip_key"]).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
