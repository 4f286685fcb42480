"""Dimensions beyond the broadcast limit with a hot line, very long lines, trips stored by their id."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from lineweave import build_line_net, unresolved_hops
from lineweave import fixtures as fx
from lineweave.operators import clean_locations, first_station_per_line, line_profile, line_profile_split
from lineweave.operators.legs import leg_slices
from lineweave.operators.skew import SALT, hot_values, replicated, salted
from lineweave.plans import hop_legs, line_net_frame, prepare_dims
from lineweave.plans.linenet import spread_dims
from lineweave.plans.stored import store_trips, stored_line_net
from lineweave.session import shared_dir
from lineweave.sources import location_scan
from tests.conftest import SF001
from tests.test_edges import TRIP_SCHEMA


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _hot_trips(spark, n, lines):
    """A third of the trips ride line 0."""
    line = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % lines)
    name = F.concat(F.lit("L"), line.cast("string"))
    stop = lambda k: F.concat(F.lit('"stationName":"s'), line.cast("string"), F.lit("-"), F.lit(k).cast("string"), F.lit('"'))
    plan = F.concat(F.lit('[{"lineName":"'), name, F.lit('",'), stop(1), F.lit("},{"), stop(8), F.lit("}]"))
    columns = {c: F.lit("x") for c in ("line_name", "stage_id", "stage_name", "end_line_name", "end_stage_id", "end_stage_name", "spend_time")}
    rows = spark.range(n).withColumns({**columns, "count": F.lit(1), "price": F.lit(1), "lines_result": plan, "trip_key": F.col("id").cast("string")})
    return rows.select(*[f.split(" ")[0] for f in TRIP_SCHEMA.split(", ")])


def _line_stations(spark, lines):
    return spark.range(lines * 10).select(
        F.concat(F.lit("L"), F.expr("id div 10").cast("string")).alias("route"), (F.col("id") % 10).cast("int").alias("num"),
        F.concat(F.lit("s"), F.expr("id div 10").cast("string"), F.lit("-"), (F.col("id") % 10).cast("string")).alias("station"))


def test_a_hot_line_is_spread_when_nothing_is_broadcast(spark, no_broadcast):
    lines, n = 200, 30_000
    trips, ls = _hot_trips(spark, n, lines), _line_stations(spark, lines)
    locs = spark.createDataFrame([], "route_name string, station_name string, longitude double, latitude double")
    dims = prepare_dims(ls, locs)
    assert dims.large
    spread = spread_dims(dims, trips)
    assert spread.hot == ["L0"]
    legs = hop_legs(trips, spread, ["trip_key"]).where("not is_last")
    passed = leg_slices(legs, spread.bare_lines())
    assert "BroadcastHashJoin" not in _plan(passed)
    tasks = sorted(r["count"] for r in passed.groupBy(F.spark_partition_id()).count().collect())
    assert sum(tasks) == n and tasks[-1] <= 2 * tasks[len(tasks) // 2]
    assert passed.select(F.sum(F.size("passed"))).first()[0] == 8 * n


@pytest.mark.parametrize("mode", ["bridge", "exact"])
def test_same_rows_with_and_without_a_broadcast(spark, mode):
    trips = fx.grid_trips(spark, SF001, broken=True)
    trips = trips.unionByName(trips.where("trip_key % 10 = 0").withColumn("trip_key", F.concat("trip_key", F.lit("x"))))
    ls, locs = fx.grid_line_stations(spark, SF001), fx.grid_locations(spark, SF001, 17)
    for job in (build_line_net, line_net_frame):
        plain = job(trips, ls, locs, gap_mode=mode, key_cols=fx.GRID_KEY)
        large = job(trips, ls, locs, gap_mode=mode, key_cols=fx.GRID_KEY, max_broadcast_rows=0)
        assert plain.exceptAll(large).isEmpty() and large.exceptAll(plain).isEmpty()
    a, b = (unresolved_hops(trips, ls, locs, key_cols=fx.GRID_KEY, max_broadcast_rows=rows) for rows in (None, 0))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hot_values_are_bounded_and_salts_meet(spark):
    df = spark.range(1000).select(F.col("id").alias("t"), F.when(F.col("id") < 400, F.lit("h")).otherwise(F.col("id").cast("string")).alias("route"))
    hot = hot_values(df, "route", 8)
    assert hot == ["h"] and hot_values(df.limit(0), "route") == []
    left, right = salted(df, hot, "t"), replicated(df.select("route").distinct(), hot)
    assert left.join(right, ["route", SALT]).count() == 1000 and left.where("route = 'h'").select(SALT).distinct().count() > 8
    assert salted(df, [], "t").select(SALT).distinct().count() == 1


def _locations(spark, rows):
    return clean_locations(location_scan(spark.createDataFrame(rows, "route_name string, station_name string, longitude double, latitude double")))


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_block_scan_equals_the_window(spark, parts):
    """Lines of few and many stations, shared positions, whole blocks without a coordinate."""
    rng = random.Random(parts)
    stations, points = [], []
    for line, n in [("A", 1), ("B", 2), ("C", 40), ("D", 150), ("E", 30)]:
        for i in range(n):
            name = f"{line}{rng.randrange(10**6)}"
            stations.append((line, rng.choice([i, i // 2 * 10]), name))
            if line != "E" and rng.random() < (0.05 if 40 < i < 110 else 0.7):
                points.append((line, name, 113 + rng.random(), 23 + rng.random()))
    index = first_station_per_line(spark.createDataFrame(stations, "route string, num int, station string"))
    locs = _locations(spark, points)
    window, blocks = line_profile(index, locs), line_profile_split(index, locs, parts)
    assert set(window.columns) == set(blocks.columns)
    rows = lambda df: sorted(map(str, df.select(*sorted(window.columns)).collect()))
    assert rows(blocks) == rows(window)


def test_one_line_of_a_million_stations_is_many_tasks(spark):
    n = 1_000_000
    line = spark.range(n).select(F.lit("L").alias("route"), F.col("id").cast("int").alias("num"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("station"))
    prof = line_profile_split(line, _locations(spark, [("L", "s0", 113.0, 23.0), ("L", "s999999", 113.5, 23.0)]), parts=8)
    per_block = [r["count"] for r in spark.read.parquet(*_written(prof)).groupBy("_block").count().collect()]
    assert len(per_block) == 8 and max(per_block) < n / 4
    row = prof.where("num = 999999").select("idx", "cum_m", "prev_loc_num").first()
    assert (row.idx, row.prev_loc_num) == (n - 1, 0) and row.cum_m > 50_000


def _written(df):
    return [f for f in df.inputFiles() if "profile-segments" in f]


@pytest.mark.parametrize("keyed", [True, False])
def test_a_rerun_on_stored_trips_shuffles_none(spark, keyed):
    trips, ls = fx.grid_trips(spark, SF001, broken=True), fx.grid_line_stations(spark, SF001)
    keys = fx.GRID_KEY if keyed else None
    table = f"trips_{uuid.uuid4().hex[:8]}"
    store_trips(trips, table, shared_dir(spark, table), 4, keys)
    for gap, mode in ((0, "bridge"), (17, "exact")):
        locs = fx.grid_locations(spark, SF001, gap)
        again = stored_line_net(spark, table, prepare_dims(ls, locs), gap_mode=mode)
        assert "Exchange hashpartitioning" not in _plan(again) and "SelectedBucketsCount" in _plan(again)
        fresh = build_line_net(trips, ls, locs, gap_mode=mode, key_cols=keys)
        assert again.exceptAll(fresh).isEmpty() and fresh.exceptAll(again).isEmpty()
    spark.sql(f"DROP TABLE {table}")
