"""Golden values of the grid fixture (FIXTURES.md §3) and the driver-contract queries."""

import pytest
from pyspark.sql import functions as F

from lineweave import build_line_net
from lineweave import fixtures as fx
from tests.conftest import SF001

GOLDEN = {  # (gap, mode) -> (rows, trips, sum of trip distances)
    (0, "bridge"): (28558, 1500, 35086870),
    (0, "exact"): (28558, 1500, 35086870),
    (17, "bridge"): (28558, 1500, 34547544),
    (17, "exact"): (28558, 1500, 37256943),
}


@pytest.mark.parametrize("gap,mode", sorted(GOLDEN))
def test_grid_golden(spark, gap, mode):
    res = build_line_net(fx.grid_trips(spark, SF001), fx.grid_line_stations(spark, SF001),
                         fx.grid_locations(spark, SF001, gap), gap_mode=mode, key_cols=fx.GRID_KEY)
    per_trip = res.groupBy("uuid").agg(F.min("distance").alias("d"), F.max("distance").alias("e"), F.count("*").alias("n"))
    tot = per_trip.agg(F.sum("n").alias("rows"), F.count("*").alias("trips"), F.sum("d").alias("dist"),
                       F.sum(F.when(F.col("d") != F.col("e"), 1).otherwise(0)).alias("uneven")).collect()[0]
    assert (tot.rows, tot.trips, tot.dist) == GOLDEN[(gap, mode)]
    assert tot.uneven == 0  # the trip total is written on every row


def test_result_schema(spark):
    import __spark_entry__ as se

    df = se.entry(spark)
    assert df.columns == ["uuid", "from_route_name", "from_station_id", "from_station_name", "dest_route_name",
                          "dest_station_id", "dest_station_name", "distance", "count", "price", "spend_time",
                          "transfer_code", "transfer_order", "transfer_route_name", "transfer_station_name",
                          "sub_station_num", "sub_station_name", "longitude", "latitude"]
    types = dict(df.dtypes)
    assert types["distance"] == "int" and types["longitude"] == "double" and types["sub_station_num"] == "int"


def test_distance_independent_of_partitioning(spark):
    trips = fx.grid_trips(spark, SF001)
    a = build_line_net(trips, fx.grid_line_stations(spark, SF001), fx.grid_locations(spark, SF001, 17),
                       gap_mode="exact", key_cols=fx.GRID_KEY)
    b = build_line_net(trips.repartition(7).orderBy(F.rand(3)), fx.grid_line_stations(spark, SF001),
                       fx.grid_locations(spark, SF001, 17), gap_mode="exact", key_cols=fx.GRID_KEY)
    da = {r.uuid: r.distance for r in a.select("uuid", "distance").distinct().collect()}
    db = {r.uuid: r.distance for r in b.select("uuid", "distance").distinct().collect()}
    assert da == db


def test_fallback_without_broadcast_gives_same_result(spark):
    """Dimensions over the size bound are joined without the broadcast hint; same rows."""
    args = (fx.grid_trips(spark, SF001), fx.grid_line_stations(spark, SF001), fx.grid_locations(spark, SF001, 17))
    a = build_line_net(*args, gap_mode="exact", key_cols=fx.GRID_KEY)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = build_line_net(*args, gap_mode="exact", key_cols=fx.GRID_KEY, max_broadcast_rows=1)
        plan = b._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
