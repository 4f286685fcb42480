"""Tasks stay the same size whatever the number of trips."""

import re
import uuid
from collections import Counter

from pyspark.sql import functions as F

from lineweave import build_line_net
from lineweave import fixtures as fx
from lineweave.operators.hops import TASK_TRIPS, by_trip, task_count
from lineweave.operators.skew import hot_values
from lineweave.plans import prepare_dims, stored
from lineweave.plans.naive import build_line_net_naive
from lineweave.session import shared_dir
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _many_trips(spark, n):
    one = fx.grid_trips(spark, SF001).limit(1).drop("trip_key")
    return spark.range(n).selectExpr("cast(id as string) trip_key").crossJoin(one)


def test_partitions_follow_the_trips(spark):
    assert [task_count(n) for n in (0, 1, TASK_TRIPS, TASK_TRIPS + 1, 54_000_000)] == [1, 1, 1, 2, 1648]
    ids = spark.range(50).selectExpr("cast(id as string) trip_id")
    assert by_trip(ids, 50, 5).rdd.getNumPartitions() == 10 and by_trip(ids, 50, 5).count() == 50


def test_a_large_job_names_its_partitions(spark):
    """Adaptive execution would merge the short plan texts of 400,000 trips into few tasks."""
    n = 13 * TASK_TRIPS
    dims = prepare_dims(fx.grid_line_stations(spark, SF001), fx.grid_locations(spark, SF001))
    plan = _plan(build_line_net(_many_trips(spark, n), None, None, gap_mode="exact", key_cols=fx.GRID_KEY, dims=dims))
    assert re.findall(r"Exchange hashpartitioning\(trip_id#\d+, (\d+)\), REPARTITION_BY_NUM", plan) == ["13"]


def test_one_sort_for_all_windows_over_the_hops(spark):
    plan = _plan(build_line_net(fx.grid_trips(spark, SF001), fx.grid_line_stations(spark, SF001), fx.grid_locations(spark, SF001), gap_mode="exact", key_cols=fx.GRID_KEY))
    # the other one counts rows that share a key, while trips are one row each
    assert len(re.findall(r"Sort \[trip_id#", plan)) == 2


def test_buckets_follow_the_trips(spark, monkeypatch):
    trips = fx.grid_trips(spark, SF001)
    monkeypatch.setattr(stored, "task_count", lambda rows: task_count(rows, 50))
    for n, buckets in ((trips.count(), 30), (100, stored.LEAST_BUCKETS)):
        table = f"stored_{uuid.uuid4().hex[:12]}"
        stored.store_trips(trips.limit(n), table, shared_dir(spark, table), key_cols=fx.GRID_KEY)
        told = {r.col_name: r.data_type for r in spark.sql(f"describe extended {table}").collect()}
        assert told["Num Buckets"] == str(buckets) and spark.table(table).count() == n
        spark.sql(f"drop table {table}")


def test_hot_lines_fold_the_plans_once(spark):
    met = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        met.add(1)
        return "h" if x % 3 == 0 else str(x)

    assert hot_values(spark.range(300).select(counted.asNondeterministic()("id").alias("route")), "route", 8) == ["h"]
    assert met.value == 300


def test_naive_plan_shuffles_no_expanded_rows(spark):
    trips, ls, locs = fx.grid_trips(spark, SF001), fx.grid_line_stations(spark, SF001), fx.grid_locations(spark, SF001, 17)
    naive = build_line_net_naive(trips, ls, locs, fx.GRID_KEY)
    plan = _plan(naive)
    assert plan.count("Exchange hashpartitioning(") == 1 and "SortMergeJoin" not in plan
    exact = build_line_net(trips, ls, locs, gap_mode="exact", key_cols=fx.GRID_KEY)
    assert Counter(map(tuple, naive.collect())) == Counter(map(tuple, exact.collect()))
