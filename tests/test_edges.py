"""JSON shapes and network edge cases: bad rows are set aside with a reason, never fail the job."""

from pyspark.sql import functions as F

from lineweave import build_line_net, unresolved_hops

TRIP_SCHEMA = ("line_name string, stage_id string, stage_name string, end_line_name string, end_stage_id string, "
               "end_stage_name string, count int, price int, spend_time string, lines_result string, trip_key string")


def _trips(spark, plans):
    return spark.createDataFrame([("A", "1", "a0", "B", "2", "b2", 1, 1, "t", p, k) for k, p in plans.items()],
                                 TRIP_SCHEMA)


def _net(spark):
    ls = spark.createDataFrame(
        [("A", 0, "a0"), ("A", 1, "a1"), ("A", 2, "x"), ("A", 3, "a1"),  # a1 listed twice on A
         ("B", 0, "b0"), ("B", 1, "x"), ("B", 2, "b2")],
        "route string, num int, station string")
    locs = spark.createDataFrame(
        [("A", "a0", "113.00", "23.0"), ("A", "a1", "113.01", "23.0"), ("A", "x", "113.02", "23.0"),
         ("B", "x", "113.02", "23.0"), ("Q", "x", "113.9", "23.9"),  # second coordinate for x (other line)
         ("B", "b0", "113.03", None),  # longitude without latitude: unlocated
         ("B", "b2", "113.04", "23.0")],
        "route_name string, station_name string, longitude string, latitude string")
    return ls, locs


def hop(line, st, code='"1"'):
    ln = f'"lineName":{line},' if line is not None else ""
    return "{" + ln + f'"stationName":"{st}","stationCode":{code}' + "}"


def test_edge_plans(spark):
    ls, locs = _net(spark)
    plans = {
        "ok": f'[{hop(chr(34) + "A" + chr(34), "a0")},{hop(chr(34) + "B" + chr(34), "x")},{hop(None, "b2")}]',
        "null_line": f'[{hop(chr(34) + "A" + chr(34), "a0")},{hop("null", "x")}]',  # explicit null = carried
        "numeric_code": f'[{hop(chr(34) + "A" + chr(34), "a0", "12")},{hop(None, "a1", "13")}]',
        "empty": "[]",
        "blank": "",
        "object": '{"a":1}',
        "oops": "oops",
        "no_first_line": f'[{hop(None, "a0")},{hop(None, "a1")}]',
        "unknown_line": f'[{hop(chr(34) + "Z" + chr(34), "a0")},{hop(None, "a1")}]',
        "next_not_on_line": f'[{hop(chr(34) + "A" + chr(34), "a0")},{hop(chr(34) + "B" + chr(34), "b0")}]',
        "one_hop": f'[{hop(chr(34) + "A" + chr(34), "a0")}]',
    }
    trips = _trips(spark, plans)
    ids = {r.trip_key: r.h for r in trips.select("trip_key", F.sha2("trip_key", 256).alias("h")).collect()}
    by_id = {v: k for k, v in ids.items()}
    res = build_line_net(trips, ls, locs, key_cols=["trip_key"])
    got = {}
    for r in res.collect():
        got.setdefault(by_id[r.uuid], []).append(r)
    assert set(got) == {"ok", "null_line", "numeric_code"}
    ok = sorted(got["ok"], key=lambda r: (r.transfer_order, r.sub_station_num))
    assert [(r.transfer_order, r.sub_station_name) for r in ok] == [(0, "a0"), (0, "a1"), (0, "x"), (1, "x"), (1, "b2")]
    assert {r.transfer_code for r in got["numeric_code"]} == {"12"}
    assert {r.transfer_route_name for r in got["null_line"]} == {"A"}
    # x resolves to its own line's coordinate, not the other line's
    assert {(r.sub_station_name, r.longitude) for r in ok if r.sub_station_name == "x"} == {("x", 113.02)}
    bad = unresolved_hops(trips, ls, locs, key_cols=["trip_key"]).collect()
    reasons = {(by_id[r.trip_id], r.reason) for r in bad}
    assert ("no_first_line", "first hop has no line") in reasons
    assert ("unknown_line", "unknown line") in reasons
    assert ("next_not_on_line", "next station not on this line") in reasons
    assert {k for k, why in reasons if why == "malformed plan"} == {"blank", "object", "oops"}
    assert not any(k in ("empty", "one_hop", "ok") for k, _ in reasons)


def test_station_listed_twice_uses_first_position(spark):
    ls, locs = _net(spark)
    plans = {"t": f'[{hop(chr(34) + "A" + chr(34), "a0")},{hop(None, "a1")}]'}
    res = build_line_net(_trips(spark, plans), ls, locs, key_cols=["trip_key"]).collect()
    assert sorted(r.sub_station_num for r in res) == [0, 1]
