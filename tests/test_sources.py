from pyspark.sql import functions as F

from lineweave.session import shared_dir
from lineweave.sources import (
    line_stations_from_pages,
    line_stations_from_payload,
    read_line_stations_csv,
    write_line_stations_csv,
)


def test_payload_callbacks_and_plain_json(spark):
    body = '{"lines":[{"lineName":" 十四号线 ","stages":[{"stageId":"1","stageName":"a(b段)"},{"stageId":"2","stageName":"c"}]}]}'
    texts = [f"jQuery123_456({body})", f"cb({body});\n", body]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = sorted((r.route, r.num, r.station, r.station_id) for r in line_stations_from_payload(df).collect())
    assert rows == sorted([("知识城线", 0, "ab线", "1"), ("知识城线", 1, "c", "2")] * 3)


def test_pages_blocks(spark):
    html = ('<div class="line"><span>L1</span><a>x</a><a>y</a></div>'
            '<div class="line"><span>L2</span><a>z</a></div>')
    df = spark.createDataFrame([(html,)], "html string")
    out = line_stations_from_pages(df, line_pattern=r"<span>([^<]*)</span>", station_pattern=r"<a>([^<]*)</a>",
                                   block_pattern=r'<div class="line">(.*?)</div>')
    assert sorted((r.route, r.num, r.station) for r in out.collect()) == [("L1", 0, "x"), ("L1", 1, "y"), ("L2", 0, "z")]


def test_csv_round_trip_keeps_raw_text(spark):
    rows = [("L,1", 0, ' a "q" '), ("L,1", 1, "b\nc"), ("M", 0, ""), (None, 0, "z")]
    df = spark.createDataFrame(rows, "route string, num int, station string")
    path = shared_dir(spark, "test-csv")
    write_line_stations_csv(df, path)
    back = read_line_stations_csv(spark, path, clean=False)
    got = sorted((tuple(r) for r in back.select("route", "num", "station").collect()), key=str)
    assert got == sorted(rows, key=str)
