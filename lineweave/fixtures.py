"""Test inputs derived from the driver tables (nation, orders, pages, part, customer).

Grid network: a 25 x 25 grid of stations ``S<k>`` (k = nation key * 25 + j). Line ``R<r>``
runs along row r (position = column), line ``C<c>`` down column c (position = row), so every
station is an interchange. One trip per order: ride row r1 from (r1, c1) to (r1, c2), change
to column c2, ride to (r2, c2); the last plan element has no lineName (same line as before).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the grid fixture.
GRID = 25
LNG0, LNG_STEP, LNG_JITTER = 113.0, 0.0137, 0.0003
LAT0, LAT_STEP, LAT_JITTER = 23.0, 0.0119, 0.0002


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grid_stations(spark: SparkSession, sf_dir: str, gap: int = 0) -> DataFrame:
    """k, r, c, nm, lng, lat; with ``gap`` > 0, every station with k % gap == 0 is unlocated."""
    nation = _table(spark, sf_dir, "nation")
    ks = nation.select(F.col("n_nationkey"), F.explode(F.sequence(F.lit(0), F.lit(GRID - 1))).alias("j"))
    st = ks.select((F.col("n_nationkey") * GRID + F.col("j")).alias("k"))
    k = F.col("k")
    r = F.expr(f"k div {GRID}").cast("int")
    c = (k % GRID).cast("int")
    lng = F.lit(LNG0) + c.cast("double") * F.lit(LNG_STEP) + ((k * 7) % 11).cast("double") * F.lit(LNG_JITTER)
    lat = F.lit(LAT0) + r.cast("double") * F.lit(LAT_STEP) + ((k * 5) % 13).cast("double") * F.lit(LAT_JITTER)
    if gap > 0:
        missing = (k % gap) == 0
        lng = F.when(~missing, lng)
        lat = F.when(~missing, lat)
    return st.select(k, r.alias("r"), c.alias("c"), F.concat(F.lit("S"), k.cast("string")).alias("nm"),
                     lng.alias("lng"), lat.alias("lat"))


def grid_line_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """route, num, station, station_id: R<r> by column, C<c> by row."""
    st = grid_stations(spark, sf_dir)
    rows = st.select(F.concat(F.lit("R"), F.col("r").cast("string")).alias("route"), F.col("c").alias("num"),
                     F.col("nm").alias("station"), F.col("k").cast("string").alias("station_id"))
    cols = st.select(F.concat(F.lit("C"), F.col("c").cast("string")).alias("route"), F.col("r").alias("num"),
                     F.col("nm").alias("station"), F.col("k").cast("string").alias("station_id"))
    return rows.unionByName(cols)


def grid_locations(spark: SparkSession, sf_dir: str, gap: int = 0) -> DataFrame:
    """route_name, station_name, longitude, latitude as text (one row per line and station)."""
    st = grid_stations(spark, sf_dir, gap)
    out = []
    for prefix, part in (("R", "r"), ("C", "c")):
        out.append(st.select(
            F.concat(F.lit(prefix), F.col(part).cast("string")).alias("route_name"),
            F.col("nm").alias("station_name"),
            F.col("lng").cast("string").alias("longitude"),
            F.col("lat").cast("string").alias("latitude"),
        ))
    return out[0].unionByName(out[1])


def _hop_json(line: Column | None, station: Column, code: Column) -> Column:
    parts = [F.lit("{")]
    if line is not None:
        parts += [F.lit('"lineName":"'), line, F.lit('",')]
    parts += [F.lit('"stationName":"'), station, F.lit('","stationCode":"'), code, F.lit('"}')]
    return F.concat(*parts)


def grid_trips(spark: SparkSession, sf_dir: str, null_status: str | None = None, broken: bool = False,
               spaced: bool = False) -> DataFrame:
    """Trip plans, one per order (``trip_key`` = order key as text).

    ``null_status``: orders with this status get a null plan. ``broken``: some orders get
    unresolvable plans, chosen by ``o_orderkey % 50``: 7 first hop without line, 13 unknown
    line, 19 second station not on the grid, 23 second hop without station, 29 and 31 text that
    is not a JSON array, 37 an empty array. ``spaced``: every third plan text begins with JSON white
    space (line feed, tab, return, blank).
    """
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    r1, c1 = ok % GRID, F.expr(f"(o_orderkey div {GRID}) % {GRID}")
    r2, c2 = ck % GRID, F.expr(f"(o_custkey div {GRID}) % {GRID}")
    k1, k12, k2 = r1 * GRID + c1, r1 * GRID + c2, r2 * GRID + c2
    s = lambda x: x.cast("string")
    line0, line1 = F.concat(F.lit("R"), s(r1)), F.concat(F.lit("C"), s(c2))
    st0, st1, st2 = (F.concat(F.lit("S"), s(x)) for x in (k1, k12, k2))
    hop0 = _hop_json(line0, st0, s(k1))
    hop1 = _hop_json(line1, st1, s(k12))
    hop2 = _hop_json(None, st2, s(k2))
    plan = F.concat(F.lit("["), hop0, F.lit(","), hop1, F.lit(","), hop2, F.lit("]"))
    if broken:
        m = ok % 50
        plan = (
            F.when(m == 7, F.concat(F.lit("["), _hop_json(None, st0, s(k1)), F.lit(","), hop1, F.lit(","), hop2, F.lit("]")))
            .when(m == 13, F.concat(F.lit("["), hop0, F.lit(","), _hop_json(F.concat(F.lit("X"), s(c2)), st1, s(k12)),
                                    F.lit(","), hop2, F.lit("]")))
            .when(m == 19, F.concat(F.lit("["), hop0, F.lit(","), _hop_json(line1, F.concat(F.lit("Z"), s(k12)), s(k12)),
                                    F.lit(","), hop2, F.lit("]")))
            .when(m == 23, F.concat(F.lit('['), hop0, F.lit(',{"lineName":"'), line1, F.lit('","stationCode":"'), s(k12),
                                    F.lit('"},'), hop2, F.lit("]")))
            .when(m == 29, F.lit("oops"))
            .when(m == 31, F.lit('{"a":1}'))
            .when(m == 37, F.lit("[]"))
            .otherwise(plan)
        )
    if spaced:
        plan = F.when(ok % 3 == 0, F.concat(F.lit("\n\t\r "), plan)).otherwise(plan)
    if null_status is not None:
        plan = F.when(F.col("o_orderstatus") != F.lit(null_status), plan)
    return o.select(
        line0.alias("line_name"),
        s(k1).alias("stage_id"),
        st0.alias("stage_name"),
        line1.alias("end_line_name"),
        s(k2).alias("end_stage_id"),
        st2.alias("end_stage_name"),
        ((ck % 5) + 1).cast("int").alias("count"),
        ((ok % 9) + 2).cast("int").alias("price"),
        F.col("o_orderpriority").alias("spend_time"),
        plan.alias("lines_result"),
        s(ok).alias("trip_key"),
    )


# The grid trips are identified by their order key.
GRID_KEY = ["trip_key"]


def customer_locations(spark: SparkSession, sf_dir: str, duplicates: bool = False) -> DataFrame:
    """Raw coordinate rows (text) from ``customer``: route N<nation>, station = customer name.

    Longitude text is unparsable for HOUSEHOLD customers, latitude is missing for MACHINERY; every
    fifth longitude reads NaN, every eleventh latitude Infinity.
    ``duplicates``: every third customer gets a second, shifted coordinate (and every
    seventh a third, unlocated one).
    """
    c = _table(spark, sf_dir, "customer")
    lng = F.lit(113.0) + F.col("c_acctbal") * F.lit(0.0001)
    lat = F.lit(23.0) + (F.col("c_custkey") % 100).cast("double") * F.lit(0.01)

    def rows(lng_col, lat_col):
        return c.select(
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("route_name"),
            F.col("c_name").alias("station_name"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("E"), lng_col.cast("string")))
            .when(F.col("c_custkey") % 5 == 0, F.lit("NaN"))
            .otherwise(lng_col.cast("string")).alias("longitude"),
            F.when(F.col("c_mktsegment") != "MACHINERY",
                   F.when(F.col("c_custkey") % 11 == 0, F.lit("Infinity")).otherwise(lat_col.cast("string")))
            .alias("latitude"),
            F.col("c_custkey"),
        )

    out = rows(lng, lat)
    if duplicates:
        out = out.unionByName(rows(lng + F.lit(0.5), lat - F.lit(0.25)).filter(F.col("c_custkey") % 3 == 0))
        out = out.unionByName(rows(F.lit(None).cast("double"), lat).filter(F.col("c_custkey") % 7 == 0))
    return out.drop("c_custkey")


def pages_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSONP text per page: ``cb<page_id>({"lines":[{"lineName": <title>, "stages": [...]}]});``
    with the page's list links as stages (stageId = ``<page_id>-<position>``)."""
    from lineweave.sources.pages import LINK_PATTERN, TITLE_PATTERN

    p = _table(spark, sf_dir, "pages")
    pid = F.col("page_id").cast("string")
    items = F.regexp_extract_all(F.col("html"), F.lit(LINK_PATTERN), 1)
    stages = F.transform(
        items, lambda x, i: F.struct(F.concat(pid, F.lit("-"), i.cast("string")).alias("stageId"), x.alias("stageName"))
    )
    line = F.struct(F.nullif(F.regexp_extract(F.col("html"), TITLE_PATTERN, 1), F.lit("")).alias("lineName"),
                    stages.alias("stages"))
    body = F.to_json(F.struct(F.array(line).alias("lines")))
    return p.select(F.concat(F.lit("cb"), pid, F.lit("("), body, F.lit(");")).alias("value"))


#: Lines that one payload or page of the grid network holds.
LINES_PER_FILE = 10


def _grid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, route, stops: the grid's lines with their stations in order (at most GRID per line)."""
    ls = grid_line_stations(spark, sf_dir)
    lines = ls.groupBy("route").agg(F.sort_array(F.collect_list(F.struct("num", "station", "station_id"))).alias("stops"))
    number = F.expr("substr(route, 2)").cast("int")
    return lines.select((number % F.lit(2 * GRID // LINES_PER_FILE)).alias("file"), "route", "stops")


def grid_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid network as JSONP texts with several lines each (at most 2 * GRID lines in all)."""
    stage = lambda x: F.struct(x["station_id"].alias("stageId"), x["station"].alias("stageName"))
    line = F.struct(F.col("route").alias("lineName"), F.transform("stops", stage).alias("stages"))
    files = _grid_lines(spark, sf_dir).groupBy("file").agg(F.collect_list(line).alias("lines"))
    return files.select(F.concat(F.lit("net("), F.to_json(F.struct("lines")), F.lit(");\n")).alias("value"))


#: Patterns of the grid network's pages: one block of markup per line.
GRID_BLOCK_PATTERN = r"<section>([\s\S]*?)</section>"
GRID_LINE_PATTERN = r"<h2>([^<]*)</h2>"


def grid_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid network as HTML pages with a block per line."""
    item = lambda x: F.concat(F.lit('<li><a href="#">'), x["station"], F.lit("</a></li>"))
    block = F.concat(F.lit("<section><h2> "), "route", F.lit("\n</h2><ul>"), F.array_join(F.transform("stops", item), "\n"), F.lit("</ul></section>"))
    files = _grid_lines(spark, sf_dir).groupBy("file").agg(F.array_join(F.collect_list(block), "\n").alias("body"))
    return files.select(F.concat(F.lit("<html><title>net</title>"), "body", F.lit("</html>")).alias("html"))


def plain_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans without any key, three attributes for all of them and every other row doubled: many rows
    are equal, each is a trip of its own."""
    trips = grid_trips(spark, sf_dir)
    keep = trips.select("line_name", "stage_id", "stage_name", "lines_result", (F.col("trip_key").cast("long") % 2).alias("m"))
    return keep.unionByName(keep.filter("m = 0")).drop("m")


def markup_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, html: saved pages with nested blocks, made from ``customer``. Ten customers in a row are the
    stations of a line, five lines a page. Around them stand decoys (comments, scripts, lists outside the
    list's element, names that aren't the line's). Where ``page_id % 11 = 5`` there is no list, where
    ``page_id % 7 = 3`` the page breaks off in its last block, and line ``l`` has no name where ``l % 13 = 4``."""
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    line = F.expr("c_custkey div 10")
    stop = F.struct("c_custkey", F.concat(
        F.lit('<div class="s"><p>no. <a title="a > b" href=\'?x=1&y="2"\'>\n<b>'), "c_name", F.lit("</b> &amp; &#x4E2D;&#65;</a></div>")).alias("html"))
    lines = c.groupBy(line.alias("l")).agg(F.array_sort(F.collect_list(stop)).alias("stops"))
    head = F.when(F.col("l") % 13 == 4, F.lit("<div class='no'><b>none</b></div>")).otherwise(
        F.concat(F.lit('<div class="big no"><!-- <span>x</span> --><div><SPAN>Line &quot;'), F.col("l").cast("string"), F.lit("&quot;<br></SPAN><span> &lt;2&gt;</span></div></div>")))
    body = F.array_join(F.transform("stops", lambda x: x["html"]), "\n")
    block = F.concat(F.lit("<div class=l><a>map</a>"), head, F.lit('<div><div class="stage_background wide"><div>'), body, F.lit("</div></div></div>"))
    page = F.expr("l div 5")
    blocks = lines.select(page.alias("page_id"), F.struct("l", block.alias("html")).alias("b"))
    pages = blocks.groupBy("page_id").agg(F.array_sort(F.collect_list("b")).alias("bs"))
    closed = F.array_join(F.transform("bs", lambda x: x["html"]), "</div>\n<!-- <div> -->")
    end = F.when(F.col("page_id") % 7 == 3, F.lit("")).otherwise(F.lit("</div></div><div class=no><span>end</span></div></body></html>"))
    name = F.when(F.col("page_id") % 11 == 5, F.lit("other")).otherwise(F.lit("lineAndStation"))
    return pages.select("page_id", F.concat(
        F.lit("<html><head><script>if (a<b) write('<div id=lineAndStation>')</script></head><body><div class=\"stage_background\"><a>out</a></div><div id='"), name, F.lit("'>"), closed, end).alias("html"))


#: Plans of one element as other producers send them; <r> and <k> stand for numbers of the order.
ELEMENT_PLANS = [
    '[{"lineName":"R<r>","stationName":"S<k>","stationCode":<k>}]',
    '[{"lineName":"R<r>","stationName":"S<k>","stationCode":{"id":<k>}}]',
    '[{"lineName":<r>,"stationName":"S<k>","stationCode":"<k>"}]',
    '[{"lineName":["R<r>"],"stationName":"S<k>"}]',
    '["S<k>",{"stationName":"S<k>","stationCode":null}]',
    '[{"line":"R<r>","station":"S<k>","code":true}]',
    '[{"lineName":null,"line":"R<r>","stop":"S<k>"}]',
    '{"lineName":"R<r>"}',
    '[{"stationName":"S<k>"',
    '[]',
    ' [ {"lineName":"R<r>","stationName":"","stationCode":-<k>}, 5, null ] ',
    '"S<k>"',
]


def element_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trip_key, lines_result: one of :data:`ELEMENT_PLANS` for every order, null for one in thirteen."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    plan = F.get(F.array(*[F.lit(t) for t in ELEMENT_PLANS]), (F.col("o_orderkey") % 13).cast("int"))
    number = lambda c: (F.col(c) % 1000).cast("string")
    text = F.replace(F.replace(plan, F.lit("<r>"), number("o_orderkey")), F.lit("<k>"), number("o_custkey"))
    return o.select(F.col("o_orderkey").cast("string").alias("trip_key"), text.alias("lines_result"))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text column ``value``: a CSV record (key, position, price, count, note) for every order; some have words, nothing or
    too much where a number belongs, a field less or more, or quotes and commas in the note."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    k, s = F.col("o_orderkey"), lambda c: c.cast("string")
    m = k % 17
    num = F.when(m == 3, F.lit("x")).when(m == 4, F.lit("")).when(m == 5, F.lit("99999999999")).when(m == 6, F.concat(F.lit(" "), s(k % 50), F.lit(" "))).otherwise(s(k % 50))
    price = F.when(m.isin(3, 7), F.concat(F.lit("$"), s(k % 9))).when(m == 8, F.lit("2.5")).otherwise(s(k % 9))
    count = F.when(m == 9, F.lit("1e2x")).when(m == 10, F.lit("")).otherwise(s(F.col("o_custkey") % 5))
    note = F.when(m == 11, F.concat(F.lit('"a ""b"", '), s(k), F.lit('"'))).otherwise(F.col("o_orderpriority"))
    tail = F.when(m == 13, F.lit(",more")).otherwise(F.lit(""))
    whole = F.concat_ws(",", s(k), num, price, count, note)
    return o.select(F.when(m == 12, F.concat_ws(",", s(k), num)).otherwise(F.concat(whole, tail)).alias("value"))


def customer_line(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(stations, locations): all customers on one line, three at each position; every sixth has no
    coordinate, and so have long stretches."""
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    k = F.col("c_custkey")
    stations = c.select(F.lit("all").alias("route"), F.expr("c_custkey div 3 * 1000").cast("int").alias("num"), F.col("c_name").alias("station"))
    there = (k % 6 != 0) & (F.expr("c_custkey div 100") % 4 != 1)
    lng, lat = F.lit(113.0) + F.col("c_acctbal") * F.lit(0.0001), F.lit(23.0) + (k % 100).cast("double") * F.lit(0.01)
    locations = c.select(F.lit("all").alias("route_name"), F.col("c_name").alias("station_name"), F.when(there, lng).alias("longitude"), F.when(there, lat).alias("latitude"))
    return stations, locations


# Names the alias rules rewrite (used to build test names).
ALIAS_SOURCES = ["机场北（2号航站楼）", "十四号线", "虫雷 岗", "清㘵", "APM", "三北线"]


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_partkey, name_in: names built from ``part`` covering every cleaning rule by
    ``p_partkey % 10`` (plain, parenthesis with section suffix, control characters, alias,
    contains-alias, empty and inverted parentheses, full-width parentheses, null, spaced)."""
    p = _table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    alias = F.element_at(F.array(*[F.lit(a) for a in ALIAS_SOURCES]), (F.expr("p_partkey div 10") % 6 + 1).cast("int"))
    m = k % 10
    name = (
        F.when(m == 0, F.col("p_name"))
        .when(m == 1, F.concat(F.col("p_brand"), F.lit("("), F.col("p_type"), F.lit("段)"), F.col("p_name")))
        .when(m == 2, F.concat(F.lit(" \t"), F.col("p_type"), F.lit("\n")))
        .when(m == 3, alias)
        .when(m == 4, F.concat(F.lit("x机场南（1号航站楼）"), F.col("p_brand")))
        .when(m == 5, F.concat(F.col("p_name"), F.lit("()")))
        .when(m == 6, F.concat(F.lit(")"), F.col("p_brand"), F.lit("(")))
        .when(m == 7, F.concat(F.col("p_type"), F.lit("（"), F.col("p_brand"), F.lit("）")))
        .when(m == 9, F.concat(F.col("p_brand"), F.lit(" ("), F.col("p_type"), F.lit(")")))
    )
    return p.select("p_partkey", name.alias("name_in"))
