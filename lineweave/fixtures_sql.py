"""DuckDB text of the fixtures in :mod:`lineweave.fixtures` and of the expected result of every
registered query (the correctness oracle). Written from the semantics, with plain SQL windows
and joins, independently of the Spark operators (which use prefix sums and broadcast lookups).

Tables ``nation orders customer part pages`` are the driver's views.
"""

from __future__ import annotations

# Fixed values of the expected results, written out here so that a wrong value in the code under
# test can't pass its own oracle.
GRID = 25
ALIAS_SOURCES = ["机场北（2号航站楼）", "十四号线", "虫雷 岗", "清㘵", "APM", "三北线"]
ALIAS_RULES = [
    ("equals", "机场北（2号航站楼）", "机场北"),
    ("contains", "机场南（1号航站楼）", "机场南"),
    ("equals", "十四号线", "知识城线"),
    ("equals", "虫雷 岗", "虫雷岗"),
    ("equals", "清㘵", "清土布"),
    ("equals", "APM", "APM线"),
    ("equals", "三北线", "三号线北延线"),
]
SECTION_CHAR, LINE_CHAR = "段", "线"
TITLE_PATTERN = "<title>([^<]*)</title>"
LINK_PATTERN = "<li><a[^>]*>([^<]*)</a></li>"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def rules_sql(t: str) -> str:
    """Alias and parenthesis rules on already trimmed text ``t`` (a column name)."""
    parts = ["CASE"]
    for kind, pattern, replacement in ALIAS_RULES:
        cond = f"{t} = {_lit(pattern)}" if kind == "equals" else f"contains({t}, {_lit(pattern)})"
        parts.append(f"WHEN {cond} THEN {_lit(replacement)}")
    p, q = f"instr({t}, '(')", f"instr({t}, ')')"
    inside = f"substr({t}, {p} + 1, {q} - {p} - 1)"
    paren = (
        f"substr({t}, 1, {p} - 1) || CASE WHEN right({inside}, 1) = {_lit(SECTION_CHAR)} "
        f"THEN substr({inside}, 1, length({inside}) - 1) || {_lit(LINE_CHAR)} ELSE {inside} END"
    )
    parts.append(f"WHEN {p} > 0 AND {q} > {p} + 1 THEN {paren}")
    parts.append(f"ELSE {t} END")
    return " ".join(parts)


def canon_sql(x: str) -> str:
    return rules_sql(f"({trim_sql(x)})")


def dist_sql(lng1: str, lat1: str, lng2: str, lat2: str) -> str:
    def rad(d):
        return f"(({d}) * pi() / 180.0::DOUBLE)"

    a = f"({rad(lat1)} - {rad(lat2)})"
    b = f"({rad(lng1)} - {rad(lng2)})"
    s = (
        f"(2.0::DOUBLE * asin(sqrt(pow(sin({a} / 2.0::DOUBLE), 2.0::DOUBLE) + cos({rad(lat1)}) * cos({rad(lat2)})"
        f" * pow(sin({b} / 2.0::DOUBLE), 2.0::DOUBLE))) * 6378.137::DOUBLE)"
    )
    return f"CAST(trunc(floor({s} * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE * 1000.0::DOUBLE) AS INTEGER)"


# ---------------------------------------------------------------- grid fixture


def grid_ctes(gap: int = 0, broken: bool = False) -> str:
    """CTEs: st, ls, lsd, loc, co, cn, prof, trips, hops_raw, hops."""
    lng = (
        "113.0::DOUBLE + CAST(k % 25 AS DOUBLE) * 0.0137::DOUBLE"
        " + CAST((k * 7) % 11 AS DOUBLE) * 0.0003::DOUBLE"
    )
    lat = (
        "23.0::DOUBLE + CAST(k // 25 AS DOUBLE) * 0.0119::DOUBLE"
        " + CAST((k * 5) % 13 AS DOUBLE) * 0.0002::DOUBLE"
    )
    if gap:
        lng = f"CASE WHEN k % {gap} = 0 THEN NULL ELSE {lng} END"
        lat = f"CASE WHEN k % {gap} = 0 THEN NULL ELSE {lat} END"
    m = "(o_orderkey % 50)"
    if broken:
        r0 = f"CASE WHEN {m} = 7 THEN NULL ELSE 'R' || r1 END"
        r1 = f"CASE WHEN {m} = 13 THEN 'X' || c2 ELSE 'C' || c2 END"
        s1 = f"CASE WHEN {m} = 19 THEN 'Z' || k12 WHEN {m} = 23 THEN NULL ELSE 'S' || k12 END"
        keep = f"WHERE {m} NOT IN (29, 31, 37)"
    else:
        r0, r1, s1, keep = "'R' || r1", "'C' || c2", "'S' || k12", ""
    return f"""
st AS (
  SELECT k, CAST(k // {GRID} AS INTEGER) AS r, CAST(k % {GRID} AS INTEGER) AS c, 'S' || k AS nm,
         {lng} AS lng, {lat} AS lat
  FROM (SELECT CAST(n_nationkey AS INTEGER) * {GRID} + CAST(j AS INTEGER) AS k
        FROM nation CROSS JOIN (SELECT unnest(range({GRID})) AS j) g) s
),
ls AS (
  SELECT 'R' || r AS route, c AS num, nm AS station, CAST(k AS VARCHAR) AS station_id FROM st
  UNION ALL SELECT 'C' || c, r, nm, CAST(k AS VARCHAR) FROM st
),
lsd AS (SELECT route, station, min(num) AS num FROM ls GROUP BY route, station),
loc AS (
  SELECT 'R' || r AS route_name, nm AS station_name, lng AS longitude, lat AS latitude FROM st
  UNION ALL SELECT 'C' || c, nm, lng, lat FROM st
),
co AS (
  SELECT route_name, station_name, longitude, latitude FROM (
    SELECT *, row_number() OVER (PARTITION BY route_name, station_name ORDER BY longitude, latitude) AS rn
    FROM loc WHERE longitude IS NOT NULL AND latitude IS NOT NULL) x WHERE rn = 1
),
cn AS (
  SELECT station_name, longitude, latitude FROM (
    SELECT *, row_number() OVER (PARTITION BY station_name ORDER BY longitude, latitude) AS rn
    FROM loc WHERE longitude IS NOT NULL AND latitude IS NOT NULL) x WHERE rn = 1
),
prof AS (
  SELECT l.route, l.num, l.station,
         CASE WHEN co.longitude IS NOT NULL THEN co.longitude ELSE cn.longitude END AS lng,
         CASE WHEN co.longitude IS NOT NULL THEN co.latitude ELSE cn.latitude END AS lat
  FROM lsd l
  LEFT JOIN co ON co.route_name = l.route AND co.station_name = l.station
  LEFT JOIN cn ON cn.station_name = l.station
),
tk AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         o_orderkey % {GRID} AS r1, (o_orderkey // {GRID}) % {GRID} AS c1,
         o_custkey % {GRID} AS r2, (o_custkey // {GRID}) % {GRID} AS c2
  FROM orders
),
trips AS (
  SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS trip_id, o_orderkey, o_orderstatus,
         'R' || r1 AS line_name, CAST(k1 AS VARCHAR) AS stage_id, 'S' || k1 AS stage_name,
         'C' || c2 AS end_line_name, CAST(k2 AS VARCHAR) AS end_stage_id, 'S' || k2 AS end_stage_name,
         CAST(o_custkey % 5 + 1 AS INTEGER) AS count, CAST(o_orderkey % 9 + 2 AS INTEGER) AS price,
         o_orderpriority AS spend_time, r1, c1, r2, c2, k1, k12, k2
  FROM (SELECT *, r1 * {GRID} + c1 AS k1, r1 * {GRID} + c2 AS k12, r2 * {GRID} + c2 AS k2 FROM tk) x
),
hops_raw AS (
  SELECT trip_id, 0 AS hop, {r0} AS route_raw, 'S' || k1 AS station, CAST(k1 AS VARCHAR) AS code FROM trips {keep}
  UNION ALL SELECT trip_id, 1, {r1}, {s1}, CAST(k12 AS VARCHAR) FROM trips {keep}
  UNION ALL SELECT trip_id, 2, NULL, 'S' || k2, CAST(k2 AS VARCHAR) FROM trips {keep}
),
hops AS (
  SELECT *, last_value(route_raw IGNORE NULLS) OVER (PARTITION BY trip_id ORDER BY hop
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS route
  FROM hops_raw
)"""


LEG_CTES = """
hd AS (
  SELECT * EXCLUDE (mh) FROM (
    SELECT *, min(hop) OVER (PARTITION BY trip_id, route, station) AS mh FROM hops) x
  WHERE hop = mh
),
lg AS (
  SELECT *, lead(station) OVER (PARTITION BY trip_id ORDER BY hop) AS next_station,
         (lead(hop) OVER (PARTITION BY trip_id ORDER BY hop)) IS NULL AS is_last
  FROM hd
),
lb AS (
  SELECT lg.*, o.num AS o_num, d.num AS d_num, least(o.num, d.num) AS lo, greatest(o.num, d.num) AS hi
  FROM lg
  LEFT JOIN lsd o ON o.route = lg.route AND o.station = lg.station
  LEFT JOIN lsd d ON d.route = lg.route AND d.station = lg.next_station
),
badt AS (
  SELECT DISTINCT trip_id FROM lb
  WHERE route IS NULL OR station IS NULL OR o_num IS NULL OR (NOT is_last AND d_num IS NULL)
),
legs AS (SELECT * FROM lb WHERE NOT is_last AND trip_id NOT IN (SELECT trip_id FROM badt)),
legst AS (
  SELECT g.trip_id, g.hop, g.route, g.station, g.code, g.lo, g.hi, p.num, p.station AS sub_station,
         p.lng, p.lat
  FROM legs g JOIN prof p ON p.route = g.route AND p.num BETWEEN g.lo AND g.hi
),
pairs AS (
  SELECT *,
    lag(num) OVER w AS pnum, lag(lng) OVER w AS plng, lag(lat) OVER w AS plat,
    last_value(CASE WHEN lng IS NOT NULL AND lat IS NOT NULL THEN lng END IGNORE NULLS) OVER wb AS blng,
    last_value(CASE WHEN lng IS NOT NULL AND lat IS NOT NULL THEN lat END IGNORE NULLS) OVER wb AS blat
  FROM legst
  WINDOW w AS (PARTITION BY trip_id, hop ORDER BY num),
         wb AS (PARTITION BY trip_id, hop ORDER BY num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
seg AS (
  SELECT *,
    CASE WHEN pnum IS NOT NULL AND plng IS NOT NULL AND plat IS NOT NULL AND lng IS NOT NULL AND lat IS NOT NULL
         THEN {plain} END AS segment_m,
    CASE WHEN lng IS NOT NULL AND lat IS NOT NULL AND blng IS NOT NULL THEN {bridged} ELSE 0 END AS bridged_m,
    CASE WHEN pnum IS NOT NULL AND plng IS NOT NULL AND plat IS NOT NULL THEN 1 ELSE 0 END AS a_ok,
    CASE WHEN pnum IS NOT NULL AND lng IS NOT NULL AND lat IS NOT NULL THEN 1 ELSE 0 END AS b_ok
  FROM pairs
),
ex AS (
  SELECT *,
    max(a_ok * b_ok) OVER r AS started,
    last_value(CASE WHEN a_ok = 1 THEN plng END IGNORE NULLS) OVER r AS ea_lng,
    last_value(CASE WHEN a_ok = 1 THEN plat END IGNORE NULLS) OVER r AS ea_lat,
    last_value(CASE WHEN b_ok = 1 THEN lng END IGNORE NULLS) OVER r AS eb_lng,
    last_value(CASE WHEN b_ok = 1 THEN lat END IGNORE NULLS) OVER r AS eb_lat
  FROM seg
  WINDOW r AS (PARTITION BY trip_id ORDER BY hop, num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
exc AS (
  SELECT *, CASE WHEN pnum IS NOT NULL AND started = 1 THEN {exact} ELSE 0 END AS contrib FROM ex
),
dist_bridge AS (SELECT trip_id, CAST(sum(bridged_m) AS INTEGER) AS distance FROM seg GROUP BY trip_id),
dist_exact AS (SELECT trip_id, CAST(sum(contrib) AS INTEGER) AS distance FROM exc GROUP BY trip_id)""".format(
    plain=dist_sql("plng", "plat", "lng", "lat"),
    bridged=dist_sql("blng", "blat", "lng", "lat"),
    exact=dist_sql("ea_lng", "ea_lat", "eb_lng", "eb_lat"),
)


def with_grid(body: str, gap: int = 0, broken: bool = False, legs: bool = True) -> str:
    ctes = grid_ctes(gap, broken) + ("," + LEG_CTES if legs else "")
    return f"WITH {ctes}\n{body}"


def trip_json_sql() -> str:
    hop = lambda line, st, code: (
        "'{" + (f'"lineName":"\' || {line} || \'",' if line else "")
        + f'"stationName":"\' || {st} || \'","stationCode":"\' || {code} || \'"' + "}'"
    )
    return (
        "'[' || " + hop("'R' || r1", "'S' || k1", "k1") + " || ',' || "
        + hop("'C' || c2", "'S' || k12", "k12") + " || ',' || " + hop(None, "'S' || k2", "k2") + " || ']'"
    )


RESULT_SELECT = """
SELECT t.trip_id AS uuid, t.line_name AS from_route_name, t.stage_id AS from_station_id,
       t.stage_name AS from_station_name, t.end_line_name AS dest_route_name,
       t.end_stage_id AS dest_station_id, t.end_stage_name AS dest_station_name, d.distance,
       t.count, t.price, t.spend_time, s.code AS transfer_code, s.hop AS transfer_order,
       s.route AS transfer_route_name, s.station AS transfer_station_name, s.num AS sub_station_num,
       s.sub_station AS sub_station_name, s.lng AS longitude, s.lat AS latitude
FROM legst s JOIN trips t ON t.trip_id = s.trip_id JOIN {dist} d ON d.trip_id = s.trip_id"""


REJECTS = """
SELECT trip_id, hop, route, station, code, reason FROM (
  SELECT lb.trip_id, lb.hop, lb.route, lb.station, lb.code,
    CASE WHEN lb.route IS NULL THEN 'first hop has no line'
         WHEN lb.station IS NULL THEN 'hop has no station'
         WHEN lb.route NOT IN (SELECT route FROM lsd) THEN 'unknown line'
         WHEN lb.o_num IS NULL THEN 'station not on its line'
         WHEN NOT lb.is_last AND lb.d_num IS NULL THEN 'next station not on this line'
    END AS reason
  FROM lb) x
WHERE reason IS NOT NULL
UNION ALL
SELECT trip_id, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'malformed plan'
FROM trips WHERE o_orderkey % 50 IN (29, 31)"""


# ---------------------------------------------------------------- other fixtures


def pages_ctes() -> str:
    return f"""
pg AS (
  SELECT page_id, nullif(regexp_extract(html, {_lit(TITLE_PATTERN)}, 1), '') AS title,
         regexp_extract_all(html, {_lit(LINK_PATTERN)}, 1) AS items
  FROM pages
),
pgi AS (SELECT page_id, title, items, generate_subscripts(items, 1) AS i FROM pg),
praw AS (SELECT page_id, title AS route, CAST(i - 1 AS INTEGER) AS num, items[i] AS station FROM pgi),
ptrim AS (
  SELECT page_id, num, {trim_sql('route')} AS route, {trim_sql('station')} AS station,
         {trim_sql("CAST(page_id AS VARCHAR) || '-' || CAST(num AS VARCHAR)")} AS station_id
  FROM praw
),
pclean AS (
  SELECT page_id, {rules_sql('route')} AS route, num, {rules_sql('station')} AS station,
         {rules_sql('station_id')} AS station_id
  FROM ptrim
)"""


def customer_locations_ctes(duplicates: bool = False) -> str:
    lng = "(113.0::DOUBLE + c_acctbal * 0.0001::DOUBLE)"
    lat = "(23.0::DOUBLE + CAST(c_custkey % 100 AS DOUBLE) * 0.01::DOUBLE)"

    def rows(lng_e, lat_e, where=""):
        return (
            f"SELECT 'N' || c_nationkey AS route_name, c_name AS station_name, "
            f"CASE WHEN c_mktsegment = 'HOUSEHOLD' OR c_custkey % 5 = 0 THEN NULL ELSE {lng_e} END AS longitude, "
            f"CASE WHEN c_mktsegment <> 'MACHINERY' AND c_custkey % 11 <> 0 THEN {lat_e} END AS latitude FROM customer {where}"
        )

    body = rows(lng, lat)
    if duplicates:
        body += " UNION ALL " + rows(f"({lng} + 0.5::DOUBLE)", f"({lat} - 0.25::DOUBLE)", "WHERE c_custkey % 3 = 0")
        body += " UNION ALL " + rows("CAST(NULL AS DOUBLE)", lat, "WHERE c_custkey % 7 = 0")
    return f"cl AS ({body})"


def part_names_sql() -> str:
    arr = "[" + ", ".join(_lit(a) for a in ALIAS_SOURCES) + "]"
    return f"""
SELECT p_partkey, CASE p_partkey % 10
  WHEN 0 THEN p_name
  WHEN 1 THEN p_brand || '(' || p_type || '段)' || p_name
  WHEN 2 THEN ' ' || chr(9) || p_type || chr(10)
  WHEN 3 THEN {arr}[CAST((p_partkey // 10) % 6 + 1 AS INTEGER)]
  WHEN 4 THEN 'x机场南（1号航站楼）' || p_brand
  WHEN 5 THEN p_name || '()'
  WHEN 6 THEN ')' || p_brand || '('
  WHEN 7 THEN p_type || '（' || p_brand || '）'
  WHEN 9 THEN p_brand || ' (' || p_type || ')'
  END AS name_in
FROM part"""


#: The element plans of the fixture, with what has to come out of each: (hop, line, station, code, reason).
ELEMENT_PLANS = [
    ('[{"lineName":"R<r>","stationName":"S<k>","stationCode":<k>}]', [(0, "R<r>", "S<k>", "<k>", None)]),
    ('[{"lineName":"R<r>","stationName":"S<k>","stationCode":{"id":<k>}}]', [(0, "R<r>", "S<k>", None, "stationCode is not a primitive")]),
    ('[{"lineName":<r>,"stationName":"S<k>","stationCode":"<k>"}]', [(0, "<r>", "S<k>", "<k>", None)]),
    ('[{"lineName":["R<r>"],"stationName":"S<k>"}]', [(0, None, "S<k>", None, "lineName is not a primitive")]),
    ('["S<k>",{"stationName":"S<k>","stationCode":null}]', [(0, None, None, None, "element is not an object"), (1, None, "S<k>", None, None)]),
    ('[{"line":"R<r>","station":"S<k>","code":true}]', [(0, "R<r>", "S<k>", "true", None)]),
    ('[{"lineName":null,"line":"R<r>","stop":"S<k>"}]', [(0, "R<r>", None, None, "no station")]),
    ('{"lineName":"R<r>"}', [(None, None, None, None, "not an array")]),
    ('[{"stationName":"S<k>"', [(None, None, None, None, "not JSON")]),
    ("[]", []),
    (
        ' [ {"lineName":"R<r>","stationName":"","stationCode":-<k>}, 5, null ] ',
        [(0, "R<r>", "", "<-k>", None), (1, None, None, None, "element is not an object"), (2, None, None, None, "element is not an object")],
    ),
    ('"S<k>"', [(None, None, None, None, "not an array")]),
]


def element_plans_sql() -> str:
    """Expected elements, by the remainder that chose the plan."""
    filled = lambda x: "CAST(NULL AS VARCHAR)" if x is None else f"replace(replace(replace({_lit(x)}, '<r>', r), '<k>', k), '<-k>', CASE WHEN k = '0' THEN '0' ELSE '-' || k END)"
    rows = [
        f"SELECT trip_key, CAST({'NULL' if hop is None else hop} AS INTEGER) AS hop, {filled(line)} AS route_raw, {filled(station)} AS station,"
        f" {filled(code)} AS code, {'CAST(NULL AS VARCHAR)' if reason is None else _lit(reason)} AS reason FROM o WHERE m = {m}"
        for m, (_, elements) in enumerate(ELEMENT_PLANS) for hop, line, station, code, reason in elements
    ]
    o = "SELECT CAST(o_orderkey AS VARCHAR) AS trip_key, CAST(o_orderkey % 1000 AS VARCHAR) AS r, CAST(o_custkey % 1000 AS VARCHAR) AS k, o_orderkey % 13 AS m FROM orders"
    return f"WITH o AS ({o}) " + " UNION ALL ".join(rows)


MARKUP_CTES = """
ml AS (SELECT c_custkey, c_name, c_custkey // 10 AS l, c_custkey // 50 AS page_id FROM customer),
mb AS (SELECT l, page_id, l = max(l) OVER (PARTITION BY page_id) AS is_end FROM (SELECT DISTINCT l, page_id FROM ml) x),
mr AS (SELECT *, page_id % 11 = 5 AS no_list, page_id % 7 = 3 AND is_end AS broken, l % 13 = 4 AS nameless,
              CAST(row_number() OVER (PARTITION BY page_id ORDER BY l) AS INTEGER) AS block FROM mb)"""

# Positions and numbers of the CSV records, written out per kind of fault.
RECORDS_SQL = """
WITH o AS (SELECT o_orderkey AS k, o_orderkey % 17 AS m, o_custkey % 5 AS c, o_orderpriority AS p FROM orders)"""


# ---------------------------------------------------------------- oracles


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["trip_scan"] = with_grid(
        "SELECT line_name, stage_id, stage_name, end_line_name, end_stage_id, end_stage_name, count, price,"
        f" spend_time, {trip_json_sql()} AS lines_result, CAST(o_orderkey AS VARCHAR) AS trip_key"
        " FROM trips WHERE o_orderstatus <> 'P'",
        legs=False,
    )
    q["location_scan"] = f"WITH {customer_locations_ctes()} SELECT * FROM cl"
    q["line_stations_from_payload"] = f"WITH {pages_ctes()} SELECT route, num, station, station_id FROM pclean"
    q["line_stations_from_pages"] = (
        f"WITH {pages_ctes()} SELECT route, num, station, CAST(NULL AS VARCHAR) AS station_id FROM pclean"
    )
    q["line_stations_csv"] = q["line_stations_from_pages"]
    q["canonical_names"] = (
        f"WITH pn AS ({part_names_sql()}), pt AS (SELECT p_partkey, name_in, {trim_sql('name_in')} AS t FROM pn) "
        f"SELECT p_partkey, name_in, {rules_sql('t')} AS name_out FROM pt"
    )
    q["explode_hops"] = with_grid("SELECT trip_id, hop, route_raw, station, code FROM hops_raw", legs=False)
    q["carry_forward_route"] = with_grid("SELECT trip_id, hop, route, station FROM hops", legs=False)
    q["trip_identity"] = (
        "SELECT o_orderkey, sha256(concat_ws(chr(1), CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),"
        " o_orderstatus, o_orderpriority)) AS trip_id FROM orders"
    )
    q["dedupe_hop_stations"] = with_grid("SELECT trip_id, hop, route, station FROM hd")
    q["expand_hop_stations"] = with_grid(
        "SELECT h.trip_id, h.hop, h.route, h.station, l.num AS sub_station_num, l.station AS sub_station"
        " FROM hd h LEFT JOIN lsd l ON l.route = h.route"
    )
    q["transfer_stations"] = with_grid(
        "SELECT h.trip_id, h.hop, h.route, h.station, l.num AS sub_station_num"
        " FROM hd h JOIN lsd l ON l.route = h.route AND l.station = h.station"
    )
    q["leg_destinations"] = with_grid(
        "SELECT trip_id, hop, route, station, next_station, o_num, d_num, lo, hi FROM legs"
    )
    q["leg_stations"] = with_grid("SELECT trip_id, hop, route, num, sub_station FROM legst")
    q["attach_coordinates"] = with_grid(
        "SELECT trip_id, hop, num, sub_station, lng AS longitude, lat AS latitude FROM legst", gap=17
    )
    q["segment_distance"] = with_grid("SELECT trip_id, hop, num, segment_m FROM seg", gap=17)
    q["bridge_missing_coordinates"] = with_grid("SELECT trip_id, hop, num, bridged_m FROM seg", gap=17)
    q["trip_distance"] = with_grid("SELECT trip_id, distance FROM dist_bridge", gap=17)
    q["trip_distance_exact"] = with_grid("SELECT trip_id, distance FROM dist_exact", gap=17)
    q["collect_trip_stations"] = with_grid(
        "SELECT trip_id, count(*) AS n_stations,"
        " CAST(sum(CASE WHEN sub_station = station THEN 1 ELSE 0 END) AS BIGINT) AS n_transfers,"
        " string_agg(sub_station, ',' ORDER BY hop, num) AS stations FROM legst GROUP BY trip_id"
    )
    q["line_net_result"] = with_grid(RESULT_SELECT.format(dist="dist_bridge"))
    q["line_net_exact"] = with_grid(RESULT_SELECT.format(dist="dist_exact"), gap=17)
    q["line_net_naive"] = q["line_net_exact"]
    q["unresolved_hops"] = with_grid(f"SELECT trip_id, hop, route, station, reason FROM ({REJECTS}) r", broken=True)
    q["line_net_frame"] = with_grid(
        f"""
SELECT *, CAST(NULL AS VARCHAR) AS reason, 'result' AS kind FROM ({RESULT_SELECT.format(dist="dist_exact")}) r
UNION ALL
SELECT t.trip_id, t.line_name, t.stage_id, t.stage_name, t.end_line_name, t.end_stage_id, t.end_stage_name, NULL,
       t.count, t.price, t.spend_time, r.code, r.hop, r.route, r.station, NULL, NULL, NULL, NULL, r.reason, 'reject'
FROM ({REJECTS}) r JOIN trips t ON t.trip_id = r.trip_id""",
        gap=17, broken=True,
    )
    q["first_station_per_line"] = (
        f"WITH {pages_ctes()} SELECT route, station, min(num) AS num FROM pclean"
        " WHERE route IS NOT NULL AND station IS NOT NULL GROUP BY route, station"
    )
    q["dedupe_lineitem_keys"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_partkey, l_suppkey, l_quantity, l_returnflag) AS rn
  FROM lineitem) x
WHERE rn = 1"""
    q["dedupe_coordinates"] = f"""WITH {customer_locations_ctes(True)},
g AS (SELECT DISTINCT route_name, station_name FROM cl),
lp AS (
  SELECT route_name, station_name, longitude, latitude,
         row_number() OVER (PARTITION BY route_name, station_name ORDER BY longitude, latitude) AS rn
  FROM cl WHERE longitude IS NOT NULL AND latitude IS NOT NULL)
SELECT g.route_name, g.station_name, lp.longitude, lp.latitude
FROM g LEFT JOIN lp ON lp.route_name = g.route_name AND lp.station_name = g.station_name AND lp.rn = 1"""
    q["line_net_from_payload"] = q["line_net_from_pages"] = q["line_net_result"]
    q["trip_identity_duplicates"] = with_grid(
        f"""SELECT stage_name, {trip_json_sql()} AS lines_result,
  CAST(sum(CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS n_trips,
  CAST(sum(CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS n_ids
FROM trips GROUP BY ALL""",
        legs=False,
    )
    q["line_stations_from_markup"] = f"""WITH {MARKUP_CTES}
SELECT 'Line "' || ml.l || '"' AS route, CAST(row_number() OVER (PARTITION BY ml.l ORDER BY c_custkey) - 1 AS INTEGER) AS num,
       c_name || ' & 中A' AS station, CAST(NULL AS VARCHAR) AS station_id
FROM ml JOIN mr ON mr.l = ml.l WHERE NOT (no_list OR broken OR nameless)"""
    q["markup_rejects"] = f"""WITH {MARKUP_CTES}
SELECT page_id, block, 'line without a name' AS reason FROM mr WHERE nameless AND NOT broken AND NOT no_list
UNION ALL SELECT page_id, block, 'block left open' FROM mr WHERE broken AND NOT no_list
UNION ALL SELECT DISTINCT page_id, CAST(NULL AS INTEGER), 'no line list' FROM mr WHERE no_list"""
    q["plan_elements"] = element_plans_sql()
    q["csv_records"] = RECORDS_SQL + """
SELECT k AS order_key, CAST(k % 50 AS INTEGER) AS num, CAST(k % 9 AS INTEGER) AS price, CAST(c AS INTEGER) AS count,
       CASE WHEN m = 11 THEN 'a "b", ' || k ELSE p END AS note
FROM o WHERE m NOT IN (3, 4, 5, 7, 8, 9, 10, 12, 13)"""
    q["csv_rejects"] = RECORDS_SQL + """
SELECT k AS order_key, 'num' AS field, CASE m WHEN 3 THEN 'x' WHEN 5 THEN '99999999999' END AS value,
       CASE WHEN m = 4 THEN 'missing' ELSE 'not int' END AS reason FROM o WHERE m IN (3, 4, 5)
UNION ALL SELECT k, 'price', CASE WHEN m = 8 THEN '2.5' ELSE '$' || (k % 9) END, 'not int' FROM o WHERE m IN (3, 7, 8)
UNION ALL SELECT k, 'count', CASE WHEN m = 9 THEN '1e2x' END, CASE WHEN m = 9 THEN 'not int' ELSE 'missing' END FROM o WHERE m IN (9, 10)
UNION ALL SELECT k, '', k || ',' || (k % 50) || CASE WHEN m = 13 THEN ',' || (k % 9) || ',' || c || ',' || p || ',more' ELSE '' END,
       'wrong number of fields' FROM o WHERE m IN (12, 13)"""
    q["trip_value_rejects"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS trip_key, 'price' AS field, 'five' AS value, 'not int' AS reason FROM orders WHERE o_orderkey % 9 + 2 = 5"""
    q["line_net_stored"] = q["line_net_spread"] = q["line_net_exact"]
    q["line_profile_split"] = f"""
WITH s AS (
  SELECT CAST(c_custkey // 3 * 1000 AS INTEGER) AS num, c_name AS station, c_custkey % 6 <> 0 AND (c_custkey // 100) % 4 <> 1 AS here,
         113.0::DOUBLE + c_acctbal * 0.0001::DOUBLE AS lng, 23.0::DOUBLE + CAST(c_custkey % 100 AS DOUBLE) * 0.01::DOUBLE AS lat FROM customer),
p AS (
  SELECT *, CAST(row_number() OVER w - 1 AS INTEGER) AS idx, lead(here) OVER w AS next_here, lead(num) OVER w AS next_num,
         last_value(CASE WHEN here THEN num END IGNORE NULLS) OVER b AS prev_loc_num,
         last_value(CASE WHEN here THEN lng END IGNORE NULLS) OVER b AS plng, last_value(CASE WHEN here THEN lat END IGNORE NULLS) OVER b AS plat
  FROM s WINDOW w AS (ORDER BY num, station), b AS (ORDER BY num, station ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, CASE WHEN here AND plng IS NOT NULL THEN {dist_sql("plng", "plat", "lng", "lat")} ELSE 0 END AS seg_m FROM p),
c AS (SELECT *, CAST(sum(seg_m) OVER (ORDER BY idx) AS BIGINT) AS cum_m FROM g)
SELECT num, station, idx, min(idx) OVER (PARTITION BY num) AS idx_first, max(idx) OVER (PARTITION BY num) AS idx_last, prev_loc_num, seg_m, cum_m,
       first_value(CASE WHEN here THEN cum_m END IGNORE NULLS) OVER (ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_cum_m,
       first_value(CASE WHEN here THEN idx END IGNORE NULLS) OVER (ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_idx,
       first_value(CASE WHEN here AND next_here THEN next_num END IGNORE NULLS) OVER (ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS pair_end
FROM c"""
    q["coordinate_variants"] = f"""WITH {customer_locations_ctes(True)},
s AS (SELECT DISTINCT route_name AS route, station_name AS station FROM cl)
SELECT DISTINCT s.route, s.station, cl.longitude, cl.latitude FROM s LEFT JOIN cl ON cl.station_name = s.station"""
    return q
