"""Markup with nested blocks, JSON elements of any type, records with a trace of their faults."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lineweave.operators import plan_elements
from lineweave.session import shared_dir
from lineweave.sources import (
    Selectors,
    accepted,
    line_stations_from_markup,
    markup_rejects,
    read_csv_records,
    read_line_stations_csv,
    read_line_stations_records,
    rejected,
    trip_value_rejects,
    typed_records,
)
from lineweave.sources.markup import decoded
from lineweave.sources.records import has_quoted_breaks


def _scan(spark, *pages, **kw):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    rows = sorted((r.route, r.num, r.station) for r in line_stations_from_markup(df, **kw).collect())
    return rows, sorted((r.page_id, r.block, r.reason) for r in markup_rejects(df, ["page_id"]).collect())


def _page(*blocks):
    return f'<div id="lineAndStation">{"".join(blocks)}</div>'


def _block(name, *stations):
    links = "".join(f"<a href='#'>{s}</a>" for s in stations)
    return f'<div><div class="no"><span>{name}</span></div><div class="stage_background">{links}</div></div>'


def test_nested_blocks_decoys_and_references(spark):
    page = (
        '<!-- <div id="lineAndStation"> --><script>if (a<b) "<div>"</script><div class=x><a href="q">out</a><span class="no"><span>zz</span></span></div>'
        "<DIV ID='lineAndStation'><div class=\"l\"><div class=\"no big\"><b>No</b><span>L &amp; <i>A1</i><br/></span></div><div><div class=\"stage_background wide\">"
        '<p>t<a title="a > b" href=x>S &#x4E2D;&#65;&lt;</a><p><a>S2<b>x</b></a></div></div><div><div></div></div></div>'
        "<div><span class=no><span>B</span></span><ul class='stage_background'><li><a>b1</a><li><a>b2</a></ul></div></DIV>"
    )
    assert _scan(spark, page) == ([("B", 0, "b1"), ("B", 1, "b2"), ("L & A1", 0, "S 中A<"), ("L & A1", 1, "S2x")], [])


def test_broken_pages_are_rejects(spark):
    rows, bad = _scan(
        spark,
        None,
        "",
        "<p>no list</p>",
        _page(_block("A", "a"), _block("B", "b"))[: -len("</div></div></div>")],
        _page(_block("", "x"), _block("C", "c", "d")),
        "</div></b>" + _page(_block("D", "e")) + "</div>",
        _page(_block("E"), "<p><a>loose</a></p>", "text < and > &"),
        "<" * 500 + _page(_block("F", "f")),
    )
    assert rows == [("A", 0, "a"), ("C", 0, "c"), ("C", 1, "d"), ("D", 0, "e"), ("F", 0, "f")]
    none = [(0, None, "no line list"), (1, None, "no line list"), (2, None, "no line list")]
    assert bad == [*none, (3, 2, "block left open"), (4, 1, "line without a name")]


def test_random_nesting_gives_the_lists_it_was_made_from(spark):
    rng = random.Random(9)

    def wrap(html, depth=0):
        if depth > 6 or rng.random() < 0.2:
            return html
        tag = rng.choice(["div", "section", "p", "b"])
        extra = rng.choice(["", "<br>", "<img src='a>b'>", "<!-- </div> -->", "<div></div>", "x &amp; y"])
        return extra + f"<{tag} class='q no2'>" + wrap(html, depth + 1) + f"</{tag}>" + extra

    lines, blocks = {}, []
    for i in range(25):
        names = [f"s{i}-{j}" for j in range(rng.randrange(6))]
        lines[f"L{i}"] = names
        stops = "".join(wrap(f"<a>{n}</a>") for n in names)
        blocks.append("<div>" + wrap(f'<i class="no">{wrap("<span>" + f"L{i}" + "</span>")}</i>') + f'<div class="stage_background">{wrap(stops)}</div></div>')
    rows, bad = _scan(spark, *[_page(*blocks[k : k + 5]) for k in range(0, 25, 5)])
    assert rows == sorted((line, n, s) for line, names in lines.items() for n, s in enumerate(names)) and bad == []


def test_own_selectors_and_extra_columns(spark):
    page = '<ul id="net"><li><h2 class="title"><em>Q</em></h2><ol class="stops"><b>1</b><b>2</b></ol></li></ul>'
    own = Selectors("net", "li", "title", "em", "stops", "b")
    df = spark.createDataFrame([(page, "x", "y")], "html string, scan string, name string")
    assert [(r.route, r.num, r.station) for r in line_stations_from_markup(df.drop("scan"), selectors=own).collect()] == [("Q", 0, "1"), ("Q", 1, "2")]
    assert line_stations_from_markup(df.limit(0)).count() == 0


@pytest.mark.parametrize("text, plain", [("a&amp;b&#20013;&#x1F600;", "a&b中😀"), ("&nosuch; & &; &#0; &#xD800; &#9999999;", "&nosuch; & &; &#0; &#xD800; &#9999999;"), ("", ""), (None, None)])
def test_character_references(spark, text, plain):
    assert spark.createDataFrame([(text,)], "t string").select(decoded(F.col("t"))).first()[0] == plain


def test_elements_of_any_type_against_a_plain_walk(spark):
    rng = random.Random(3)
    value = lambda: rng.choice(["x", "", 7, -1, 2.5, True, None, [1], {"a": 1}, "é\"\\"])
    names = ["lineName", "line", "stationName", "station", "stationCode", "code", "other"]
    plans = [[rng.choice([{n: value() for n in rng.sample(names, rng.randrange(6))}] * 5 + [5, "s", None, []]) for _ in range(rng.randrange(4))] for _ in range(300)]
    texts = [json.dumps(p) for p in plans] + [None, "", "oops", "{}", "1", "null", "[1", " [] "]

    def model(text):
        if text is None:
            return []
        try:
            plan = json.loads(text)
        except ValueError:
            return [(None, None, None, None, "not JSON")]
        if not isinstance(plan, list):
            return [(None, None, None, None, "not an array")]
        out = []
        for i, e in enumerate(plan):
            if not isinstance(e, dict):
                out.append((i, None, None, None, "element is not an object"))
                continue
            row, reason = [], None
            for options in (("lineName", "line"), ("stationName", "station"), ("stationCode", "code")):
                v = next((e[n] for n in options if e.get(n) is not None), None)
                if isinstance(v, (list, dict)):
                    reason, v = reason or f"{options[0]} is not a primitive", None
                row.append(None if v is None else v if isinstance(v, str) else json.dumps(v))
            out.append((i, *row, reason or (None if row[1] is not None else "no station")))
        return out

    got = {}
    for r in plan_elements(spark.createDataFrame(list(enumerate(texts)), "k int, lines_result string")).collect():
        got.setdefault(r.k, []).append(tuple(r)[1:])
    for k, text in enumerate(texts):
        assert sorted(got.get(k, []), key=str) == sorted(model(text), key=str), text


def test_records_are_rows_or_rejects(spark):
    path = shared_dir(spark, "test-records")
    lines = ["A,0,a", "A,1", "A,2,b,c", "A,x,d", "A,,e", 'A,3,"f, ""g"""', "A, 4 ,h", ",5,i", 'A,6,""', "A,7,", "A,99999999999,j"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows, bad = read_line_stations_records(spark, path)
    assert sorted((r.route, r.num, r.station) for r in rows.collect()) == [("A", 0, "a"), ("A", 3, 'f, "g"'), ("A", 4, "h"), ("A", 6, "")]
    assert sorted(((r.field, r.value, r.reason) for r in bad.collect()), key=str) == [
        ("", "A,1", "wrong number of fields"), ("", "A,2,b,c", "wrong number of fields"), ("num", "99999999999", "not int"), ("num", "x", "not int"),
        ("num", None, "missing"), ("route", None, "missing"), ("station", None, "missing")]
    assert all(r.field for r in bad.collect() if r.reason == "not int")
    assert rows.count() + bad.count() == len(lines) == read_csv_records(spark, path, {"route": "string", "num": "int", "station": "string"}).count()


def test_files_are_read_whole_only_for_quoted_line_breaks(spark):
    plain, broken = shared_dir(spark, "test-plain"), shared_dir(spark, "test-broken")
    spark.createDataFrame([('A,0,"a"',), ("A,1,b",)], "value string").write.text(plain)
    spark.createDataFrame([('A,0,"a\n""b"""\nA,1,c',)], "value string").write.text(broken)
    assert not has_quoted_breaks(spark, plain) and has_quoted_breaks(spark, broken)
    assert sorted((r.num, r.station) for r in read_line_stations_csv(spark, broken).collect()) == [(0, 'a\n"b"'), (1, "c")]
    assert sorted((r.num, r.station) for r in read_line_stations_csv(spark, plain).collect()) == [(0, "a"), (1, "b")]


def test_numbers_that_become_null_are_told(spark):
    df = spark.createDataFrame([("1", "2", "three"), ("2", None, " 4 "), ("3", "2147483648", "")], "k string, count string, price string")
    got = sorted((r.k, r.field, r.value, r.reason) for r in trip_value_rejects(df, ["k"]).collect())
    assert got == [("1", "price", "three", "not int"), ("3", "count", "2147483648", "not int"), ("3", "price", "", "not int")]
    records = typed_records(df, {"count": "int", "price": "double"}, required=("count",))
    assert accepted(records).count() == 0 and rejected(records).count() == 4
    assert typed_records(df.limit(0), {"count": "int"}).count() == 0
