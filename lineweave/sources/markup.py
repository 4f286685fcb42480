"""Station lists from nested markup (S5): a scan with a stack over the tags of a page.

Saved pages hold many lines in nested blocks, so a pattern can't tell where a block ends. Here a page is
cut into tokens (comments, script and style elements, tags, text) and folded once: the fold keeps the
stack of open elements and, for every step of the selectors, the depth at which it was entered. All of it is
column expressions on one row a page; nothing is shuffled.

A closing tag closes the elements that were opened inside its own and left open; one that closes
nothing is passed over; void elements need no end. Character references are decoded in names that are
taken. What can't be read is set aside with a reason: no list on the page, a block without a name, or a block that
is still open where the page ends (its extent is unknown, so none of its stations are taken).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweave.functions.names import canonical_name


@dataclass(frozen=True)
class Selectors:
    """Where lines and stations stand: blocks are ``block_tag`` children of the element ``container_id``; a
    line's name is the text of a ``name_tag`` inside an element of ``name_class``, its stations are the texts
    of ``station_tag`` elements inside ``station_class``, in page order."""

    container_id: str = "lineAndStation"
    block_tag: str = "div"
    name_class: str = "no"
    name_tag: str = "span"
    station_class: str = "stage_background"
    station_tag: str = "a"


#: Comments, declarations, elements whose content is no markup, tags (with ">" inside quotes), text, a lone "<".
TOKEN_PATTERN = (
    r"(?is)<!--.*?-->|<[!?][^>]*>|<(?:script|style)\b[^>]*>.*?</(?:script|style)\s*>"
    r"|</?[a-z](?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>|[^<]+|<"
)
TAG_PATTERN = r"(?i)^</?([a-z][a-z0-9:-]*)"
#: Elements that have no end tag.
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
#: Named character references that are decoded; numbers always are.
REFERENCES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " "}

NO_LIST, NO_NAME, LEFT_OPEN = "no line list", "line without a name", "block left open"

_FOUND = "array<struct<block:int,kind:string,num:int,text:string>>"
_STATE = (
    "struct<stack:array<string>,seen:boolean,container:int,block_at:int,name_at:int,name_in:int,list_at:int,link_at:int,"
    f"block:int,num:int,buffer:string,found:{_FOUND}>"
)
_STEPS = ["container", "block_at", "name_at", "name_in", "list_at", "link_at"]


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute, quoted in either way or bare; empty if it is absent."""
    parts = F.regexp_extract_all(tag, F.lit(rf"(?i)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)"), 1)
    return F.regexp_replace(F.coalesce(F.get(parts, 0), F.lit("")), "^[\"']|[\"']$", "")


def tokens(html: Column) -> Column:
    """The page's tokens: kind (open, close or text), tag, id, classes, text."""

    def token(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, TAG_PATTERN, 1))
        raw = name.isin("script", "style") | (name == "")
        closing = t.startswith("</")
        leaf = name.isin(VOID_TAGS) | t.endswith("/>")
        kind = (
            F.when(t.startswith("<") & raw & (t != "<"), F.lit("none"))
            .when(raw, F.lit("text"))
            .when(closing, F.lit("close"))
            .when(leaf, F.lit("none"))
            .otherwise(F.lit("open"))
        )
        opens = kind == "open"
        return F.struct(
            kind.alias("kind"),
            name.alias("tag"),
            F.when(opens, _attribute(t, "id")).alias("id"),
            F.when(opens, F.split(_attribute(t, "class"), r"\s+")).alias("classes"),
            F.when(kind == "text", t).alias("text"),
        )

    return F.filter(F.transform(F.regexp_extract_all(html, F.lit(TOKEN_PATTERN), 0), token), lambda t: t["kind"] != "none")


def decoded(text: Column) -> Column:
    """``text`` with its character references replaced; unknown ones stay."""
    named = F.create_map(*[F.lit(x) for kv in REFERENCES.items() for x in kv])

    def one(part: Column) -> Column:
        body = F.regexp_extract(part, r"^&([A-Za-z]+|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});$", 1)
        point = F.when(body.rlike("^#[0-9]"), F.substring(body, 2, 9).try_cast("int")).when(body.rlike("^#[xX]"), F.conv(F.substring(body, 3, 8), 16, 10).try_cast("int"))
        valid = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        return F.when(valid, char).otherwise(F.coalesce(F.try_element_at(named, body), part))

    parts = F.regexp_extract_all(text, F.lit(r"&[A-Za-z]+;|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|[^&]+|&"), 0)
    return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(parts, one), "")).otherwise(text)


def _changed(state: Column, **fields: Column) -> Column:
    names = [f.split(":")[0] for f in ("stack", "seen", *_STEPS, "block", "num", "buffer", "found")]
    return F.struct(*[fields.get(n, state[n]).alias(n) for n in names]).cast(_STATE)


def _opened(state: Column, t: Column, s: Selectors) -> Column:
    depth = F.size(state["stack"]) + 1
    has = lambda name: F.array_contains(t["classes"], name)
    inside = lambda step: state[step] > 0
    outside = lambda step: state[step] == 0
    container = outside("container") & (t["id"] == s.container_id)
    block = inside("container") & outside("block_at") & (depth == state["container"] + 1) & (t["tag"] == s.block_tag)
    name = inside("block_at") & outside("name_at") & has(s.name_class)
    name_in = inside("name_at") & outside("name_in") & (t["tag"] == s.name_tag)
    stations = inside("block_at") & outside("list_at") & has(s.station_class)
    link = inside("list_at") & outside("link_at") & (t["tag"] == s.station_tag)
    entered = dict(zip(_STEPS, (container, block, name, name_in, stations, link)))
    return _changed(
        state,
        stack=F.array_append(state["stack"], t["tag"]),
        seen=state["seen"] | container,
        block=state["block"] + block.cast("int"),
        num=F.when(block, F.lit(0)).otherwise(state["num"]),
        buffer=F.when(name_in | link, F.lit("")).otherwise(state["buffer"]),
        **{step: F.when(is_in, depth).otherwise(state[step]) for step, is_in in entered.items()},
    )


def _closed(state: Column, t: Column) -> Column:
    size = F.size(state["stack"])
    depth = (size - F.array_position(F.reverse(state["stack"]), t["tag"])).cast("int")
    ends = lambda step: state[step] > depth
    item = lambda kind, num, text: F.struct(state["block"].alias("block"), F.lit(kind).alias("kind"), num.cast("int").alias("num"), text.cast("string").alias("text"))
    none = F.lit(None)
    taken = F.array(
        F.when(ends("name_in"), item("name", none, state["buffer"])),
        F.when(ends("link_at"), item("station", state["num"], state["buffer"])),
        F.when(ends("block_at"), item("end", none, none)),
    )
    any_end = ends("name_in") | ends("link_at") | ends("block_at")
    after = _changed(
        state,
        stack=F.slice(state["stack"], 1, depth),
        num=state["num"] + ends("link_at").cast("int"),
        found=F.when(any_end, F.concat(state["found"], F.filter(taken, lambda x: x.isNotNull()))).otherwise(state["found"]),
        **{step: F.when(ends(step), F.lit(0)).otherwise(state[step]) for step in _STEPS},
    )
    return F.when(F.array_contains(state["stack"], t["tag"]), after).otherwise(state)


def scan_markup(pages: DataFrame, html_col: str = "html", selectors: Selectors = Selectors(), out: str = "scan") -> DataFrame:
    """``pages`` with a column ``out``: what the fold found (block, kind, num, text), whether there is a list,
    and the number of a block that was left open (null if none)."""
    start = F.struct(
        F.array().cast("array<string>").alias("stack"), F.lit(False).alias("seen"), *[F.lit(0).alias(x) for x in _STEPS],
        F.lit(0).alias("block"), F.lit(0).alias("num"), F.lit("").alias("buffer"), F.array().cast(_FOUND).alias("found"),
    ).cast(_STATE)

    def step(state: Column, t: Column) -> Column:
        taking = (state["name_in"] > 0) | (state["link_at"] > 0)
        text = F.when(taking, _changed(state, buffer=F.concat(state["buffer"], t["text"]))).otherwise(state)
        return F.when(t["kind"] == "text", text).when(t["kind"] == "open", _opened(state, t, selectors)).otherwise(_closed(state, t))

    result = lambda s: F.struct(s["found"].alias("found"), s["seen"].alias("seen"), F.when(s["block_at"] > 0, s["block"]).alias("open"))
    return pages.withColumn(out, F.aggregate(tokens(F.coalesce(F.col(html_col), F.lit(""))), start, step, result))


def _blocks(scan: Column) -> Column:
    """One element a block: its number, name (the first that was taken) and stations."""
    found = scan["found"]
    numbers = F.transform(F.filter(found, lambda x: x["kind"] == "end"), lambda x: x["block"])

    def block(number: Column) -> Column:
        own = F.filter(found, lambda x: x["block"] == number)
        return F.struct(
            number.alias("block"),
            F.get(F.filter(own, lambda x: x["kind"] == "name"), 0)["text"].alias("name"),
            F.filter(own, lambda x: x["kind"] == "station").alias("stations"),
        )

    return F.transform(numbers, block)


def line_stations_from_markup(pages: DataFrame, html_col: str = "html", selectors: Selectors = Selectors(), clean: bool = True) -> DataFrame:
    """route, num (0-based), station, station_id (null) of every block that can be read."""
    name = canonical_name if clean else (lambda c: c)
    scanned = scan_markup(pages.select(html_col), html_col, selectors)
    lines = scanned.select(F.inline(_blocks(F.col("scan")))).where("trim(name) <> ''")
    rows = lines.select("name", F.inline("stations"))
    return rows.select(
        name(decoded(F.col("name"))).alias("route"),
        "num",
        name(decoded(F.col("text"))).alias("station"),
        F.lit(None).cast("string").alias("station_id"),
    )


def markup_rejects(pages: DataFrame, keep: list[str], html_col: str = "html", selectors: Selectors = Selectors()) -> DataFrame:
    """The pages' columns ``keep``, ``block`` (its number on the page, from 1; null for the page) and ``reason``."""
    scanned = scan_markup(pages.select(*keep, html_col), html_col, selectors)
    scan = F.col("scan")
    bad = lambda block, reason: F.struct(block.cast("int").alias("block"), F.lit(reason).alias("reason"))
    nameless = F.transform(F.filter(_blocks(scan), lambda b: F.coalesce(F.trim(b["name"]), F.lit("")) == ""), lambda b: bad(b["block"], NO_NAME))
    page = F.filter(F.array(F.when(~scan["seen"], bad(F.lit(None), NO_LIST)), F.when(scan["open"].isNotNull(), bad(scan["open"], LEFT_OPEN))), lambda x: x.isNotNull())
    return scanned.select(*keep, F.inline(F.concat(nameless, page)))
