"""Hops of a trip by one fold over its plan array.

The plan is folded while a trip is still one row: names are cleaned, a missing line is carried forward, an
element that repeats an earlier (line, station) is dropped, and every element gets the station that
follows it. So hop rows leave the generator complete, without a window, a sort or an aggregation over them.
The fold looks through the elements kept so far, so a plan costs the square of its own (few) elements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweave.functions.names import alias_rules, control_trim
from lineweave.functions.text import is_json_array
from lineweave.schemas import HOP_SCHEMA

_KEPT = "array<struct<hop:int,route:string,station:string,code:string>>"
_FOLDED = "array<struct<hop:int,route:string,station:string,code:string,next_station:string,is_last:boolean>>"


def cleaned_plan(plan: Column, extra_aliases=None) -> Column:
    """The plan's elements as (hop, route, station, code) with clean names; a missing line stays null."""
    trimmed = F.transform(
        plan,
        lambda h: F.struct(control_trim(h["lineName"]).alias("route"), control_trim(h["stationName"]).alias("station"), h["stationCode"].alias("code")),
    )
    return F.transform(
        trimmed,
        lambda h, i: F.struct(
            i.cast("int").alias("hop"),
            alias_rules(h["route"], extra_aliases).alias("route"),
            alias_rules(h["station"], extra_aliases).alias("station"),
            h["code"].alias("code"),
        ),
    )


def folded_plan(plan: Column, dedupe: bool = True, extra_aliases=None) -> Column:
    """The elements of a parsed plan with their lines carried forward, without repeats, each with the next
    kept element's station; null for a null plan."""
    nothing = F.struct(F.lit(None).cast("string").alias("route"), F.array().cast(_KEPT).alias("kept"))

    def step(state: Column, h: Column) -> Column:
        route = F.coalesce(h["route"], state["route"])
        own = F.struct(h["hop"].alias("hop"), route.alias("route"), h["station"].alias("station"), h["code"].alias("code"))
        longer = F.array_append(state["kept"], own)
        if dedupe:
            met = F.exists(state["kept"], lambda k: k["route"].eqNullSafe(route) & k["station"].eqNullSafe(h["station"]))
            longer = F.when(met, state["kept"]).otherwise(longer)
        return F.struct(route.alias("route"), longer.alias("kept"))

    def with_next(state: Column) -> Column:
        return F.transform(
            state["kept"],
            lambda h, i: F.struct(
                h["hop"].alias("hop"), h["route"].alias("route"), h["station"].alias("station"), h["code"].alias("code"),
                F.get(state["kept"], i + 1)["station"].alias("next_station"),
                (i + 1 == F.size(state["kept"])).alias("is_last"),
            ),
        )

    return F.aggregate(cleaned_plan(plan, extra_aliases), nothing, step, with_next)


def plan_lines(trips: DataFrame) -> DataFrame:
    """``route``: the line of every plan element, repeated ones too, carried forward as in :func:`fold_hops` but under the
    name that the plan gives it. For counts of lines, which clean a name once: nothing else of the plan is read."""
    text = F.col("lines_result")
    plan = F.when(is_json_array(text), F.from_json(text, "array<struct<lineName:string>>"))
    nothing = F.struct(F.lit(None).cast("string").alias("route"), F.array().cast("array<string>").alias("routes"))

    def step(state: Column, h: Column) -> Column:
        route = F.coalesce(h["lineName"], state["route"])
        return F.struct(route.alias("route"), F.array_append(state["routes"], route).alias("routes"))

    return trips.select(F.explode(F.aggregate(plan, nothing, step, lambda state: state["routes"])).alias("route"))


def fold_hops(trips: DataFrame, dedupe: bool = True, extra_aliases=None, mark_malformed: bool = False, covered: bool = True) -> DataFrame:
    """One row per kept plan element: the trip's columns and hop, route, station, code, next_station, is_last.

    Text that is not a JSON array of objects gives no row; with ``mark_malformed`` it gives one row whose hop
    is null, and ``malformed`` tells those rows. ``covered=False`` leaves out a last element on the line of the one
    before it: it begins no leg, and whether its station is on that line is what the leg before it looks up.
    """
    text = F.col("lines_result")
    plan = F.when(is_json_array(text), F.from_json(text, HOP_SCHEMA))
    hops = folded_plan(plan, dedupe, extra_aliases)
    if mark_malformed:
        hops = F.coalesce(hops, F.array(F.lit(None)).cast(_FOLDED))
    keep = [c for c in trips.columns if c != "lines_result"]
    if not covered:
        trips = trips.withColumn("_hops", hops)
        same_line = F.try_element_at("_hops", F.lit(-1))["route"] == F.try_element_at("_hops", F.lit(-2))["route"]
        hops = F.when(same_line, F.slice("_hops", 1, F.size("_hops") - 1)).otherwise(F.col("_hops"))
    rows = trips.select(*keep, F.inline(hops))
    return rows.withColumn("malformed", F.col("hop").isNull()) if mark_malformed else rows
