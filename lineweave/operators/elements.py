"""Plan elements from free-form JSON by a typed walk over VARIANT.

``from_json`` with a schema turns whatever doesn't fit into null. The walk keeps the type of everything it meets, so
a number is read as its text, a renamed field is found under its other names, and what can't be read is told with
a reason: one row an element, or one for a plan that holds no elements that could be read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names under which producers send the fields; the first one that is there counts.
FIELD_NAMES: dict[str, tuple[str, ...]] = {
    "route_raw": ("lineName", "line"),
    "station": ("stationName", "station"),
    "code": ("stationCode", "code"),
}

NO_JSON, NO_ARRAY, NO_OBJECT, NO_STATION = "not JSON", "not an array", "element is not an object", "no station"


def _type(v: Column) -> Column:
    """STRING, BIGINT, OBJECT, ARRAY, VOID, ...; null if there is nothing."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _field(element: Column, names: Sequence[str]) -> Column:
    found = [F.try_variant_get(element, f"$.{n}", "variant") for n in names]
    return F.coalesce(*[F.when(_type(v) != "VOID", v) for v in found])


def plan_elements(trips: DataFrame, text_col: str = "lines_result", fields: Mapping[str, Sequence[str]] = FIELD_NAMES) -> DataFrame:
    """The trips' other columns and hop (0-based; null where there is no element), route_raw, station, code (as
    text) and ``reason`` (null if all of it could be read). Null plans give no row, ``[]`` gives none either.

    Every primitive is text; a JSON null is a missing field; an object or array in the place of a primitive is a
    reason, and the element's other fields are kept.
    """
    keep = [c for c in trips.columns if c != text_col]
    parsed = trips.where(F.col(text_col).isNotNull()).select(*keep, F.try_parse_json(F.col(text_col)).alias("_plan"))
    is_array = _type(F.col("_plan")) == "ARRAY"
    elements = F.when(is_array, F.try_variant_get("_plan", "$", "array<variant>"))
    # A plan that is no array passes as one element that carries the reason alone.
    rows = parsed.select(
        *keep,
        F.when(F.col("_plan").isNull(), F.lit(NO_JSON)).when(~F.coalesce(is_array, F.lit(False)), F.lit(NO_ARRAY)).alias("_whole"),
        F.posexplode(F.coalesce(elements, F.array(F.lit(None).cast("variant")))).alias("hop", "_element"),
    )
    is_object = _type(F.col("_element")) == "OBJECT"
    rows = rows.withColumn("_object", F.col("_whole").isNull() & F.coalesce(is_object, F.lit(False)))
    rows = rows.withColumns({f"_{out}": F.when(F.col("_object"), _field(F.col("_element"), names)) for out, names in fields.items()})
    nested = {out: F.coalesce(_type(F.col(f"_{out}")).isin("OBJECT", "ARRAY"), F.lit(False)) for out in fields}
    values = {out: F.when(~nested[out], F.try_variant_get(f"_{out}", "$", "string")) for out in fields}
    reason = F.when(F.col("_whole").isNotNull(), F.col("_whole")).when(~F.col("_object"), F.lit(NO_OBJECT))
    for out, names in fields.items():
        reason = reason.when(nested[out], F.lit(f"{names[0]} is not a primitive"))
    reason = reason.when(values["station"].isNull(), F.lit(NO_STATION))
    hop = F.when(F.col("_whole").isNull(), F.col("hop")).alias("hop")
    return rows.select(*keep, hop, *[v.alias(out) for out, v in values.items()], reason.alias("reason"))
