"""JVM-side column expressions (no Python UDFs)."""

from lineweave.functions.geo import distance_km, distance_m, point, point_distance_m, radians
from lineweave.functions.names import ALIAS_RULES, canonical_name, canonicalize, control_trim
from lineweave.functions.text import is_json_array, strip_jsonp

__all__ = [
    "ALIAS_RULES",
    "canonical_name",
    "canonicalize",
    "control_trim",
    "distance_km",
    "distance_m",
    "is_json_array",
    "point",
    "point_distance_m",
    "radians",
    "strip_jsonp",
]
