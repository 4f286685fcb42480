"""Text helpers for JSON / JSONP inputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A JSONP wrapper: any callback name followed by '(' at the start, ')' plus optional ';' at the end.
JSONP_WRAPPER_PATTERN = r"^[^(\[{]*\(|\)\s*;?\s*$"


def strip_jsonp(c: Column) -> Column:
    """``callback({...});`` -> ``{...}``; plain JSON passes unchanged."""
    return F.regexp_replace(F.trim(c), JSONP_WRAPPER_PATTERN, "")


def is_json_array(c: Column) -> Column:
    """True when the text (after JSON white space: blank, tab, line feed, return) opens an array."""
    return F.ltrim(c, F.lit(" \t\n\r")).startswith("[")
