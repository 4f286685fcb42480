"""Station lists from saved HTML pages.

A page (or a block inside a page) is one line: the line name and the ordered station names are
taken with regular expressions, per row, so pages are processed in parallel by partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.functions.names import canonical_name

# Fixed patterns for the saved pages: <title> holds the line name, list links hold the
# stations in line order.
TITLE_PATTERN = r"<title>([^<]*)</title>"
LINK_PATTERN = r"<li><a[^>]*>([^<]*)</a></li>"


def line_stations_from_pages(
    pages: DataFrame,
    html_col: str = "html",
    line_pattern: str = TITLE_PATTERN,
    station_pattern: str = LINK_PATTERN,
    block_pattern: str | None = None,
    clean: bool = True,
) -> DataFrame:
    """route, num (0-based), station, station_id (null: pages carry no ids).

    ``block_pattern`` (group 1 = one line's markup) splits a page holding several lines.
    """
    name = canonical_name if clean else (lambda c: c)
    if block_pattern is None:
        blocks = pages.select(F.col(html_col).alias("block"))
    else:
        blocks = pages.select(
            F.explode(F.regexp_extract_all(F.col(html_col), F.lit(block_pattern), 1)).alias("block")
        )
    lines = blocks.select(
        F.nullif(F.regexp_extract(F.col("block"), line_pattern, 1), F.lit("")).alias("line"),
        F.posexplode(F.regexp_extract_all(F.col("block"), F.lit(station_pattern), 1)).alias("num", "raw"),
    )
    return lines.select(
        name(F.col("line")).alias("route"),
        F.col("num").cast("int").alias("num"),
        name(F.col("raw")).alias("station"),
        F.lit(None).cast("string").alias("station_id"),
    )
