"""Station lists from JSON / JSONP payloads (S4): ``cb({"lines":[{"lineName", "stages":[...]}]})``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweave.functions.names import canonical_name
from lineweave.functions.text import strip_jsonp
from lineweave.schemas import PAYLOAD_SCHEMA


def line_stations_from_payload(df: DataFrame, text_col: str = "value", clean: bool = True) -> DataFrame:
    """One row per (line, station) with the 0-based position on the line.

    Every payload row is decoded independently (no grouping), so the work is spread over the
    partitions of ``df``.
    """
    name = canonical_name if clean else (lambda c: c)
    lines = df.select(F.inline(F.from_json(strip_jsonp(F.col(text_col)), PAYLOAD_SCHEMA)["lines"]))
    stages = lines.select(
        name(F.col("lineName")).alias("route"), F.posexplode(F.col("stages")).alias("num", "stage")
    )
    return stages.select(
        "route",
        F.col("num").cast("int").alias("num"),
        name(F.col("stage.stageName")).alias("station"),
        name(F.col("stage.stageId")).alias("station_id"),
    )


def read_payload(spark: SparkSession, path: str, clean: bool = True) -> DataFrame:
    """Each payload file is one whole text (``wholetext``)."""
    return line_stations_from_payload(spark.read.text(path, wholetext=True), "value", clean)
