"""Station coordinates (S2, F6): route_name, station_name, longitude, latitude."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _coordinate(df: DataFrame, name: str):
    value = F.col(name) if dict(df.dtypes)[name] == "double" else F.col(name).cast("string").try_cast("double")
    # NaN sorts above every number, so the upper bound leaves it out too.
    finite = (value > F.lit(float("-inf"))) & (value < F.lit(float("inf")))
    return F.when(finite, value).alias(name)


def location_scan(df: DataFrame) -> DataFrame:
    """Names as strings, coordinates parsed once to double; unparsable, NaN and infinite ones become null."""
    return df.select(
        F.col("route_name").cast("string").alias("route_name"),
        F.col("station_name").cast("string").alias("station_name"),
        _coordinate(df, "longitude"),
        _coordinate(df, "latitude"),
    )


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    return location_scan(spark.read.parquet(path))
