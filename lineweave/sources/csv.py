"""Station lists as CSV (S7): ``line,idx,station``, UTF-8, no header, RFC-4180 quoting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweave.functions.names import canonical_name
from lineweave.sources.records import CSV_OPTIONS, accepted, read_csv_records, rejected

_WRITE_OPTIONS = {k: v for k, v in CSV_OPTIONS.items() if k not in ("nullValue", "emptyValue")}

#: Records of a line, its position and the station; all three must be there.
_TYPES = {"route": "string", "num": "int", "station": "string"}


def write_line_stations_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write (route, num, station) as they are (raw names are not cleaned)."""
    (
        df.select("route", F.col("num").cast("string"), "station")
        .write.mode(mode)
        .options(**_WRITE_OPTIONS)
        .csv(path)
    )


def read_line_stations_csv(spark: SparkSession, path: str, clean: bool = True, multi_line: bool | None = None) -> DataFrame:
    """Read (line, idx, station) rows; names are cleaned like every other station source. A position that is no
    number becomes null; :func:`read_line_stations_records` tells which."""
    return _as_stations(read_csv_records(spark, path, _TYPES, multi_line=multi_line), clean)


def read_line_stations_records(spark: SparkSession, path: str, clean: bool = True, multi_line: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): the records that hold a line, a position and a station, and (route, num, station, field, value,
    reason) of the others."""
    records = read_csv_records(spark, path, _TYPES, required=tuple(_TYPES), multi_line=multi_line)
    return _as_stations(accepted(records), clean), rejected(records)


def _as_stations(rows: DataFrame, clean: bool) -> DataFrame:
    name = canonical_name if clean else (lambda c: c)
    return rows.select(
        name(F.col("route")).alias("route"),
        "num",
        name(F.col("station")).alias("station"),
        F.lit(None).cast("string").alias("station_id"),
    )
