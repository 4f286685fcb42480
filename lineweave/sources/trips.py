"""Trip plans (S1, S3): Parquet rows with a JSON ``lines_result`` plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineweave.schemas import TRIP_COLUMNS
from lineweave.sources.records import rejected, typed_records


def conform_trips(df: DataFrame) -> DataFrame:
    """Cast the known trip columns to their types; legacy BINARY strings become strings.

    Unknown extra columns (for example a natural trip key) pass through; known columns that are
    missing become typed nulls (``lines_result`` is required).
    """
    if "lines_result" not in df.columns:
        raise ValueError("trip plans need a 'lines_result' column")
    types = dict(df.dtypes)
    known = []
    for name, typ in TRIP_COLUMNS:
        if name not in types:
            known.append(F.lit(None).cast(typ).alias(name))
        elif types[name] == typ:
            known.append(F.col(name))
        else:
            # try_cast: dirty numbers become null instead of failing the job (ANSI mode).
            known.append(F.col(name).try_cast(typ).alias(name))
    names = {n for n, _ in TRIP_COLUMNS}
    extra = [F.col(c) for c in df.columns if c not in names]
    return df.select(*known, *extra)


def trip_value_rejects(df: DataFrame, keep: list[str]) -> DataFrame:
    """The numbers that :func:`conform_trips` makes null: the columns ``keep`` and field, value, reason."""
    numbers = {n: t for n, t in TRIP_COLUMNS if t != "string" and n in df.columns}
    return rejected(typed_records(df.select(*keep, *[n for n in numbers if n not in keep]), numbers)).select(*keep, "field", "value", "reason")


def trip_scan(df: DataFrame) -> DataFrame:
    """Keep rows that carry a plan (``lines_result is not null``; pushed into the Parquet scan)."""
    return conform_trips(df).filter(F.col("lines_result").isNotNull())


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Read trip plan Parquet files.

    Adds ``trip_pos`` (file path + row index inside the file): a stable, per-row unique position
    used as the default trip identity, so that re-running a task after an executor loss gives
    the same ids and no shuffle is needed to number duplicate plans.
    """
    raw = spark.read.parquet(path)
    for field in raw.schema.fields:
        if isinstance(field.dataType, T.BinaryType):
            raw = raw.withColumn(field.name, F.col(field.name).cast("string"))
    raw = raw.withColumn(
        "trip_pos",
        F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")),
    )
    return trip_scan(raw)
