"""Typed records with a trace of what didn't fit.

A cast that fails gives null, and a null position is a station that later disappears. Here every record keeps the
list of its fields that hold something else than their type, with the raw value, and CSV records of the wrong
number of fields keep their raw text; ``accepted`` and ``rejected`` split them, and no record is in neither.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW = "_raw"
FAULTS = "_faults"
WRONG_FIELDS, NOT_TYPED, REQUIRED = "wrong number of fields", "not {}", "missing"


def _fault(field: str, value: Column, reason: str) -> Column:
    return F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"), F.lit(reason).alias("reason"))


def typed_records(df: DataFrame, types: Mapping[str, str], required: tuple[str, ...] = (), raw: str | None = None) -> DataFrame:
    """``df`` with the columns of ``types`` cast (blanks around a number don't matter) and ``_faults``, an array of
    (field, value, reason). ``raw`` names a column that holds the text of a record that couldn't be split."""

    def cast(name: str, kind: str) -> Column:
        c = F.col(name)
        return c.cast("string") if kind == "string" else F.trim(c.cast("string")).try_cast(kind)

    faults = []
    split = F.col(raw).isNull() if raw else F.lit(True)
    for name, kind in types.items():
        faults.append(F.when(split & F.col(name).isNotNull() & cast(name, kind).isNull(), _fault(name, F.col(name), NOT_TYPED.format(kind))))
        if name in required:
            faults.append(F.when(split & F.col(name).isNull(), _fault(name, F.lit(None), REQUIRED)))
    if raw:
        faults.append(F.when(~split, _fault("", F.col(raw), WRONG_FIELDS)))
    found = F.filter(F.array(*faults), lambda f: f.isNotNull())
    rest = [c for c in df.columns if c not in types]
    return df.select(*rest, *[cast(n, k).alias(n) for n, k in types.items()], found.alias(FAULTS))


def accepted(records: DataFrame) -> DataFrame:
    """The records without a fault."""
    return records.where(F.size(FAULTS) == 0).drop(FAULTS, RAW)


def rejected(records: DataFrame) -> DataFrame:
    """One row for every fault: the record's other columns and field, value, reason."""
    keep = [c for c in records.columns if c not in (FAULTS, RAW)]
    return records.select(*keep, F.inline(FAULTS))


def has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field may run over a line break: some line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


#: No header, RFC-4180 quoting; an unquoted empty field is null, a quoted one ("") is the empty string.
CSV_OPTIONS = {
    "header": "false",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\u0000",
    "emptyValue": "",
}


def read_csv_records(spark: SparkSession, path: str, types: Mapping[str, str], required: tuple[str, ...] = (), multi_line: bool | None = None) -> DataFrame:
    """Typed records of CSV files with ``_faults``. A file is split among tasks at line breaks unless some
    field may hold one (``multi_line=None`` looks), in which case each file is read by one task."""
    if multi_line is None:
        multi_line = has_quoted_breaks(spark, path)
    schema = ", ".join([*(f"`{n}` string" for n in types), f"{RAW} string"])
    reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW)
    return typed_records(reader.option("multiLine", str(multi_line).lower()).csv(path), types, required, RAW)
