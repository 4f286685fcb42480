"""Documents meet a table of findings without Python workers, and no stage has workers for two steps."""

import re

from pyspark.sql import functions as F

from lineweave.llm import decontaminate, packing
from lineweave.llm.tables import prepare
from lineweave.llm.touched import KeyCells, with_key, without


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_keeps_every_row_once_and_all_columns(spark):
    docs = spark.createDataFrame([(i % 7 or None, f"text {i % 40}", i, "x", None) for i in range(200)], "doc_id long, text string, _cell int, _Word string, _h string")
    rows = with_key(docs, "_key")
    found = rows.where("text in ('text 3', 'text 8')").select(F.col("_key").alias("key"))
    maybe = KeyCells.of(found, "key", bits=10)
    inside, outside = maybe.split(rows, "_key", True), maybe.split(rows, "_key", False)
    assert inside.columns == outside.columns == rows.columns
    assert sorted(map(str, inside.union(outside).collect())) == sorted(map(str, rows.collect()))
    assert outside.where("text in ('text 3', 'text 8')").isEmpty()
    assert inside.where("text in ('text 3', 'text 8')").count() == 10
    assert KeyCells.of(found.where("false"), "key").split(rows, "_key", False).count() == 200


def test_without_is_exact_and_has_no_python(spark):
    docs = spark.createDataFrame([(i, None if i == 5 else f"text {i % 3}") for i in [*range(10), 5, 1]], "doc_id long, text string")
    found = with_key(docs, "key").where("doc_id in (1, 5)").select("key")
    left = without(docs, found)
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 2, 3, 4, 6, 7, 8, 9]
    assert "MapInArrow" not in plan(left)


def test_one_python_step_in_a_stage_of_decontamination(spark):
    prepare(spark)
    words = " ".join(f"w{i}" for i in range(20))
    rows = spark.createDataFrame([(1, 1, 1, words)], "doc long, t1 long, t2 long, text string")
    items = spark.createDataFrame([(1, words)], "item long, text string")
    steps = re.findall(r"MapInArrow|Exchange hashpartitioning|Scan parquet", plan(decontaminate._text_overlaps(rows, items)))
    first, second = [i for i, s in enumerate(steps) if s == "MapInArrow"][:2]
    assert "Exchange hashpartitioning" in steps[first:second]


def test_slots_are_no_python_rows(spark):
    docs = spark.createDataFrame([(1, "a few words"), (2, "a few words more"), (3, None)], "doc_id long, text string")
    pieces = packing.packed_pieces(docs)
    assert "ExistingRDD" not in plan(pieces)
    assert sorted(r["doc_id"] for r in pieces.collect()) == [1, 2, 3]
