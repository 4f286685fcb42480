"""Names without a parenthesis meet no pattern, and come out as the patterns would leave them."""

import re

from pyspark.sql import functions as F

from lineweave.functions.names import LINE_CHAR, PAREN_PATTERN, PAREN_SECTION_PATTERN, alias_rules

NAMES = ["S12", "a)b", "a(b", "(", "()", "a()", "a(b)c", "a(b段)c", "(b段)", "a(b)(c段)", "a\n(b)\nc", "a段", ")(", ")a(b)", "（a）", "a(段)", "", None]


def test_names_without_a_parenthesis_skip_the_patterns(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "t string")
    cleaned = df.select("t", alias_rules(F.col("t")).alias("out"))
    shown = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"\(instr\(t#\d+, \(\) > 0\) THEN regexp_replace", shown)
    section = F.regexp_replace("t", PAREN_SECTION_PATTERN, "$1$2" + LINE_CHAR)
    plain = df.select("t", F.regexp_replace(section, PAREN_PATTERN, "$1$2").alias("out"))
    assert cleaned.collect() == plain.collect()
