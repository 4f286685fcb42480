import pytest

from lineweave.functions.names import canonical_name, canonicalize

CASES = [
    ("\t a b\n", "a b"),
    ("三号线(机场北段)x", "三号线机场北线"),
    ("a (b)", "a b"),
    ("a()", "a()"),
    (")(", ")("),
    ("全（角）", "全（角）"),
    (None, None),
    ("机场北（2号航站楼）", "机场北"),
    ("x机场南（1号航站楼）y", "机场南"),
    ("十四号线", "知识城线"),
    ("虫雷 岗", "虫雷岗"),
    ("清㘵", "清土布"),
    ("APM", "APM线"),
    ("三北线", "三号线北延线"),
    ("  十四号线\r\n", "知识城线"),
    ("a(b(c)d", "ab(c"),
    ("a(段)", "a线"),
    ("a)b(c)", "a)b(c)"),
    ("a(b\nc)d", "ab\nc"),
    ("\x00x\x1f", "x"),
    ("", ""),
]


def test_canonical_name_rules(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CASES)], "i int, s string")
    got = {r.i: r.o for r in df.select("i", canonical_name("s").alias("o")).collect()}
    for i, (src, want) in enumerate(CASES):
        assert got[i] == want, (src, got[i], want)


def test_canonicalize_many_columns_matches_single(spark):
    rows = [(c, c, c, c) for c, _ in CASES]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    out = canonicalize(df, ["a", "b", "c", "d"]).collect()
    for r, (_, want) in zip(out, CASES):
        assert r.a == r.b == r.c == r.d == want


def test_user_alias_takes_precedence(spark):
    df = spark.createDataFrame([("APM",), ("Foo Line",)], "s string")
    got = [r.o for r in df.select(canonical_name("s", [("APM", "Airport"), ("Foo Line", "F")]).alias("o")).collect()]
    assert got == ["Airport", "F"]
