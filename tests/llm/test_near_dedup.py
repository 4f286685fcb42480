import random

from lineweave.llm.near_dedup import keep_one_of_each, near_duplicate_components, op3_near_dedup
from tests.conftest import SF001
from tests.llm import brute

CLASHING = "doc_id long, text string, node string, band int, sketch string, text_hash int, key int, _key int, n int, a int, b int"


def rows_of(df):
    return [(r["doc_id"], r["component_id"], r["n_shingles"], r["kept"]) for r in df.collect()]


def check(spark, rows):
    got = rows_of(near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string")))
    expected = [(i, c, len(brute.shingles(t)), i == c) for (i, t), c in zip(rows, brute.components(rows))]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_matches_all_pairs_on_the_documents(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["component_id"] for r in op3_near_dedup(spark, SF001).collect()}
    assert got == dict(zip((i for i, _ in docs), brute.components(docs)))


def test_large_buckets_lose_no_link(spark):
    """Variants around the threshold: chains, clusters and loners that share buckets."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 5])):
            text[rng.randrange(len(text))] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(text)))
    assert 1 < len(set(brute.components(rows))) < 150
    check(spark, rows)


def test_cases(spark):
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (5, "ONE  two"), (None, "one two"), (6, "one two three"), (8, long), (7, long), (9, "É é É é É é"), (10, "é é é é é é")]
    check(spark, rows)


def test_null_ids_alone_and_empty_table(spark):
    check(spark, [(None, "a b c d e f g"), (None, "a b c d e f g"), (None, None)])
    assert near_duplicate_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_keep_one_of_each_keeps_columns_and_repeated_rows_once(spark):
    text = " ".join(f"w{i}" for i in range(50))
    other = [None] * 9
    docs = spark.createDataFrame([(2, text, *other), (1, text, *other), (1, text, *other), (3, "", *other), (3, "", *other), (4, None, *other), (5, "a b", *other)], CLASHING)
    out = keep_one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] == text) for r in out.collect()) == [(1, True), (3, False), (3, False), (4, False), (5, False)]
