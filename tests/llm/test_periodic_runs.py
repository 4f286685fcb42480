import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lineweave.llm.periodic_runs import gram_words, op12_periodic_runs, periodic_runs
from lineweave.llm.suffix_tree import CommonExtension, SuffixTree, runs
from tests.conftest import SF001


def brute_runs(w, least=6, exponent=4):
    """Every period is tried at every place; a run counts under its smallest period."""
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, exponent * q) and not any(s <= i and i + length <= s + k and q % p == 0 for s, k, p in out):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def strings(rng, n):
    """Random words over small alphabets, with periodic parts next to and inside one another."""
    out = []
    while len(out) < n:
        root = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.choice([1, 1, 2, 3, 5, 8]))]
        out += (root * rng.choice([1, 2, 4, 5, 7]))[: rng.choice([3, 9, 20, 60])]
    return out[:n]


@pytest.mark.parametrize("least, exponent", [(6, 4), (4, 2), (2, 2), (9, 3)])
def test_runs_against_all_periods(least, exponent):
    rng = random.Random(least)
    for _ in range(300):
        w = strings(rng, rng.randrange(1, 70))
        assert [tuple(r) for r in runs(np.array(w), least, exponent).tolist()] == brute_runs(w, least, exponent)


def test_tree_gives_sorted_suffixes_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(100):
        w = [rng.randrange(1, 4) for _ in range(rng.randrange(1, 40))]
        leaves, between = SuffixTree(w, 3).tour()
        end = [*w, 0]
        assert leaves.tolist() == sorted(range(len(end)), key=lambda i: end[i:])
        a, b = (np.array(x) for x in zip(*[(i, j) for i in range(len(end)) for j in range(len(end)) if i != j]))
        expected = [next(k for k in range(len(end)) if end[i + k] != end[j + k]) for i, j in zip(a, b)]
        assert CommonExtension(leaves, between)(a, b).tolist() == expected


def test_grams_of_any_run_occur_twice():
    for least, exponent in [(6, 4), (2, 2), (9, 3), (5, 2)]:
        k = gram_words(least, exponent)
        for q in range(1, 40):
            assert max(least, exponent * q) - k + 1 >= 2 * q or k == 1


def check(spark, rows):
    got = periodic_runs(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, start string, Runs_ int")).collect()
    expected = []
    for i, t in rows:
        w = words_of(t)
        found = brute_runs(w)
        expected.append((i, t, "x", 1, found, collapsed(w, found)))
    assert sorted([(*r[:4], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got], key=str) == sorted(expected, key=str)


def test_texts_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{x}" for x in strings(rng, rng.randrange(0, 120)))) for i in range(300)]
    rows += [(i, rng.choice(["", " ", "\n"]).join(f"É{x}\t" for x in strings(rng, 40))) for i in range(300, 320)]
    check(spark, rows)


def test_cases(spark):
    prose = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "a " * 5), (6, "a " * 6), (6, "a " * 6), (None, "b c " * 4), (7, prose), (8, "a b a b a b a"), (9, "a b a b a b a b")]
    check(spark, rows)
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_texts(spark):
    rng = random.Random(2)
    root = [f"r{rng.randrange(900)}" for _ in range(20_000)]
    text = " ".join([*(f"w{i}" for i in range(50_000)), *(root * 5), "one", *["again"] * 40_000])
    row = periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    found = [tuple(r) for r in row["runs"]]
    # A root of random words may hold a short run of its own; the two long ones are known.
    assert [r for r in found if r[1] > 1000] == [(50_000, 100_000, 20_000), (150_001, 40_000, 1)]
    assert row["collapsed"] == collapsed(text.split(" "), found)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op12_periodic_runs(spark, SF001).collect()}
    assert len(got) == len(docs)
    with_runs = 0
    for doc_id, text in docs:
        w, h = words_of(text), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute_runs(w)
        with_runs += bool(found)
        top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
        expected = (doc_id, len(found), *top, top[0] is not None and 1000 * top[1] // top[2] or None)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(w, found))]
        assert tuple(got[doc_id]) == (*expected, *sha)
    assert with_runs > 10
