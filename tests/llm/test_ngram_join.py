import random
from itertools import combinations

import pytest

from lineweave.llm import ngram_join as nj
from lineweave.llm.ngram_join import boundary, jaccard_components, listed, needed, op11_jaccard_join, scanned, subset_sizes
from tests.conftest import SF001
from tests.llm import brute


def check(spark, rows, percent=80):
    got = [tuple(r) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()]
    expected = [(i, len(brute.shingles(t)), c) for (i, t), c in zip(rows, brute.components(rows, percent))]
    assert sorted(got, key=str) == sorted(expected, key=str)


def variants(rng, n, base, most):
    """Texts of a base text with some words changed, left out or added."""
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(most + 1)):
            at, kind = rng.randrange(len(text)), rng.randrange(3)
            if kind == 0:
                text[at] = f"x{rng.randrange(60)}"
            elif kind == 1 and len(text) > 1:
                del text[at]
            else:
                text.insert(rng.choice([0, len(text)]), f"y{rng.randrange(60)}")
        out.append(" ".join(text))
    return out


def test_documents_against_all_pairs(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["component_id"] for r in op11_jaccard_join(spark, SF001).collect()}
    assert got == dict(zip((i for i, _ in docs), brute.components(docs, 80)))


@pytest.mark.parametrize("most", [0, 7, 16])
def test_any_boundary_finds_the_same_links(spark, monkeypatch, most):
    """Small and large sets around the boundary, light with light, light with heavy, heavy with heavy."""
    monkeypatch.setattr(nj, "boundary", lambda *_: most)
    rng = random.Random(most)
    texts = []
    for size in (1, 3, 5, 8, 9, 10, 12, 14, 16, 18, 20, 24, 40, 90):
        texts += variants(rng, 14, [f"w{size}x{i}" for i in range(size)], 3)
    rows = list(enumerate(texts))
    assert 20 < len(set(brute.components(rows, 80))) < len(rows) - 20
    check(spark, rows)


def test_crowded_lists_lose_no_link(spark):
    """A family around the threshold, a passage in many other texts, and a group of near copies."""
    rng = random.Random(4)
    base, passage = [f"w{i}" for i in range(120)], " ".join(f"p{i}" for i in range(40))
    texts = variants(rng, 120, base, 6) + variants(rng, 60, [f"c{i}" for i in range(60)], 1)
    texts += [f"{passage} " + " ".join(f"o{i}x{j}" for j in range(rng.choice([3, 8, 30]))) for i in range(60)]
    check(spark, list(enumerate(texts)))


@pytest.mark.parametrize("percent", [50, 70, 95])
def test_other_thresholds(spark, percent):
    rng = random.Random(percent)
    check(spark, list(enumerate(variants(rng, 60, [f"w{i}" for i in range(60)], 8) + variants(rng, 30, [f"v{i}" for i in range(12)], 2))), percent)


def test_cases(spark):
    long = " ".join(f"word{i}" for i in range(30_000))
    check(spark, [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (5, "ONE  two"), (None, "one two"), (6, "one two three"), (8, long), (7, long + " end"), (9, "É é É é É é"), (10, "é é é é é é")])
    check(spark, [(None, "a b c d e f g"), (None, "a b c d e f g"), (None, None)])
    clashing = "doc_id long, text string, node string, n int, few int, key int, a int, b int, root int"
    docs = spark.createDataFrame([(2, "a b", *[None] * 7), (1, "A B", *[None] * 7)], clashing)
    assert sorted(map(tuple, jaccard_components(docs).collect())) == [(1, 1, 1), (2, 1, 1)]
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_first_shingles_of_linked_sets_meet():
    """Any two sets with the needed overlap share one of the larger's scanned and the smaller's listed members."""
    for percent in (50, 80, 95):
        for a in range(1, 40):
            for b in range(a, 100 * a // percent + 1):
                o = needed(a, b, percent)
                if o <= a:
                    # Worst case: what isn't shared comes first in both.
                    assert listed(a, percent) > a - o and scanned(b, percent) > b - o


def test_light_sets_share_a_subset_exactly_if_linked():
    members = range(9)
    for n, m in [(8, 9), (9, 9), (8, 8)]:
        for x in combinations(members, n):
            for y in combinations(members, m):
                linked = 100 * len(set(x) & set(y)) >= 80 * len(set(x) | set(y))
                shared = any(b == m and len(set(x) & set(y)) >= o for b, o in subset_sizes(n, 16, 80))
                assert x == y or linked == shared


def test_boundary_follows_the_cost():
    assert boundary({}, 0, 1.0, 80) == 0
    assert boundary({9: 1000}, 10**6, 1.0, 80) < boundary({9: 1000}, 10**6, 100.0, 80)
