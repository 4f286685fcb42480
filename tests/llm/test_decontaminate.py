import itertools
import random

import numpy as np

from lineweave.llm.decontaminate import MASKS, SHORT_MASKS, best_overlap, contaminated, op6_decontaminate, remove_contaminated
from tests.conftest import SF001
from tests.llm import brute


def prose(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(100_000)}" for _ in range(n)]


def test_finds_the_items_of_the_documents(spark):
    """Every document with 13 words of an item in a row is found, no other."""
    docs, items = (spark.read.parquet(f"{SF001}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    grams = {}
    for r in items:
        w = brute.alnum(r["text"])
        for a in range(max(1, len(w) - 12)):
            grams.setdefault(tuple(w[a : a + 13]), set()).add(r["item_id"])
    expected = set()
    for r in docs:
        w = brute.alnum(r["text"])
        expected |= {(r["doc_id"], i) for a in range(max(1, len(w) - 12)) for i in grams.get(tuple(w[a : a + 13]), ())}
    got = {(r["doc_id"], r["item_id"]) for r in op6_decontaminate(spark, SF001).collect()}
    assert got == expected and got


def test_substitutions_and_clean_documents(spark):
    rng = random.Random(5)
    items, docs = [], []
    for i in range(40):
        item = prose(rng, rng.choice([13, 20, 40]))
        items.append((i, " ".join(item)))
        changed = [w if rng.random() > 0.12 else "changed" for w in item] if len(item) > 13 else item
        docs.append((i, " ".join(prose(rng, 50) + changed + prose(rng, 30))))
        docs.append((1000 + i, " ".join(prose(rng, 100) + item[:9] + prose(rng, 20))))
    found = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    rows = found.collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(i, i) for i in range(40)}
    assert all(r["first_word"] >= 50 and r["first_word"] - r["item_first_word"] == 50 for r in rows)


def test_cases(spark):
    rng = random.Random(6)
    item = " ".join(prose(rng, 25))
    schema = "doc_id long, text string, key int, hash int, item_id int, hits int, place int, _key int"
    rows = [(1, item.upper()), (1, item.upper()), (2, None), (3, ""), (None, f"x {item} y"), (4, "clean"), (5, " ".join(prose(rng, 40_000)))]
    docs = spark.createDataFrame([(*r, *[None] * 6) for r in rows], schema)
    items = spark.createDataFrame([(1, item, 0), (1, item, 0), (2, item, 0), (3, None, 0), (None, item, 0), (4, "too short", 0), (5, "", 0)], "item_id long, text string, key int")
    assert sorted(((r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()), key=str) == [(1, 1), (1, 2), (None, 1), (None, 2)]
    out = remove_contaminated(docs, items)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 3, 4, 5]
    assert contaminated(docs.limit(0), items).count() == 0
    assert remove_contaminated(docs, items.limit(0)).count() == len(rows)


def test_every_stretch_that_qualifies_is_seen_on_a_diagonal():
    rng = np.random.default_rng(7)
    exact_then_poor = np.concatenate([np.ones(13, bool), np.tile([True, False, True, False, True], 20)])
    edges = np.array([c == "1" for c in "0111011101110" + "1" + "0000"])
    for same in [exact_then_poor, edges, *(rng.random(n) < 0.62 for n in rng.integers(5, 60, 300))]:
        y = np.arange(len(same), dtype=np.uint64)
        x, least = np.where(same, y, y + np.uint64(1000)), min(13, len(y))
        fits = [(a, e) for a in range(len(y)) for e in range(a + least, len(y) + 1) if 10 * same[a:e].sum() >= 7 * (e - a)]
        got = best_overlap(x, y, 0)
        assert (got is not None) == bool(fits) and (got is None or got[:2] in fits and got[2] == same[got[0] : got[1]].sum())


def test_masks_hit_every_pattern_that_the_rule_accepts():
    for n in range(1, 26):
        changed = n - -(-7 * n // 10)
        patterns = np.array([(1 << n) - 1 - sum(1 << i for i in c) for c in itertools.combinations(range(n), changed)])
        left = np.ones(len(patterns), bool)
        for mask in SHORT_MASKS.get(n, MASKS):
            for shift in range(n - len(mask) + 1):
                bits = int(mask[::-1], 2) << shift
                left &= patterns & bits != bits
        assert not left.any(), n


def test_substitutions_up_to_the_rule_and_short_items(spark):
    rng = random.Random(8)
    items, docs, expected = [], [], set()
    for i in range(60):
        n = rng.choice([3, 4, 5, 6, 9, 10, 12, 13, 13, 20, 40])
        item = prose(rng, n)
        places = range(3, n, 4) if n == 40 else rng.sample(range(n), n - -(-7 * n // 10))
        items.append((i, " ".join(item)))
        docs.append((i, " ".join(prose(rng, 30) + [f"new{k}" if k in places else w for k, w in enumerate(item)] + prose(rng, 30))))
        expected.add((i, i))
        if n < 13:  # a substitution more than the rule has
            places = rng.sample(range(n), n - -(-7 * n // 10) + 1)
            docs.append((1000 + i, " ".join(prose(rng, 30) + [f"new{k}" if k in places else w for k, w in enumerate(item)] + prose(rng, 30))))
    found = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == expected


def test_the_whole_rule_on_the_documents_and_on_changed_ones(spark):
    """All pairs by brute force: the given documents, copies of them, and documents with every sixth to second word new."""
    rng = random.Random(9)
    given = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    rows = given + [(i + 20_000, t) for i, t in given[::3]]
    for i, t in items * 4:
        share = rng.uniform(0.15, 0.5)
        rows.append((50_000 + len(rows), " ".join(prose(rng, 20) + [f"new{rng.random()}" if rng.random() < share else w for w in t.split()] + prose(rng, 20))))
    words = {i: brute.alnum(t) for i, t in rows}
    facing = [(i, brute.alnum(t)) for i, t in items]
    expected = {(d, i) for d, x in words.items() for i, y in facing if brute.overlapping(x, y)}
    found = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected and len(found) == len(expected)
    assert sum(d > 50_000 for d, _ in expected) not in (0, 4 * len(items))
    for r in found:
        x = words[r["doc_id"]][r["first_word"] : r["end_word"]]
        y = dict(facing)[r["item_id"]][r["item_first_word"] : r["item_end_word"]]
        assert len(x) == len(y) and r["n_same"] == sum(a == b for a, b in zip(x, y)) and 10 * r["n_same"] >= 7 * len(x)


def test_a_hot_item_and_copies(spark):
    """A third of the rows are one text; two items are equal; each id is reported once an item."""
    rng = random.Random(10)
    item = prose(rng, 20)
    text = " ".join(prose(rng, 30) + item)
    rows = [(i, text) for i in range(400)] + [(1000 + i, " ".join(prose(rng, 40) + item[:15] + prose(rng, 9))) for i in range(300)] + [(5000 + i, " ".join(prose(rng, 50))) for i in range(300)]
    items = [(1, " ".join(item)), (2, " ".join(item)), (3, " ".join(prose(rng, 20)))]
    found = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = [(r["doc_id"], r["item_id"], r["n_same"]) for r in found.collect()]
    assert sorted(got) == sorted((d, i, 20 if d < 1000 else 15) for d, _ in rows if d < 5000 for i in (1, 2))
