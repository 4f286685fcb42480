import random

import pytest

from lineweave.llm import textops as T
from lineweave.llm.substring_dedup import Chunks, op7_substring_dedup, remove_repeated_passages, spacing
from tests.conftest import SF001
from tests.llm import brute


def prose(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(100_000)}" for _ in range(n)]


def ranges(spark, rows):
    out = remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), ranges="cut")
    return sorted(((r["doc_id"], [(c["first_word"], c["end_word"]) for c in r["cut"]], r["text"]) for r in out.collect()), key=str)


def test_matches_windows_on_the_documents(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    out = op7_substring_dedup(spark, SF001).collect()
    got = {r["doc_id"]: [tuple(map(int, c.split("-"))) for c in r["removed"].split(",") if c] for r in out}
    assert got == brute.repeated(docs)


def test_planted_passages_are_cut_exactly_and_short_ones_stay(spark):
    rng = random.Random(1)
    rows, expected = [], {}
    for n in (49, 50, 51, 60, 75, 200):
        for _ in range(8):
            passage, i = prose(rng, n), len(rows)
            before, behind = prose(rng, rng.randrange(60)), prose(rng, 40)
            rows.append((i, " ".join(prose(rng, 30) + passage + prose(rng, 20))))
            rows.append((i + 1, "  ".join(before) + " \n" + " ".join(passage + behind)))
            expected[i], expected[i + 1] = [], [(len(before), len(before) + n)] if n >= 50 else []
    got = ranges(spark, rows)
    assert {i: c for i, c, _ in got} == expected
    for i, c, text in got:
        whole = dict(rows)[i].split()
        assert text.split() == [w for k, w in enumerate(whole) if not any(a <= k < e for a, e in c)]
        if not c:
            assert text == dict(rows)[i]


def test_insertions_shift_nothing(spark):
    rng = random.Random(2)
    passage = prose(rng, 300)
    shifted = passage[:120] + ["inserted"] + passage[120:]
    got = ranges(spark, [(1, " ".join(passage)), (2, " ".join(shifted))])
    assert got[1][1] == [(0, 120), (121, 301)] and got[1][2].strip() == "inserted"


def test_cases(spark):
    rng = random.Random(4)
    p = " ".join(prose(rng, 80))
    schema = "doc_id long, text string, key int, _key int, _runs int, _ranges int, doc int, digest int, a int"
    rows = [(1, p), (1, p), (2, p), (None, p), (3, None), (4, ""), (5, "short"), (6, " ".join(prose(rng, 30_000))), (7, "")]
    rows[-1] = (7, rows[-2][1])
    docs = spark.createDataFrame([(*r, *[None] * 7) for r in rows], schema)
    out = remove_repeated_passages(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    expected = [(1, p), (1, p), (2, ""), (None, ""), (3, None), (4, ""), (5, "short"), (6, rows[7][1]), (7, "")]
    assert got == sorted(expected, key=str)
    assert remove_repeated_passages(docs.limit(0)).count() == 0


@pytest.mark.parametrize("least", [1, 2, 5, 12, 50])
def test_windows_hold_the_same_chunks_in_any_context(least):
    """Two copies of a stretch of words among other words: each of its windows holds the same chunks."""
    rng = random.Random(least)
    for words in (prose(rng, 3 * least), (["a", "b"] * 3 * least)[: 3 * least], [rng.choice("xyz") for _ in range(3 * least)]):
        seen = []
        for before, behind in ((0, 0), (37, 5), (8, 61)):
            text = " ".join(prose(rng, before) + words + prose(rng, behind)).encode()
            chunks = Chunks(T.hash_words([text], lower=False), least)
            held = {a - before: tuple(chunks.digest[lo:hi]) for a, lo, hi in zip(chunks.at, chunks.lo, chunks.hi)}
            seen.append([held[a] for a in range(len(words) - least + 1)])
            k, w = spacing(least)
            real = chunks.real
            assert least < 2 or ((chunks.end - chunks.first)[real] <= w + k).all()
        assert seen[0] == seen[1] == seen[2] and (least < 12 or all(seen[0]))


def test_chunks_are_few():
    rng = random.Random(8)
    chunks = Chunks(T.hash_words([" ".join(prose(rng, 20_000)).encode(), (b"same " * 20_000)], lower=False), 50)
    assert len(chunks.digest[chunks.first < 20_000]) < 20_000 / 9 and len(set(chunks.digest[chunks.first >= 20_000])) == 1


def test_other_lengths(spark):
    rng = random.Random(12)
    for least in (2, 7, 20):
        rows = []
        for n in (least - 1, least, least + 3):
            passage = prose(rng, n)
            rows += [(len(rows) + i, " ".join(prose(rng, 9 + 5 * i) + passage + prose(rng, 11))) for i in range(2)]
        out = remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), min_words=least, ranges="cut").collect()
        assert {r["doc_id"]: [(c["first_word"], c["end_word"]) for c in r["cut"]] for r in out} == brute.repeated(rows, least)


def test_tables_and_periodic_text_are_cut_like_prose(spark):
    rng = random.Random(5)
    cells = lambda n: [w for k in range(n) for w in ("|", f"c{rng.randrange(100_000)}")]
    rows = []
    for n in (25, 28, 31, 60):
        for _ in range(6):
            passage = cells(n)
            for _ in range(2):
                rows.append((len(rows), " ".join(prose(rng, rng.randrange(40)) + cells(rng.randrange(40)) + passage + cells(rng.randrange(40)))))
    for period in (["a"], ["a", "b"], ["a", "a", "b"], ["a", "b", "c", "d", "e"]):
        rows += [(len(rows) + i, " ".join(prose(rng, 10 * i + 7) + period * 60 + prose(rng, 20))) for i in range(3)]
    expected = brute.repeated(rows)
    assert sum(map(bool, expected.values())) >= 28
    assert {i: c for i, c, _ in ranges(spark, rows)} == expected


def test_passages_whose_parts_stand_in_earlier_documents(spark):
    rng = random.Random(6)
    p = prose(rng, 60)
    rows = [(i, " ".join(prose(rng, 30) + part + prose(rng, 30))) for i, part in enumerate((p[:46], p[15:], p, p))]
    lines = [prose(rng, 12) for _ in range(20)]
    rows += [(len(rows) + i, " ".join(w for _ in range(4) for w in rng.choice(lines) + prose(rng, rng.randrange(5)))) for i in range(100)]
    for _ in range(12):
        passage = [w for line in rng.sample(lines, 6) for w in line]
        rows += [(len(rows) + i, " ".join(prose(rng, 20 + i) + passage + prose(rng, 20))) for i in range(2)]
    expected = brute.repeated(rows)
    assert expected[3] == [(30, 90)] and all(expected[len(rows) - 1 - 2 * i] for i in range(12))
    assert {i: c for i, c, _ in ranges(spark, rows)} == expected
