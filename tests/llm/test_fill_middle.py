import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lineweave.llm import fill_middle as fim
from lineweave.llm.fill_middle import blocks_of, fill_in_middle, op13_fill_middle, restored
from tests.conftest import SF001


def units_of(text, unit):
    if unit == "char":
        return list(text)
    if unit == "line":
        return text.splitlines(keepends=True) if not set(text) & set("\r\x0b\x0c\x1c\x1d\x1e\x85  ") else [x + "\n" for x in text.split("\n")[:-1]] + [x for x in text.split("\n")[-1:] if x]
    out = []
    for c in text:
        if out and not (out[-1][-1] in " \t\n\x0b\x0c\r" and c not in " \t\n\x0b\x0c\r"):
            out[-1] += c
        else:
            out.append(c)
    return out


def model(doc_id, text, unit="char", seed=1):
    """Plain Python: (n, form, prefix units, middle units, output)."""
    text = text or ""
    units = units_of(text, unit)
    n, digest = len(units), hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def check(spark, rows, unit="char"):
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, _whole string, _draws int")
    out = fill_in_middle(docs, unit=unit).withColumn("back", restored(F.col("fim.output"), F.col("fim.form")))
    got = [(r["doc_id"], r["text"], r["_whole"], r["_draws"], *r["fim"], r["back"]) for r in out.collect()]
    expected = [(i, t, "x", 7, *model(i, t, unit), t or "") for i, t in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)


TEXTS = [None, "", " ", "a", "<P>", "a<S>b", "x<M", "<", "P>", "añ😀 b\tc\n\nd", "\n\n", "no break", "  lead", "trail  ", "one\r\ntwo\x0bthree four"]


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_against_plain_python(spark, unit, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS * 20)] + [(None, "without an id"), (5, "again"), (5, "again")]
    check(spark, rows, unit)


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_blocks_join_to_the_units_of_the_text(unit):
    text = "añ😀b  c\n\tdd ee\n\n fff😀😀 g" * 9
    raw = text.encode()
    for limit in (1, 2, 3, 5, 17, 64):
        ranges = list(blocks_of(raw, unit, limit))
        assert [lo for lo, _ in ranges[1:]] == [hi for _, hi in ranges[:-1]] and ranges[0][0] == 0 and ranges[-1][1] == len(raw)
        blocks = [raw[lo:hi] for lo, hi in ranges]
        assert [u for b in fim.unit_lists(blocks, unit).to_pylist() for u in b] == units_of(text, unit)
    assert list(blocks_of(b"", unit)) == [(0, 0)]


def test_a_long_text_is_worked_on_in_blocks(spark):
    text = "añ😀 word\n" * 400_000
    check(spark, [(i, text[i:]) for i in range(3)] + [(9, "short")])


def test_role_pieces_take_units_between_ordinals():
    lists = fim.unit_lists([b"abc", b"", b"de"], "char")
    base = np.array([0, 3, 3])
    lo, hi = np.array([1, 1, 1]), np.array([4, 4, 4])
    assert [p.to_pylist() for p in fim.role_pieces(lists, base, [(lo, hi)])] == [["bc", "", "d"]]


def test_empty_table(spark):
    assert fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_plain_python(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = op13_fill_middle(spark, SF001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        *fields, output = model(r["doc_id"], docs[r["doc_id"]])
        assert tuple(r) == (r["doc_id"], *fields, sha(output), sha(docs[r["doc_id"]] or ""))
