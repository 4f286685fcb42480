import random

from lineweave.llm.license_scan import BASE_PHRASES, LICENSE_TEXTS, op4_license_scan, scan_licenses
from tests.conftest import SF001
from tests.llm import brute


def base(doc_id, text):
    w, starts, labels = brute.alnum(text), [], set()
    for phrase, label in BASE_PHRASES.items():
        p = phrase.encode().split()
        at = [a for a in range(len(w) - len(p) + 1) if w[a : a + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return doc_id, len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def rows_of(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in df.collect()), key=str)


def test_base_places_match_a_scan_of_all_words(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    out = op4_license_scan(spark, SF001)
    assert rows_of(out) == sorted((base(*r) for r in docs), key=str)
    assert out.where("score < 0 or score > 1 or score is null").count() == 0
    assert out.where("labels = '' and score >= 0.6").count() == 0


def test_license_sentences_with_words_left_out_or_put_in(spark):
    mit, bsd = LICENSE_TEXTS[0][1], LICENSE_TEXTS[4][1]
    texts = [mit, mit.upper().replace("FREE OF CHARGE", "free of any charge"), bsd.replace("with or without ", ""), "free of charge and source", f"x {bsd} y {mit} z"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in scan_licenses(docs).collect()}
    assert [got[i][0] for i in range(5)] == ["mit", "mit", "bsd", "", "bsd,mit"]
    assert got[0][1] == 1.0 and 0.6 <= got[1][1] < 1.0 and got[3][1] < 0.6


def test_cases(spark):
    schema = "doc_id long, text string, rid int, words int, label string, template int, n_words int, k int"
    rows = [(1, None), (2, ""), (3, "...!"), (4, "cc by"), (4, "cc by"), (None, "CC-BY cc by"), (5, "all rights reserved. " * 9000), (6, "cc b y"), (7, "éall rights reserved"), (8, "general public\tlicense\n")]
    docs = spark.createDataFrame([(*r, *[None] * 6) for r in rows], schema)
    assert rows_of(scan_licenses(docs)) == sorted((base(*r) for r in rows), key=str)
    assert scan_licenses(docs.limit(0)).count() == 0


def voted(text):
    """(labels, score) by plain loops: 3-grams of every template at all places, diagonals, runs of near diagonals."""
    w, labels, score = brute.alnum(text), set(), 0.0
    for phrase, label in BASE_PHRASES.items():
        p = phrase.encode().split()
        if any(w[a : a + len(p)] == p for a in range(len(w))):
            labels, score = labels | {label}, 1.0
    for label, template in LICENSE_TEXTS:
        t = brute.alnum(template)
        grams = len(t) - 2
        votes = sorted((a - b, a) for b in range(grams) for a in range(len(w) - 2) if w[a : a + 3] == t[b : b + 3])
        runs = []
        for diagonal, place in votes:
            if runs and diagonal - runs[-1][-1][0] <= 3:
                runs[-1].append((diagonal, place))
            else:
                runs.append([(diagonal, place)])
        for run in runs:
            places, cover = [p for _, p in run], min(1.0, len(run) / grams)
            score = max(score, cover)
            if cover >= 0.6 and max(places) - min(places) + 1 <= 2 * (grams + 2):
                labels.add(label)
    return ",".join(sorted(labels)), round(score, 9)


def test_labels_and_scores_match_plain_voting(spark):
    rng = random.Random(3)
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    for k in range(120):
        parts = []
        for _, sentence in rng.sample(LICENSE_TEXTS, 3):
            w = [x for x in sentence.split() if rng.random() > 0.12]
            for _ in range(rng.randrange(4)):
                w.insert(rng.randrange(len(w) + 1), rng.choice(["source", "put", "in", "the"]))
            parts += w + ["between"] * rng.randrange(3)
        texts.append((100_000 + k, " ".join(parts)))
    got = {r["doc_id"]: (r["labels"], round(r["score"], 9)) for r in scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {i: voted(t) for i, t in texts} and len({x for x, _ in got.values()}) > 10
