import numpy as np
import pytest
from pyspark.sql import functions as F

from lineweave.llm import fm
from lineweave.llm import textops as T
from lineweave.llm.quality import SETTINGS as QUALITY
from lineweave.llm.quality import fit_quality, keep_quality, op10_quality
from lineweave.llm.toxicity import SETTINGS as TOXICITY
from lineweave.llm.toxicity import fit_toxicity, op1_toxicity

SF001, SF01, SF1 = (f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1"))


def held_out_accuracy(spark, out, sf_dir, label):
    rows = out.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out")
    return rows.select(F.avg((F.col("predicted") == F.col(label)).cast("double")), F.count("*")).first()


def test_quality_holds_on_unseen_documents(spark):
    out = op10_quality(spark, SF01).cache()
    assert out.count() == 1000
    accuracy, n = held_out_accuracy(spark, out, SF01, "quality")
    assert n > 100 and accuracy >= 0.97
    assert out.where("predicted <> cast(score >= 0.5 as int) or score < 0 or score > 1 or score is null").count() == 0
    folds = out.where(f"held_out <> (crc32(cast(cast(doc_id as string) as binary)) % 3 = 1)").count()
    assert folds == 0


def test_toxicity_holds_on_unseen_documents(spark):
    out = op1_toxicity(spark, SF1).cache()
    rows = out.join(spark.read.parquet(f"{SF1}/labels.parquet"), "doc_id").where("held_out")
    hit, found, there = rows.select(F.sum(F.expr("predicted * toxic")), F.sum("predicted"), F.sum("toxic")).first()
    assert hit / found >= 0.9 and hit / there >= 0.8
    assert out.where("held_out <> (crc32(cast(cast(doc_id as string) as binary)) % 5 = 0)").count() == 0


def test_score_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(1)
    model = fm.Model(TOXICITY, 0.3, linear=rng.normal(size=30), factors=rng.normal(size=(30, 8)))
    rows = [sorted(rng.choice(30, size=n, replace=False)) for n in (0, 1, 2, 7, 30)]
    run = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    got = fm.logits(model, np.concatenate(rows).astype(np.int64), run)
    for z, row in zip(got, rows):
        pairs = sum(model.factors[i] @ model.factors[j] for a, i in enumerate(row) for j in row[a + 1 :])
        assert z == pytest.approx(0.3 + model.linear[row].sum() + pairs)


def test_pairwise_weights_learn_what_additive_ones_cannot():
    """Label 1 exactly for one of two features, the exclusive or."""
    rows = [[], [0], [1], [0, 1]] * 200
    y = np.array([0.0, 1.0, 1.0, 0.0] * 200)
    run = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    numbers = np.array([i for r in rows for i in r], np.int64)
    model = fm.Model(fm.Settings(separators=T.WHITE, epochs=60, decay=0.0), 0.0, linear=np.zeros(2), factors=np.zeros((2, 8)))
    fm.train(model, numbers, run, y)
    assert ((fm.logits(model, numbers, run) > 0) == (y == 1)).all()


@pytest.mark.parametrize("rule", ["either but not both", "both"])
def test_words_that_count_in_company_only_are_learned(spark, rule):
    """Through ``fit``, on texts: neither word tells anything alone (of the exclusive or)."""
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(6000):
        a, b = rng.random(2) < 0.5
        words = [f"w{j}" for j in rng.integers(0, 3000, 30)] + ["apple"] * bool(a) + ["stone"] * bool(b)
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(a != b) if rule != "both" else int(a and b)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit_toxicity(docs, known)
    out = fm.scored(docs, model).join(known, "doc_id").where(fm.fold("doc_id", 5) == 0)
    accuracy, n = out.select(F.avg((F.col("predicted") == F.col("toxic")).cast("double")), F.count("*")).first()
    assert n > 1000 and accuracy >= 0.95


def test_pair_gain_finds_pairs_and_leaves_chance_alone():
    rng = np.random.default_rng(3)
    x = (rng.random((4000, 60)) < 0.4).astype(np.float32)
    y = ((x[:, 7] != x[:, 31]) ^ (rng.random(4000) < 0.1)).astype(np.float32)
    gain = fm.in_pairs(x, y, TOXICITY)
    assert set(np.flatnonzero(gain >= TOXICITY.least_pair_gain)) == {7, 31}


def test_training_never_sees_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(fm.fold("doc_id", 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (fit_quality(docs, x) for x in (labels, flipped))
    assert a.bias == b.bias and (a.linear == b.linear).all() and (a.factors == b.factors).all()


def test_cases(spark):
    schema = "doc_id long, text string, score double, predicted int, y int, held_out boolean, stats string"
    rows = [(1, None), (2, ""), (None, "a b"), (3, "x"), (3, "x"), (4, "long " * 40_000)]
    docs = spark.createDataFrame([(*r, *[None] * 5) for r in rows], schema)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    empty = fm.scored(docs, fit_quality(docs, none)).collect()
    assert len(empty) == len(rows) and {r["score"] for r in empty} == {0.5}
    one_class = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 0, 0), (3, None, None), (4, 1, 1)], none.schema)
    assert all(r["predicted"] == 1 for r in fm.scored(docs, fit_toxicity(docs, one_class)).collect())
    kept = keep_quality(docs, docs, one_class)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert fm.scored(docs.limit(0), fit_quality(docs.limit(0), none)).count() == 0
    assert len(QUALITY.statistics(T.hash_words([b"", b"A b|c\n1"]), [b"", b"A b|c\n1"])) == 2
