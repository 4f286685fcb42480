import corpus_pipeline
from lineweave.llm.fm import scored
from lineweave.llm.quality import fit_quality
from lineweave.llm.tables import cut
from tests.conftest import SF001
from tests.llm import brute


def as_dict(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = fit_quality(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    items = {tuple(w[a : a + 13]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect() for w in [brute.alnum(r["text"])] for a in range(max(1, len(w) - 12))}
    for name, stage in corpus_pipeline.STAGES:
        before = as_dict(docs)
        out = cut(stage(spark, docs, SF001), "test-stage")
        rows = sorted(before.items())
        if name == "packing":
            assert {r["doc_id"] for r in out.collect()} == set(before)
            break
        assert out.columns == docs.columns
        after = as_dict(out)
        assert out.count() == len(after)
        if name == "quality classifier":
            expected = {r["doc_id"]: before[r["doc_id"]] for r in scored(docs, model).where("predicted = 1").collect()}
        elif name == "near-dedup":
            expected = {i: t for (i, t), c in zip(rows, brute.components(rows, 80)) if i == c}
        elif name == "substring dedup":
            expected = {}
            for i, ranges in brute.repeated(rows).items():
                kept = [w for k, w in enumerate(before[i].split()) if not any(a <= k < e for a, e in ranges)]
                if kept or not ranges:
                    expected[i] = kept
            after = {i: t.split() for i, t in after.items()}
        else:
            clean = lambda w: not any(tuple(w[a : a + 13]) in items for a in range(max(1, len(w) - 12)))
            expected = {i: t for i, t in before.items() if clean(brute.alnum(t))}
        assert after == expected, name
        docs = out


def test_run_and_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, key long, _key int, score int, h long"
    rows = [(1, None), (None, None), (2, ""), (3, "a b c d e f g"), (3, "a b c d e f g"), (4, "word " * 20_000), (None, "x")]
    spark.createDataFrame([(*r, "en", None, len(r[1] or ""), 1, 2, 3, 4) for r in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted({str(r["doc_id"]) for r in out}) == ["1", "2", "3", "4", "None"] and sum(r["doc_id"] == 3 for r in out) == 1
    empty = str(tmp_path / "empty")
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{t}.parquet").limit(0).write.parquet(f"{empty}/{t}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
