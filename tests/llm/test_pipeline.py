"""The pipeline's stages on a small folder of tables, each against its brute-force meaning."""

import os

import corpus_pipeline as c
from tests.conftest import SF001
from tests.llm.test_jaccard_join import brute
from threadsmith.llm import decontaminate, pii
from threadsmith.llm.poisson_mix import mix_sources


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    steps = [docs]
    for _, stage in c.STAGES:
        steps.append(stage(spark, steps[-1], SF001).cache())
    names = docs.columns
    assert all(s.columns == names for s in steps[:-1])
    texts = [{r.doc_id: r.text for r in s.collect()} for s in steps[:-1]]
    good = {r.doc_id for r in spark.read.parquet(f"{SF001}/labels.parquet").collect() if r.quality == 1}
    assert len(good & set(texts[1])) >= 0.95 * len(good & set(texts[0]))
    assert set(texts[2]) == {root for root, _ in brute(texts[1]).values()}
    matcher = decontaminate.Matcher([(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()])
    assert set(texts[3]) == {i for i, t in texts[2].items() if not matcher.search(t)}
    assert texts[4] == {i: pii.redact(t) for i, t in texts[3].items()}
    mixed = steps[5].select("doc_id", "mix_copy").collect()
    assert sorted(mixed) == sorted(mix_sources(steps[4]).select("doc_id", "mix_copy").collect())
    assert sorted(map(tuple, c.run(spark, SF001).select("doc_id", "mix_copy").collect())) == sorted(map(tuple, mixed))


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{name}.parquet").limit(0).write.parquet(os.path.join(tmp_path, f"{name}.parquet"))
    assert c.run(spark, str(tmp_path)).count() == 0


def test_null_rows_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, "k"), (1, None, None, None, None, "k"), (None, "", "x", None, 0, "l")],
                                 "doc_id long, text string, lang string, source string, n_chars long, key string")
    out = docs
    for _, stage in c.STAGES:
        out = stage(spark, out, SF001)
    assert out.columns == [*docs.columns, "mix_copy", "mix_key"]
    out.collect()
