"""The pipeline stage by stage against the plain versions."""

import brute
import corpus_pipeline
from conftest import DATA
from pressloom.session import materialize


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    schema = docs.dtypes
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        pairs = [(i, r.text) for i, r in before.items()]
        docs = materialize(stage(spark, docs, DATA), name)
        after = docs.collect()
        kept = {r.doc_id for r in after}
        if name != "source_mixing":
            assert docs.dtypes == schema
        if name == "quality_rules":
            assert kept and all(brute.quality(before[i].text)[-1] is False for i in kept)
        if name == "near_dedup":
            assert kept == {w[0] for w in brute.groups(pairs, 5) if w[3]}
        if name == "benchmark_decontamination":
            assert kept == {w[0] for w in brute.contamination(pairs, bench) if not w[-1]}
        if name == "secret_scans":
            assert kept == set(before)
            assert {r.doc_id for r in after if r.text != before[r.doc_id].text} == {i for i, t in pairs if brute.secret_spans(t)}
            assert not any(brute.secret_spans(r.text) for r in after)
        if name == "source_mixing":
            assert kept <= set(before) and all(r.copy_no <= 2 for r in after)


def test_run(spark):
    found = corpus_pipeline.run(spark, DATA)
    assert found.columns[-1] == "copy_no" and found.count() > 0
