"""The pipeline: stages, columns, what each stage keeps, plain Python by hand."""

import hashlib

import corpus_pipeline
from plantlake.llm.common import stored

from .test_bpe import expected
from .test_jaccard import brute_force


def test_stages_in_turn(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], sf_dir), "stage"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept[-1].columns == columns
            assert kept[-1].subtract(docs).isEmpty()
    judged, exact, near, mixed, coded = ([*df.collect()] for df in kept[1:])

    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    left = {r.doc_id for r in judged}
    clean = [k for k, r in labels.items() if r.quality == 1 and r.toxic == 0]
    poor = [k for k, r in labels.items() if r.quality == 0]
    assert sum(k in left for k in clean) >= 0.97 * len(clean)
    assert sum(k in left for k in poor) <= 0.1 * len(poor)

    last = {}
    for r in judged:
        key = hashlib.sha256((r.text or "").encode().lower()).digest()
        last[key] = max(r.doc_id, last.get(key, -1))
    assert {r.doc_id for r in exact} == set(last.values()) and len(exact) == len(last)

    groups = brute_force([(r.doc_id, r.text) for r in exact])
    assert {r.doc_id for r in near} == {k for k, _, component in groups if k == component}

    assert {r.doc_id for r in mixed} <= {r.doc_id for r in near}
    assert max(map([r.doc_id for r in mixed].count, {r.doc_id for r in mixed})) <= 3
    assert sorted(map(tuple, coded)) == sorted((r.doc_id, *expected(r.text)) for r in mixed)


def test_run_equals_the_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100
    assert corpus_pipeline.ORACLE_SQL is None
