"""The pipeline against a plain version of its decisions."""

import corpus_pipeline
from panelforge.llm import decontaminate
from tests.llm.test_exactness import plain_fingerprint

DATA = "/root/testdata/sf0.001"


def test_stages_and_result(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    first = corpus_pipeline.STAGES[0][1](spark, docs, DATA)
    assert first.columns == docs.columns
    kept = {r.doc_id: r.text for r in first.collect()}
    every = {r.doc_id: r.text for r in docs.collect()}
    assert all(any(c.isalpha() for c in every[i]) for i in kept)
    assert len(kept) >= 0.97 * len(every)  # clean documents stay

    by_text = {}
    for i, t in kept.items():
        by_text[t] = max(i, by_text.get(t, i))
    left = {i: t for t, i in by_text.items()}
    prints = {i: plain_fingerprint(t) for i, t in left.items()}
    groups = []
    for i, p in prints.items():
        near = [g for g in groups if any((p ^ prints[j]).bit_count() <= 2 for j in g)]
        groups = [g for g in groups if g not in near] + [{i}.union(*near)]
    left = {min(g): left[min(g)] for g in groups}
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    quoted = {i for i, t in left.items() for b in items if decontaminate.normalise(b) in decontaminate.normalise(t)}

    rows = corpus_pipeline.run(spark, DATA).collect()
    found = {r.doc_id: r for r in rows}
    assert len(found) == len(rows) and not quoted & set(found)
    assert set(found) == set(left) - quoted
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
