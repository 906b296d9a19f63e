"""The corpus pipeline against the same decisions taken by brute force."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tremor.llm import langid, registry, simhash

from .test_dedup import brute_lines, brute_roots

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if not model.rejects(*model.predict(r.text)))
    rows = [(d, "\n".join(kept)) for d, kept, _ in brute_lines(rows)]
    roots = brute_roots([simhash.fingerprint(t, 4) for _, t in rows], 4)
    rows = [rows[i] for i in sorted(set(roots))]
    items = [r.text.lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(d, t) for d, t in rows if not any(i in t.lower() for i in items)]
    t = Tokenizer.from_file(public_tokenizers.path(registry.TOKENIZER))
    t.encode_special_tokens = True
    want = {d: len(t.encode(text, add_special_tokens=False).ids) + 1 for d, text in rows}
    got: dict[int, int] = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_stages_return_the_columns_of_documents(spark, messy):
    docs = messy
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
            out = spark.createDataFrame(out.collect(), messy.schema)
        docs = out
    assert np.sum([r.length for r in docs.collect()]) > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, messy.limit(0), SF).count() == 0
