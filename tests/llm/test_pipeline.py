"""The pipeline's stages, and a whole run against plain Python over the given tables."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from orderloom.llm import pii, quality_model, toxicity
from tests.llm.fixtures import documents, empty
from tests.llm.test_near_dedup import smallest_reachable

SF = "/root/testdata/sf0.001"


def test_run_equals_plain_steps(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    good = {r["doc_id"] for r in quality_model.quality(spark, docs, labels).collect() if r["predicted"]}
    first = docs.where(docs["doc_id"].isin(list(good)))
    bad = {r["doc_id"] for r in toxicity.toxicity(spark, first, labels).collect() if r["predicted"]}
    texts = [(r["doc_id"], r["text"]) for r in first.collect() if r["doc_id"] not in bad]
    groups = smallest_reachable(texts)
    left = docs.where(docs["doc_id"].isin([d for d, g in groups.items() if d == g]))
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r["doc_id"]: len(plain.encode(r["text"], add_special_tokens=False).ids) + 1 for r in pii.masked(left).collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in rows} == want
    assert sum(r["length"] for r in rows) == sum(want.values())
    assert 0 < len(want) < docs.count()


def test_stages_on_awkward_documents(spark):
    for docs in (documents(spark), empty(spark)):
        rows = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= rows
            docs = out
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert "doc_id" in last.columns and (last.count() > 0) == (docs.count() > 0)
    assert not np.isnan(quality_model.THRESHOLD)


def test_five_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_model", "toxicity", "near_dedup", "pii", "packing"]
