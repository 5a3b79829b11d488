"""The pipeline against a plain version of every stage."""

import hashlib
import os

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from tidewire.llm import langid
from tidewire.llm._common import Scratch

from .test_decontam import brute
from .test_omh import brute_classes

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")


def plain(docs, items, model):
    kept = []
    for r in docs:
        _, p = model.predict([r.text])
        if any(c.isalpha() for c in r.text or "") and p[0] >= corpus_pipeline.LANGUAGE_SCORE:
            kept.append((r.doc_id, r.text))
    last = {}
    for d, t in kept:
        last[t] = max(d, last.get(t, d))
    kept = [(d, t) for d, t in kept if last[t] == d]
    first = brute_classes(kept)
    kept = [(d, t) for d, t in kept if first[d] == d]
    leaked = {d for d, _ in brute(kept, items)}
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = set()
    for d, t in kept:
        if d not in leaked:
            ids = library.encode(t, add_eos=True)
            digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
            out.add((d, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids))))
    return out


def test_run_equals_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {tuple(r) for r in got.collect()} == plain(docs.collect(), items, langid.fit(docs))


def test_stages_keep_columns_and_stand_odd_rows(spark, odd_documents, no_documents, tmp_path):
    spark.createDataFrame([(1, "some words here to read"), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd_documents, no_documents):
        scratch = Scratch(spark, "odd")
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = scratch.save(stage(spark, docs, f"file://{tmp_path}"), str(i))
            if i + 1 < len(corpus_pipeline.STAGES):
                assert out.columns == docs.columns
                docs = out
        assert out.count() == docs.count()


def test_documents_with_a_letter_stay_without_labels(spark, odd_documents):
    nobody = odd_documents.selectExpr("doc_id", "text", "cast(null as string) lang", "score")
    kept = corpus_pipeline.known_language(spark, nobody, "")
    assert kept.columns == nobody.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 3, 5, 6, 7]
