import hashlib
from collections import Counter

import numpy as np

from tidewire.llm._common import Scratch
from tidewire.llm.suffix_buckets import _sliding_argmin, repeated_spans


def brute(texts):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[p : p + 200] for b in data for p in range(len(b) - 199))
    out = []
    for b in data:
        marked = np.zeros(len(b) + 2, int)
        for p in range(len(b) - 199):
            if count[b[p : p + 200]] > 1:
                marked[p + 1 : p + 201] = 1
        kept = bytes(c for c, m in zip(b, marked[1:-1], strict=True) if not m)
        out.append((len(b), int(marked.sum()), int((np.diff(marked) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_sliding_argmin():
    h = np.random.default_rng(0).integers(0, 2**63, 500).astype(np.uint64)
    h[100:200] = h[50]
    for width in (1, 7, 137, 500):
        got = _sliding_argmin(h, width)
        assert got.tolist() == [i + int(np.argmin(h[i : i + width] >> np.uint64(24))) for i in range(500 - width + 1)]


def test_equals_brute_force(spark, prose):
    r = prose.random
    passages = [prose(r.randrange(30, 120)) for _ in range(5)]
    texts = [None, "", "short", "a" * 199, "a" * 200, "a" * 450, "ab" * 200, "é" * 150]
    for _ in range(100):
        x = prose(r.randrange(5, 120))
        for _ in range(r.randrange(3)):
            q = r.choice(passages)
            at = r.randrange(len(q) // 2)
            x += " " + q[at : at + r.randrange(150, 400)] + " " + prose(r.randrange(1, 50))
        texts.append(x)
    texts += [texts[20], texts[21], texts[21]]
    words = texts[30].split()
    for k in range(15):
        z = list(words)
        z[r.randrange(len(z))] = f"zz{k}"
        texts.append(" ".join(z))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in repeated_spans(df).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_odd_rows(odd_documents, no_documents):
    assert repeated_spans(odd_documents).count() == 9
    assert repeated_spans(no_documents).count() == 0


def test_very_long_texts_and_a_passage_that_many_share(spark):
    r = np.random.default_rng(4)
    letters = lambda n: bytes(r.integers(97, 123, n, dtype=np.uint8)).decode()
    passage, shared = letters(300), letters(400)
    long = letters(100_000) + "0" + passage + "1" + letters(2_600_000) + "2" + passage + "3" + letters(50)
    texts = [long, "4" + passage + "5", *(f"{letters(60)}6{i:03}{shared}{i:03}7{letters(60)}" for i in range(60)), *(letters(500) for _ in range(60))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in repeated_spans(df).collect()}
    assert got[0][:3] == (len(long), 600, 2) and got[1][:3] == (302, 300, 1)
    assert [got[i] for i in range(2, len(texts))] == brute(texts[2:])


def test_odd_rows_values(odd_documents):
    got = sorted((x.doc_id or 0, x.n_bytes, x.n_removed, x.n_spans) for x in repeated_spans(odd_documents).collect())
    assert got == [(0, 23, 0, 0), (1, 0, 0, 0), (2, 0, 0, 0), (3, 23, 0, 0), (3, 23, 0, 0), (4, 5, 0, 0), (5, 50_004, 50_000, 1), (6, 25, 0, 0), (7, 25, 0, 0)]


def test_other_splits_of_the_input_midway(spark, prose, tmp_path, monkeypatch):
    """A lost executor changes how many splits a scan has; the numbers of rows must not follow."""
    passage = prose(60)
    texts = [prose(40) + (" " + passage if i % 3 == 0 else "") + f" {i}" for i in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows.repartition(12).write.parquet(f"{tmp_path}/documents")
    settings = {"spark.sql.leafNodeDefaultParallelism": "1", "spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "64m"}
    real, saved = Scratch.save, []

    def save(self, df, name, *how, **more):
        out = real(self, df, name, *how, **more)
        if not saved:
            for k, v in settings.items():
                spark.conf.set(k, v)
        saved.append(name)
        return out

    monkeypatch.setattr(Scratch, "save", save)
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "12")
        found = repeated_spans(spark.read.parquet(f"{tmp_path}/documents")).collect()
    finally:
        for k in settings:
            spark.conf.unset(k)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in found}
    assert len(saved) > 5 and got == dict(enumerate(brute(texts)))
