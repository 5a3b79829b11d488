import zlib

import numpy as np

from tidewire.llm import langid

LETTERS = {"xx": "abcde", "yy": "vwxyz", "zz": "mnopqé"}


def corpus(spark, n=300):
    r = np.random.default_rng(1)
    rows = []
    for i in range(n):
        lang = list(LETTERS)[i % 3]
        text = " ".join("".join(r.choice(list(LETTERS[lang]), r.integers(2, 7))) for _ in range(r.integers(3, 40)))
        rows.append((i, text, None if i % 17 == 0 else lang, "s"))
    rows += [(1000, None, "xx", "s"), (1001, "", "xx", "s"), (1002, "12 %%", "yy", "s"), (None, "vwx zyx", "yy", "s")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")


def test_learns_and_marks_held_out(spark):
    df = corpus(spark)
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(got) == df.count()
    for d in df.collect():
        r = got[d.doc_id]
        assert r.held_out == (d.doc_id is None or zlib.crc32(str(d.doc_id).encode()) % 5 == 0)
        if d.doc_id is None or d.doc_id < 1000:
            assert 0 < r.score <= 1
        else:
            assert (r.lang_pred, r.score) == ("und", 0.0)
    held = [d for d in df.collect() if d.lang and d.doc_id is not None and d.doc_id < 1000 and got[d.doc_id].held_out]
    assert np.mean([got[d.doc_id].lang_pred == d.lang for d in held]) > 0.95


def test_counts_stay_within_texts():
    texts = ["ab", "", None, "bca", "x"]
    together = langid.gram_counts(texts)
    for i, t in enumerate(texts):
        assert (together[i] == langid.gram_counts([t])[0]).all()
    assert together.sum(axis=1).tolist() == [3, 0, 0, 6, 1]


def test_calibration_and_sparsity():
    r = np.random.default_rng(0)
    y = r.integers(0, 3, 600)
    offsets = np.arange(601) * 4
    buckets = np.column_stack([y, *(r.integers(3, 40, 600) * 3 + i for i in range(3))]).ravel()
    x = langid.Rows.of(offsets, buckets, np.ones(2400, int), np.ones(langid.BUCKETS, np.float32))
    w, b = langid.fit_ftrl(x, y, 3, np.arange(500))
    rows = x.dense(np.arange(500, 600))
    assert np.allclose(np.linalg.norm(rows[:, :-1], axis=1), 1)
    assert ((rows[:, :-1] @ w + b).argmax(axis=1) == y[500:]).mean() > 0.97
    assert (w[:3] != 0).any() and (w == 0).mean() > 0.9
    z = r.normal(size=(4000, 3))
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    told = np.array([r.choice(3, p=q) for q in p])
    assert abs(langid.fit_temperature(z * 3, told) - 3) < 0.4


def test_nothing_to_learn_from(spark, odd_documents, no_documents):
    assert langid.identify(no_documents).count() == 0
    nobody = odd_documents.selectExpr("doc_id", "text", "cast(null as string) lang", "score")
    assert {r.lang_pred for r in langid.identify(nobody).collect()} == {"und"}
    kept = langid.with_language(odd_documents, langid.fit(odd_documents), "text", "l", "p")
    assert kept.columns == [*odd_documents.columns, "l", "p"] and kept.count() == 9


def test_every_label_is_learned(spark):
    rows = [(i, f"{chr(0x4E00 + i % 230)} word{i % 230}x", f"l{i % 230:03}") for i in range(2300)] + [(i, "lone words", "only") for i in (5001, 5002, 5003)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.langs == sorted({r[2] for r in rows})


def plain_predict(model, text):
    """The likeliest label and its probability, n-gram by n-gram."""
    counts = {}
    lowered = [ord(c) for c in (text or "").lower()]
    for n in langid.ORDERS:
        for at in range(len(lowered) - n + 1):
            h = 0
            for c in lowered[at : at + n]:
                h = (h + c) * 0x9E3779B1 % 2**32
                h ^= h >> 15
            bucket = ((h + n) * 0x85EBCA6B % 2**32) >> (32 - (langid.BUCKETS.bit_length() - 1))
            counts[bucket] = counts.get(bucket, 0) + 1
    x = {b: (1 + np.log(k)) * float(model.idf[b]) for b, k in counts.items()}
    length = sum(v * v for v in x.values()) ** 0.5 or 1.0
    z = [sum(v / length * float(model.weights[b, i]) for b, v in x.items()) + float(model.bias[i]) for i in range(len(model.langs))]
    e = np.exp(np.array(z) / model.temperature - max(z) / model.temperature)
    return int(e.argmax()), float(e.max() / e.sum())


def test_prediction_equals_a_plain_one(spark):
    df = corpus(spark)
    model = langid.fit(df)
    long = "abc vwx " * 20_000
    for text in [r.text for r in df.limit(40).collect()] + [long, "É", "a", "mno pqİ xyz"]:
        best, p = model.predict([text])
        want, q = plain_predict(model, text)
        assert best[0] == want and abs(p[0] - q) < 1e-4, text[:40]


def test_very_long_texts_are_read_whole(spark):
    rows = [(1, "vwxyz " * 50_000, None, "s"), (2, "12 " * 50_000 + "vwx", None, "s")]
    df = corpus(spark).unionByName(spark.createDataFrame([(d + 5000, *r) for d, *r in rows], "doc_id bigint, text string, lang string, score string"))
    got = {r.doc_id: r.lang_pred for r in langid.identify(df).collect()}
    assert got[5001] == "yy" and got[5002] != "und"
