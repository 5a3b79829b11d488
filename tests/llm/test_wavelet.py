import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewire.llm import wavelet

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 63, 512, 513, 5000])
def test_wavelet_matrix(n):
    r = np.random.default_rng(n)
    a = r.integers(0, 50_258, n)
    a[::5] = 17
    m = wavelet.WaveletMatrix.of(a, 16)
    assert (m.unpack() == a).all()
    if not n:
        return
    at = r.integers(0, n, 50)
    assert (m.access(at) == a[at]).all()
    for token in {17, int(a[0]), int(a[-1]), 3, 65_000}:
        places = np.flatnonzero(a == token)
        assert m.count(token) == len(places) and (m.occurrences(token) == places).all()
        assert m.count(token, n // 3, n) == (a[n // 3 :] == token).sum()
        assert (m.rank(token, at) == [(a[:i] == token).sum() for i in at]).all()
    with pytest.raises(IndexError):
        m.select(17, m.count(17))


def test_encoder_equals_library():
    own, library = wavelet.Encoder(open(FILE).read()), Tokenizer.from_file(FILE)
    r = random.Random(2)
    parts = [" ", "  ", "'", "s", "'re", "the", "é", "\n", "\t", "ü", "漢", "½", "<|endoftext|>", "1", "12", ".", "!?", "ß", " ", "_", "\x1c", "\r\n"]
    for _ in range(2000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(25)))
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_wide_ids():
    a = np.random.default_rng(1).integers(0, 1 << 20, 5000)
    m = wavelet.WaveletMatrix.of(a, 20)
    assert (m.unpack() == a).all() and (m.access([0, 4999]) == a[[0, 4999]]).all()


def test_plain_texts_are_encoded_by_pre_token(monkeypatch):
    """The library reads no plain text whole or cuts it again, gets a pre-token once, and what is remembered is bounded."""
    own, library = wavelet.Encoder(open(FILE).read()), Tokenizer.from_file(FILE)
    monkeypatch.setattr(wavelet, "REMEMBERED", 40)
    asked, tokenize = [], own.known.tokenize
    own.known.tokenize = lambda t: asked.append(t) or tokenize(t)
    texts = ["the end, the end of the\tthe naïve ſ " * 3, " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)), "long" * 500]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    own.library = None
    assert [x.tolist() for x in own.encode(texts[:1])] == want[:1] and len(asked) == len(set(asked)) > 5
    assert [x.tolist() for x in own.encode(texts)] == want
    assert len(own.known) <= 40 and max(map(len, own.known)) <= wavelet.LONGEST


def test_every_plain_letter_as_the_library():
    own, library = wavelet.Encoder(open(FILE).read()), Tokenizer.from_file(FILE)
    plain = [c for c in map(chr, range(0x110000)) if not wavelet._ODD.search(c)]
    assert len(plain) == len(own.known.letters) and max(plain) < "\u0180"
    text = "".join(a + b + " " + a for a in plain for b in plain)
    assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_files_round_trip(spark, prose, tmp_path, odd_documents):
    df = odd_documents.select("doc_id", "text").unionByName(
        spark.createDataFrame([(10 + i, prose(i * 3)) for i in range(60)], "doc_id bigint, text string")
    )
    folder = wavelet.write_tokens(df.repartition(3), FILE, f"file://{tmp_path}/t", shard_bytes=3000, roll_tokens=500)
    got = sorted(wavelet.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(FILE)
    want = {}
    for d in df.collect():
        want.setdefault(d.doc_id, []).append([*library.encode(d.text or "", add_special_tokens=False).ids, 2])
    assert [r.doc_id or -1 for r in got] == sorted(d.doc_id or -1 for d in df.collect())
    start = 0
    for r in got:
        assert r.ids in want[r.doc_id] and r.start == start and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    assert spark.read.parquet(f"{folder}/manifest").count() > 5
    empty = wavelet.write_tokens(df.limit(0), FILE, f"file://{tmp_path}/e")
    assert wavelet.read_tokens(spark, empty).count() == 0
