import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from tidewire.llm.sp_backtrack import MergeModel, encode_texts

FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    with open(FILE, "rb") as f:
        return MergeModel(f.read()), SentencePieceProcessor(model_file=FILE)


def test_equals_library_on_random_text(both):
    own, library = both
    r = random.Random(1)
    parts = [" ", "  ", "▁", "a", "the", "é", "\n", "\t", "ü", "漢", "🙂", "</s>", "1", "12", ".", "ing", "ion", "²", "².", "́", "un", "believ", "able", "'s", "—"]
    for _ in range(2000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(30)))
        assert own.encode(text).tolist() == library.encode(text, add_eos=True), text


def test_backtracks(both):
    own, library = both
    for text in ("aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", " " * 100, "x" * 20_000, "antidisestablishmentarianism" * 50):
        assert own.encode(text).tolist() == library.encode(text, add_eos=True)


def test_operator(both, odd_documents, no_documents):
    _, library = both
    for r, d in zip(encode_texts(odd_documents, FILE).collect(), odd_documents.collect(), strict=True):
        ids = library.encode(d.text or "", add_eos=True)
        assert (r.doc_id, r.ids, r.decoded) == (d.doc_id, ids, library.decode(ids))
    assert encode_texts(no_documents, FILE).count() == 0
