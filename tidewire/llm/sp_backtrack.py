"""Exact merge-type SentencePiece encoding by backtracking, and decoding.

A merge-type model defines an encoding by a long series of merges over a text.
The same encoding can be found from left to right: a sequence of tokens is the
encoding exactly if each token merges to itself and every two adjacent tokens,
merged anew from their characters, come out as these two.  At each position an
Aho-Corasick automaton gives the longest token; if it does not fit the token
before, its prefixes are tried, then the token before is given up, and a field
of failed positions keeps any position from being tried twice.

No token spans the step from a word to the spaces that follow it, nor (but for
pairs of characters read off the model) that from letters to other characters,
so a text is encoded chunk by chunk, and each task remembers the chunks it has
met (a bounded number).  Texts are encoded whole, whatever their length; nothing is shuffled.

Unknown characters never merge; each becomes the byte tokens of its UTF-8 form,
or the unknown token if the model has no byte tokens.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
#: So many chunks and pairs are remembered in each task; longer chunks are not.
REMEMBERED, LONGEST_REMEMBERED = 250_000, 32
_NORMAL, _UNKNOWN, _BYTE = 1, 2, 6


class _Chunks(dict):
    """chunk -> its ids as the bytes of 32-bit integers; forgets all when full."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, text: str) -> bytes:
        out = np.array(self.encode(text), np.int32).tobytes()
        if len(text) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[text] = out
        return out


class MergeModel:
    """A merge-type model without a normaliser, read from its file's bytes."""

    def __init__(self, proto: bytes):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        model = ModelProto.FromString(proto)
        if (
            model.trainer_spec.model_type != 2
            or model.normalizer_spec.precompiled_charsmap
            or model.normalizer_spec.remove_extra_whitespaces
            or not model.normalizer_spec.escape_whitespaces
            or model.trainer_spec.treat_whitespace_as_suffix
            or any(p.type in (4, 5) for p in model.pieces)
        ):
            raise ValueError("only merge-type models without normaliser and user-defined pieces are supported")
        self.library = SentencePieceProcessor(model_proto=proto)
        self.prefix = SPACE if model.normalizer_spec.add_dummy_prefix else ""
        self.end_id = self.library.eos_id()
        self.piece = [p.piece for p in model.pieces]
        self.length = [len(p) for p in self.piece]
        self.score = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id_of):
            raise ValueError("a piece spans the end of a word")
        if not {c for p in self.id_of for c in p} <= self.id_of.keys():
            raise ValueError("a piece has a character that is no piece")
        by_byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.bytes = [by_byte[b] for b in range(256)] if len(by_byte) == 256 else None
        self.unknown = self.library.unk_id()
        self.known_char = {p for p in self.id_of if len(p) == 1}
        self.matcher = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            self.matcher.add_word(p, i)
        self.matcher.make_automaton()
        #: The longest token that is a proper prefix of a token, or -1.
        self.shorter = [-1] * len(self.piece)
        for p, i in self.id_of.items():
            self.shorter[i] = next((self.id_of[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.id_of), -1)
        #: Chunks that no piece spans: words with the spaces before them, and where no odd pair
        #: of characters is met, also runs of letters, digits and other characters for themselves.
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.runs = re.compile(rf"{SPACE}*(?:[^\W\d_]+|[\d_]+|[^\w{SPACE}]+)|{SPACE}+")
        cut = [p for p in self.id_of if not self.runs.fullmatch(p)]
        self.odd_pairs = {p[i : i + 2] for p in cut for i in range(len(p) - 1) if not self.runs.fullmatch(p[i : i + 2])}
        self.remembered = _Chunks(self.chunk)
        self.pairs: dict[int, bool] = {}

    def merge(self, text: str) -> list[str]:
        """The encoding by merging: the best-scored adjacent pair first, of equals the leftmost."""
        parts, score = list(text), self.score
        none = float("-inf")
        scores = [score.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) > none:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score.get(parts[i - 1] + parts[i], none)
            if i < len(scores):
                scores[i] = score.get(parts[i] + parts[i + 1], none)
        return parts

    def fits(self, last: int, token: int) -> bool:
        """Whether token may follow last (-1: whether it may stand at all)."""
        a, b = "" if last < 0 else self.piece[last], self.piece[token]
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        ok = self.pairs[last << 32 | token] = self.merge(a + b) == ([a, b] if a else [b])
        return ok

    def backtrack(self, text: str) -> list[int]:
        """The tokens of a text of known characters."""
        n = len(text)
        longest = [0] * n
        length, shorter = self.length, self.shorter
        for end, token in self.matcher.iter(text):  # for one start, later matches are longer
            longest[end - length[token] + 1] = token
        failed = bytearray(n + 1)
        known, fits = self.pairs.get, self.fits
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while True:
            while token >= 0:
                end = at + length[token]
                if not failed[end]:
                    ok = known(last << 32 | token)
                    if fits(last, token) if ok is None else ok:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                if end == n:
                    return out
                at, last, token = end, token, longest[end]
            else:
                failed[at] = 1
                token = out.pop()
                at -= length[token]
                last = out[-1] if out else -1

    def chunk(self, text: str) -> list[int]:
        if self.known_char.issuperset(text):
            out = self.backtrack(text)
        else:
            out, run = [], ""
            for c in [*text, ""]:
                if c in self.known_char:
                    run += c
                    continue
                if run:
                    out += self.backtrack(run)
                    run = ""
                if c:
                    out += [self.bytes[b] for b in c.encode()] if self.bytes else [self.unknown]
        return out

    def encode(self, text: str, end: bool = True) -> np.ndarray:
        out = b""
        if text:
            text = (self.prefix + text).replace(" ", SPACE)
            cut = self.words if any(p in text for p in self.odd_pairs) else self.runs
            chunks = cut.findall(text)
            out = b"".join(map(self.remembered.__getitem__, chunks))
        if end:
            out += self.end_id.to_bytes(4, "little")
        return np.frombuffer(out, "<i4")

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


@cache
def _model(proto: bytes) -> MergeModel:
    return MergeModel(proto)


def encode_texts(
    docs: DataFrame,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end: bool = True,
    decode: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: id, ids (array of int), decoded (the text decoded from the ids).

    A null text is the empty text, whose ids are the end id alone.  The model file
    is read where the job is started; a model of some 100 kB travels with the tasks.
    """
    with open(model_file, "rb") as f:
        proto = f.read()
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([*fields, T.StructField("decoded", T.StringType())] if decode else fields)
    held = docs.sparkSession.sparkContext.broadcast(proto)
    names = schema.names

    def run(batches):
        model = _model(held.value)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                ids = [model.encode(t or "", end) for t in part.column(1).to_pylist()]
                flat = np.concatenate(ids)
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                columns = [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
                if decode:
                    columns.append(pa.array([model.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
