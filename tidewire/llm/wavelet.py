"""Token-ID output as one wavelet matrix per file.

Documents are tokenised in order of (id, SHA-1 of the text), in deterministic
shards; each shard is a series of files that hold up to ``roll_tokens`` ids (a
longer document has a file of its own).  A file has the ids as a wavelet matrix:
one bit-plane for each bit of an id, highest first, where each plane sorts the
sequence stably by its bit before the next is taken.  With a count of ones before
every 512 bits this answers, without unpacking the sequence:

* ``access``: the ids at any positions,
* ``rank``: how often an id occurs before a position, and so in any range,
* ``select``: where an id occurs for the k-th time, and so all its places.

Planes are compressed; the table of documents lies beside them.  Files get their
names when complete, and Spark commits the manifest, as in the WARC writer.
"""

from __future__ import annotations

import hashlib
import json
import os
import posixpath
import re
import struct
import uuid
import zlib
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm._common import Scratch, shared_root, text_or_empty
from tidewire.llm._order import RollingFiles, shards, store_of
from tidewire.llm._words import portions

MAGIC = b"TWWM0001"
BLOCK = 512
SHARD_BYTES, ROLL_TOKENS = 8 << 20, 8 << 20
#: So many pre-tokens, of at most so many characters, are remembered in each worker.
REMEMBERED, LONGEST = 1_200_000, 256
_MANIFEST = "shard int, seq int, file string, bytes bigint, sha256 string, n_docs bigint, n_tokens bigint"


class WaveletMatrix:
    """A sequence of integers below 2^planes with rank and select."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        #: planes: 64-bit words, lowest bit first, highest plane first.
        self.n, self.planes, self.zeros = n, planes, zeros
        ones = [np.bitwise_count(p).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32) for p in planes]
        self.ones_before = [np.concatenate([[0], np.cumsum(o)]).astype(np.int64) for o in ones]

    @classmethod
    def of(cls, ids: np.ndarray, n_planes: int) -> WaveletMatrix:
        a = ids.astype(np.uint16 if n_planes <= 16 else np.uint32)
        planes, zeros = [], []
        for b in range(n_planes - 1, -1, -1):
            packed = np.zeros(-(-max(len(a), 1) // BLOCK) * BLOCK // 8, np.uint8)
            bits = np.packbits(a & a.dtype.type(1 << b) != 0, bitorder="little")
            packed[: len(bits)] = bits
            # Arrow filters by packed bits in half the time that NumPy needs by a mask
            held = pa.array(a)
            low, high = (pc.filter(held, _bits(x, len(a))).to_numpy() for x in (~packed, packed))
            a = np.concatenate([low, high])
            planes.append(packed.view(np.uint64))
            zeros.append(len(low))
        return cls(len(ids), planes, zeros)

    def _ones(self, plane: int, i: np.ndarray) -> np.ndarray:
        """Ones of a plane before the positions i."""
        words, block = self.planes[plane], i // BLOCK
        out = self.ones_before[plane][block]
        inside = i - block * BLOCK
        for w in range(BLOCK // 64):
            bits = np.clip(inside - 64 * w, 0, 64)
            if not bits.any():
                break
            word = words[np.minimum(block * (BLOCK // 64) + w, len(words) - 1)]
            mask = np.where(bits == 64, ~np.uint64(0), (np.uint64(1) << (bits % 64).astype(np.uint64)) - np.uint64(1))
            out = out + np.bitwise_count(word & mask)
        return out

    def access(self, positions) -> np.ndarray:
        """The ids at the positions."""
        i = np.atleast_1d(np.asarray(positions, np.int64))
        out = np.zeros(len(i), np.int64)
        for p, words in enumerate(self.planes):
            bit = (words[i // 64] >> (i % 64).astype(np.uint64)) & np.uint64(1) != 0
            ones = self._ones(p, i)
            i = np.where(bit, self.zeros[p] + ones, i - ones)
            out = out << 1 | bit
        return out

    def _bucket(self, token: int, positions: np.ndarray) -> tuple[np.ndarray, int]:
        """Where the positions come to lie in the last order, among the token's; and where those start."""
        i = np.concatenate([[0], np.atleast_1d(positions)]).astype(np.int64)
        for p in range(len(self.planes)):
            ones = self._ones(p, i)
            i = self.zeros[p] + ones if token >> (len(self.planes) - 1 - p) & 1 else i - ones
        return i[1:], int(i[0])

    def rank(self, token: int, positions) -> np.ndarray:
        """How often the token occurs before each position."""
        if token >> len(self.planes):
            return np.zeros(len(np.atleast_1d(positions)), np.int64)
        at, start = self._bucket(token, np.asarray(positions, np.int64))
        return at - start

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        a, b = self.rank(token, [start, self.n if end is None else end])
        return int(b - a)

    def select(self, token: int, ks) -> np.ndarray:
        """The positions of the k-th occurrences (from 0) of the token."""
        ks = np.atleast_1d(np.asarray(ks, np.int64))
        if ((ks < 0) | (ks >= self.count(token))).any():
            raise IndexError("the token does not occur so often")
        _, start = self._bucket(token, np.zeros(0, np.int64))
        i = start + ks
        for p in range(len(self.planes) - 1, -1, -1):
            one = token >> (len(self.planes) - 1 - p) & 1
            target = i - self.zeros[p] if one else i
            lo, hi = np.zeros(len(i), np.int64), np.full(len(i), self.n, np.int64)
            while (lo < hi).any():  # the least position before whose end there are target + 1 such bits
                mid = (lo + hi) // 2
                ones = self._ones(p, mid + 1)
                enough = (ones if one else mid + 1 - ones) > target
                open_ = lo < hi
                hi = np.where(open_ & enough, mid, hi)
                lo = np.where(open_ & ~enough, mid + 1, lo)
            i = lo
        return i

    def occurrences(self, token: int) -> np.ndarray:
        return self.select(token, np.arange(self.count(token)))

    def unpack(self) -> np.ndarray:
        """The whole sequence, from the last plane to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        a = np.zeros(self.n, kind)
        for p in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[p].view(np.uint8), count=self.n, bitorder="little").view(bool)
            out = np.empty_like(a)
            out[~bit] = a[: self.zeros[p]]
            out[bit] = a[self.zeros[p] :] | kind(1 << (len(self.planes) - 1 - p))
            a = out
        return a


def _bits(packed: np.ndarray, n: int) -> pa.BooleanArray:
    return pa.Array.from_buffers(pa.bool_(), n, [None, pa.py_buffer(packed)])


class TokenFile:
    """The documents and ids of one file."""

    def __init__(self, doc_ids: pa.Array, starts: np.ndarray, matrix: WaveletMatrix):
        #: starts has one entry more than there are documents.
        self.doc_ids, self.starts, self.matrix = doc_ids, starts, matrix

    def to_bytes(self) -> bytes:
        pack = zstandard.ZstdCompressor(level=1).compress
        known = np.array(self.doc_ids.is_valid())
        ids = np.array(self.doc_ids.fill_null(0), np.int64)
        parts = [pack(x.tobytes()) for x in (ids, known, self.starts.astype(np.int64), *self.matrix.planes)]
        head = json.dumps(
            {"n": self.matrix.n, "docs": len(ids), "zeros": self.matrix.zeros, "parts": [len(p) for p in parts]}
        ).encode()
        return b"".join([MAGIC, struct.pack("<I", len(head)), head, *parts])

    @classmethod
    def from_bytes(cls, data: bytes) -> TokenFile:
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        (size,) = struct.unpack_from("<I", data, 8)
        head = json.loads(data[12 : 12 + size])
        at, parts = 12 + size, []
        for n in head["parts"]:
            parts.append(zstandard.ZstdDecompressor().decompress(data[at : at + n]))
            at += n
        known = np.frombuffer(parts[1], bool)
        ids = pa.array(np.frombuffer(parts[0], np.int64), mask=~known)
        planes = [np.frombuffer(p, np.uint64) for p in parts[3:]]
        return cls(ids, np.frombuffer(parts[2], np.int64), WaveletMatrix(head["n"], planes, head["zeros"]))


#: Letters of texts for which Python's and the library's classes of characters are known to agree.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
_ODD = re.compile(rf"[^{_LETTERS}\t\n\r\x20-\x7e]")
_PRE_TOKEN = re.compile(
    rf" ?[{_LETTERS}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"
)


class _Known(dict):
    """The ids of pre-tokens as bytes; the library's model encodes one when it is first asked for."""

    def __init__(self, library):
        from tokenizers.pre_tokenizers import ByteLevel

        cut = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        plain = (c for c in map(chr, range(0x180)) if not _ODD.search(c))
        #: What the library makes of the bytes of each letter.
        self.letters = {ord(c): "".join(piece for piece, _ in cut(c)) for c in plain}
        self.tokenize = library.model.tokenize

    def __missing__(self, pre_token: str) -> bytes:
        ids = array("I", [t.id for t in self.tokenize(pre_token.translate(self.letters))]).tobytes()
        if len(pre_token) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[pre_token] = ids
        return ids


class Encoder:
    """Whole-text encoding with the tokenizers library.

    A byte-level tokenizer first cuts a text into pre-tokens and encodes each by
    itself, so the library's model is given the pre-tokens that this worker has not met
    before, and its answers are remembered.  Texts with characters outside ASCII
    and the Latin letters, or with a special token, are given to the library whole; so are all
    texts if the tokenizer is of another kind.
    """

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the threads here
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        told = json.loads(definition)
        pre = told.get("pre_tokenizer") or {}
        self.by_pre_token = (
            pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and not told.get("normalizer") and not told.get("truncation") and not told.get("padding")
        )
        self.special = [t["content"] for t in told.get("added_tokens", ())]
        self.n_planes = max(self.library.get_vocab_size(with_added_tokens=True) - 1, 1).bit_length()
        self.known = _Known(self.library)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self._ids(t), np.uint32) for t in texts]

    def _ids(self, text: str) -> bytes:
        if self.by_pre_token and not _ODD.search(text) and not any(s in text for s in self.special):
            return b"".join(map(self.known.__getitem__, _PRE_TOKEN.findall(text)))
        (whole,) = self.library.encode_batch_fast([text], add_special_tokens=False)
        return array("I", whole.ids).tobytes()


@cache
def _encoder(definition: str) -> Encoder:
    return Encoder(definition)


def write_tokens(
    docs: DataFrame,
    tokenizer_file: str,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 2,
    shard_bytes: int = SHARD_BYTES,
    roll_tokens: int = ROLL_TOKENS,
) -> str:
    """Write the ids of all texts, each with ``end_id`` after it; returns the folder.

    A null text is the empty one; a null id sorts first; repeated rows are each
    written.  An empty table makes an empty manifest.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    folder = folder or f"{shared_root(spark)}/token-files-{uuid.uuid4().hex}"
    with open(tokenizer_file, encoding="utf-8") as f:
        held = spark.sparkContext.broadcast(f.read())
    base = docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text")).withColumn(
        "sha", F.sha1(F.col("text").cast("binary"))
    )
    light = scratch.save(base.select("id", "sha", F.octet_length("text").cast("bigint").alias("n")), "light")
    deal, n_shards = shards(light, shard_bytes, 16)
    dealt = (
        deal(base)
        .repartitionById(n_shards, "shard")
        .sortWithinPartitions("shard", "id", "sha")
        .select("shard", "id", "text")
    )
    data = f"{folder}/data"
    end = np.array([] if end_id is None else [end_id], np.uint32)

    def write(batches):
        encoder = _encoder(held.value)
        files, doc_ids, ids, total = None, [], [], 0

        def finish():
            nonlocal doc_ids, ids, total
            flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
            planes = max(encoder.n_planes, int(flat.max(initial=0)).bit_length())
            starts = np.cumsum([0, *map(len, ids)])
            file = TokenFile(pa.array(doc_ids, pa.int64()), starts, WaveletMatrix.of(flat, planes))
            files.put(file.to_bytes())
            row = files.close() | {"n_docs": len(doc_ids), "n_tokens": total}
            doc_ids, ids, total = [], [], 0
            return pa.RecordBatch.from_pylist([row], _manifest_schema())

        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for part in portions(rows, lambda r: len(r[2]) + 64, 3_000_000):
                for (s, doc_id, _), x in zip(part, encoder.encode([r[2] for r in part]), strict=True):
                    x = np.concatenate([x, end])
                    if doc_ids and (s != files.shard or total + len(x) > roll_tokens):
                        yield finish()
                    if files is None or s != files.shard:
                        files = RollingFiles(data, s, ".wm")
                    doc_ids.append(doc_id)
                    ids.append(x)
                    total += len(x)
        if doc_ids:
            yield finish()

    dealt.mapInArrow(write, _MANIFEST).write.option("compression", "uncompressed").parquet(f"{folder}/manifest")
    return folder


def _manifest_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in map(str.split, _MANIFEST.split(", "))])


def manifest_of(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with ``first``: the ids in all files before.

    Files are summed up within their shards; only the sums of shards, whose number is
    bounded, are added up in one place.
    """
    files = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sums = files.groupBy("shard").agg(F.sum("n_tokens").alias("shard_tokens"))
    sums = sums.select("shard", F.coalesce(F.sum("shard_tokens").over(before), F.lit(0)).alias("shard_first"))
    within = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return placed.join(sums, "shard").withColumn("first", F.col("shard_first") + F.col("within")).drop("shard_first", "within")


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True, id_name: str = "doc_id") -> DataFrame:
    """A row per document: id, start (ids of all documents before it), n_tokens, ids_crc32 and, if wanted, ids.

    The CRC is that of the ids as little-endian 32-bit integers.
    """
    manifest = manifest_of(spark, folder).select("file", "bytes", "sha256", "first")
    n_files = max(spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").count(), 1)
    data = f"{folder}/data"
    names = [id_name, "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = f"`{id_name}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")

    def read(batches):
        store, path = store_of(data)
        for batch in batches:
            for f in batch.to_pylist():
                with store.open_input_stream(posixpath.join(path, f["file"]), compression=None) as stream:
                    raw = stream.read()
                if (len(raw), hashlib.sha256(raw).hexdigest()) != (f["bytes"], f["sha256"]):
                    raise ValueError(f"{f['file']} is not the file that the manifest names")
                file = TokenFile.from_bytes(raw)
                ids = file.matrix.unpack().astype("<u4")
                starts = file.starts
                for first in range(0, len(file.doc_ids), 1000):
                    s = starts[first : first + 1001]
                    crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(s, s[1:], strict=False)]
                    columns = [
                        file.doc_ids.slice(first, 1000), pa.array(f["first"] + s[:-1]), pa.array(np.diff(s)),
                        pa.array(crcs, pa.int64()),
                    ]
                    if with_ids:
                        flat = pa.array(ids[s[0] : s[-1]].astype(np.int64))
                        columns.append(pa.ListArray.from_arrays(pa.array((s - s[0]).astype(np.int32)), flat))
                    yield pa.RecordBatch.from_arrays(columns, names)

    return manifest.repartition(n_files).mapInArrow(read, schema)
