"""Lines that many documents share, found with two Bloom filters and confirmed exactly.

* Every task puts the line keys of its documents into two filters: keys it has seen once, and keys it has seen again in
  another document.  The filters of tasks are merged piece by piece: a bit that two tasks have set counts as seen again.
  A key of two documents is thus in the merged filter of twice-seen keys, whichever tasks met it; a few others are too.
* Only keys in that filter, the suspected repeats, are shuffled, as 128-bit digests, to count their documents and to find
  their first occurrence.  What a filter lets through wrongly fails this count, so it costs work and never a line.
* Lines are dropped in a last scan against the confirmed keys.  Workers hold these if they are few; if not, they are joined
  with the documents.

The filters lie in the shared folder and never pass through the driver.  Their size follows the number of lines up to
``MAX_BITS``, since each worker holds the filter of twice-seen keys; beyond it more keys are suspected and the result is the same.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm._common import Scratch
from tidewire.llm._order import store_of
from tidewire.llm._words import U64

#: What is stripped at the ends of a line.
SPACE = b" \t\n\x0b\x0c\r"
#: Bits of a filter for each line, at most, and of the pieces in which filters are merged.
BITS_PER_LINE, MAX_BITS, PIECE_BITS = 16, 1 << 30, 1 << 19
#: So many confirmed keys at most are held by a worker; more are joined.
HELD = 1 << 18


def line_key(line: bytes) -> bytes:
    """The form in which lines are compared: white space at both ends gone, A-Z in lower case."""
    return line.strip(SPACE).lower()


def _digests(text: bytes | None, min_chars: int) -> list[bytes | None]:
    """For each line the digest of its key; None if the key has fewer than ``min_chars`` code points."""
    out = []
    for line in (text or b"").split(b"\n"):
        key = line_key(line)
        long_enough = len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars)
        out.append(hashlib.blake2b(key, digest_size=16).digest() if key and long_enough else None)
    return out


class Filters:
    """Bloom filters of the keys seen once and seen again, each with two bits a key."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once, self.twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def add(self, digests: list[bytes]) -> None:
        """Keys of some documents, each key once for each of its documents."""
        numbers, times = np.unique(_numbers(digests), return_counts=True)
        again = numbers[(times > 1) | has(self.once, numbers)]
        for held, of in ((self.once, numbers), (self.twice, again)):
            for place in _places(of, self.bits):
                np.bitwise_or.at(held, place >> U64(3), (U64(1) << (place & U64(7))).astype(np.uint8))

    def pieces(self):
        """(number, once, twice) of the pieces that are not empty, compressed."""
        step = PIECE_BITS // 8
        for at in range(0, len(self.once), step):
            once = self.once[at : at + step]
            if once.any():
                yield at // step, _packed(once), _packed(self.twice[at : at + step])


def _numbers(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), U64)[::2]


def _places(numbers: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return numbers & U64(bits - 1), numbers >> U64(32) & U64(bits - 1)


def has(held: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which of the keys the filter may hold; never False for one that it does."""
    found = np.ones(len(numbers), bool)
    for place in _places(numbers, len(held) * 8):
        found &= (held[place >> U64(3)] >> (place & U64(7)).astype(np.uint8) & 1).astype(bool)
    return found


def _packed(piece: np.ndarray) -> bytes:
    return pa.compress(piece.tobytes(), codec="zstd", asbytes=True)


def _unpacked(piece: bytes, bits: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(piece, bits // 8, codec="zstd", asbytes=True), np.uint8)


def _fill(bits: int, min_chars: int):
    """Texts to the pieces of their task's filters."""

    def run(batches):
        filters = Filters(bits)
        for batch in batches:
            held = []
            for text in _values(batch.column(0)):
                held += set(_digests(text, min_chars)) - {None}
                if len(held) > 1 << 18:
                    filters.add(held)
                    held = []
            if held:
                filters.add(held)
        rows = list(filters.pieces())
        for first in range(0, len(rows), 64):
            columns = zip(*rows[first : first + 64], strict=True)
            kinds = (pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["piece", "once", "twice"])

    return run


def _merge(bits: int):
    """Pieces of all tasks to the merged pieces of twice-seen keys."""

    def run(batches):
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, *both in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = (_unpacked(x, bits) for x in both)
                if number in once:
                    twice[number] |= b | once[number] & a
                    once[number] |= a
                else:
                    once[number], twice[number] = a.copy(), b.copy()
        for number, piece in twice.items():
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([_packed(piece)], pa.binary())], ["piece", "twice"])

    return run


def _values(column: pa.Array):
    for first in range(0, len(column), 250):
        yield from column.slice(first, 250).to_pylist()


def _files(folder: str) -> list[tuple[pafs.FileSystem, str]]:
    store, path = store_of(folder)
    found = store.get_file_info(pafs.FileSelector(path))
    return sorted(((store, f.path) for f in found if f.base_name.startswith("part-")), key=lambda f: f[1])


@lru_cache(maxsize=1)
def _twice(folder: str, bits: int) -> np.ndarray:
    """The filter of twice-seen keys in a saved table, held by a worker."""
    held, step = np.zeros(bits // 8, np.uint8), min(bits, PIECE_BITS) // 8
    for store, path in _files(folder):
        with store.open_input_file(path) as stream:
            for batch in pq.ParquetFile(stream).iter_batches(64):
                for number, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    held[number * step : (number + 1) * step] = _unpacked(piece, step * 8)
    return held


@lru_cache(maxsize=1)
def _confirmed(folder: str) -> dict[bytes, tuple]:
    """The confirmed keys of a saved table with the line of the first occurrence and its document, held by a worker."""
    found: dict = {}
    for store, path in _files(folder):
        with store.open_input_file(path) as stream:
            table = pq.ParquetFile(stream).read()
            found.update(zip(table["digest"].to_pylist(), zip(table["first_line"].to_pylist(), table["first_id"].to_pylist(), strict=True), strict=True))
    return found


def _suspects(folder: str, bits: int, min_chars: int, id_type: pa.DataType):
    """Each suspected key of each text once: digest, id, its first line there."""

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                digests, ids, lines = [], [], []
                for key, text in zip(part.column(0).to_pylist(), _values(part.column(1)), strict=True):
                    at: dict[bytes, int] = {}
                    for i, d in enumerate(_digests(text, min_chars)):
                        if d:
                            at.setdefault(d, i)
                    digests += at
                    lines += at.values()
                    ids += [key] * len(at)
                if digests:
                    maybe = pa.array(has(_twice(folder, bits), _numbers(digests)))
                    columns = pa.array(digests, pa.binary()), pa.array(ids, id_type), pa.array(lines, pa.int64())
                    yield pa.RecordBatch.from_arrays([c.filter(maybe) for c in columns], ["digest", "id", "line"])

    return run


def _kept(text: bytes | None, key, known: dict, min_chars: int, keep_first: bool) -> tuple[bytes, int, int]:
    """The text without its lines of known keys, and how many lines it had and lost."""
    lines = (text or b"").split(b"\n")
    out = []
    for i, (line, d) in enumerate(zip(lines, _digests(text, min_chars), strict=True)):
        first = known.get(d) if d else None
        if first is None or (keep_first and first == (i, key)):
            out.append(line)
    return b"\n".join(out), len(lines), len(lines) - len(out)


def _drop(min_chars: int, keep_first: bool, folder: str | None = None):
    """(id, text) or, without a folder of confirmed keys, (id, text, their keys) to (id, text, n_lines, n_dropped)."""

    def run(batches):
        for batch in batches:
            id_type = batch.schema.field(0).type
            for first in range(0, batch.num_rows, 250):
                columns = [c.to_pylist() for c in batch.slice(first, 250).columns]
                rows = []
                for key, text, *own in zip(*columns, strict=True):
                    known = _confirmed(folder) if folder else {k["digest"]: (k["first_line"], k["first_id"]) for k in own[0] or []}
                    rows.append(_kept(text, key, known, min_chars, keep_first))
                texts, n_lines, n_dropped = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], id_type), pa.array(texts, pa.binary()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                    ["id", "text", "n_lines", "n_dropped"],
                )

    return run


def drop_repeated_lines(
    docs: DataFrame, min_docs: int = 10, keep: str = "none", min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text",
    bits: int | None = None, held: int = HELD,
) -> DataFrame:
    """One row per row of ``docs``: id, text without repeated lines, n_lines (before), n_dropped.

    A text is cut at line feeds; a null or empty one is one empty line.  Lines are equal if their keys are (``line_key``).  Keys of
    ``min_chars`` code points or more (never the empty key) in at least ``min_docs`` rows of ``docs`` lose all their lines
    (``keep="none"``) or all but the first, in order of id and line (``keep="first"``; a null id comes first, and rows of the same id that
    hold the first at the same line each keep it).  A line that is repeated within one row only is not repeated.  Rows are
    documents of their own even if their ids are equal or null.  Further columns are not read; an empty table gives no rows.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep: none or first, not {keep}")
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    id_type = docs.schema[id_col].dataType
    column = lambda c: F.col(f"`{c}`")
    texts = docs.select(column(id_col).alias("id"), column(text_col).cast("binary").alias("text"))
    if bits is None:
        line_feeds = F.octet_length("text") - F.octet_length(F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit("")))
        lines = texts.agg(F.sum(F.coalesce(line_feeds, F.lit(0)) + 1)).first()[0] or 0
        bits = min(max(1 << (BITS_PER_LINE * lines).bit_length(), PIECE_BITS), MAX_BITS)
    piece_bits = min(bits, PIECE_BITS)
    pieces = texts.select("text").mapInArrow(_fill(bits, min_chars), "piece int, once binary, twice binary")
    merged = pieces.repartition("piece").mapInArrow(_merge(piece_bits), "piece int, twice binary")
    scratch.save(merged, "twice", few=True)
    kinds = f"digest binary, id {id_type.simpleString()}, line bigint"
    found = texts.mapInArrow(_suspects(f"{scratch.path}/twice", bits, min_chars, _arrow(id_type)), kinds)
    counted = found.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("id", "line")).alias("first"))
    confirmed = scratch.save(
        counted.where(F.col("n") >= min_docs).select("digest", F.col("first.line").alias("first_line"), F.col("first.id").alias("first_id")),
        "confirmed", few=True,
    )
    out = f"id {id_type.simpleString()}, text binary, n_lines bigint, n_dropped bigint"
    keep_first = keep == "first"
    if confirmed.count() <= held:
        kept = texts.mapInArrow(_drop(min_chars, keep_first, f"{scratch.path}/confirmed"), out)
    else:
        kept = _joined(scratch, texts, confirmed, bits, min_chars).mapInArrow(_drop(min_chars, keep_first), out)
    return kept.select(F.col("id").alias(id_col), F.col("text").cast("string").alias(text_col), "n_lines", "n_dropped")


def _joined(scratch: Scratch, texts: DataFrame, confirmed: DataFrame, bits: int, min_chars: int) -> DataFrame:
    """(id, text, confirmed keys of the text) for keys that are too many for a worker."""
    rows = scratch.save(texts.withColumn("uid", F.monotonically_increasing_id()), "rows", "zstd")  # numbered once, in the saved table
    folder = f"{scratch.path}/twice"
    found = rows.select("uid", "text").mapInArrow(_suspects(folder, bits, min_chars, pa.int64()), "digest binary, id bigint, line bigint")
    keys = found.select("digest", F.col("id").alias("uid")).join(confirmed, "digest")
    listed = keys.groupBy("uid").agg(F.collect_list(F.struct("digest", "first_line", "first_id")).alias("keys"))
    return rows.join(listed, "uid", "left").select("id", "text", "keys")


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
