"""Repeated long substrings by bucket-pointer refinement over sampled suffixes.

Every byte is marked that lies in a string of ``length`` bytes which starts anywhere
else too, in the same document or another.  The suffixes that could say so are sorted
into buckets, and the buckets are refined until what shares a bucket shares ``length`` bytes:

* Each window of ``length`` bytes points to an anchor, the 64-byte gram of the least hash in
  it.  Equal windows point to equal anchors at equal distances d, and windows that follow
  one another mostly share an anchor, so one row stands for a range of them.
* Windows with d in a fixed interval all contain one string around the anchor, the core of the
  interval.  Rows are put into buckets by their core (the initial q-grams, 129 bytes); a
  bucket with one row holds no repeat and is dropped.  This screens nearly all of a corpus.
* The string that spans all windows of a row is its hull.  If a hull occurs twice, all windows
  of these rows are repeated at once; one row stands for them from then on.
* What is left is split into shorter intervals of d, whose cores are longer, and refined
  again (193 bytes, then 200).  Decisions on a bucket are reused by all that follows: a
  settled hull is carried on once, as a string known to be repeated, and only as long as its
  bucket holds undecided rows.

Rows are numbered in a table that is saved first, so all steps agree on them however often executors come and go.  Texts are
scanned twice for the first buckets and shuffled once, to get the texts of
documents with undecided rows together with those rows; everything else moves hashes.  Hashes of
hulls have 128 bits.  Counts are pre-aggregated, and joins are left to adaptive
execution to split, so a passage that a third of all documents share stays spread out.

Documents with an exact copy need no refinement: all of them is repeated.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm._common import Scratch, text_or_empty
from tidewire.llm._words import U64, mixed

LENGTH, GRAM = 200, 64
#: Widths of the intervals of d at the successive levels; each divides the one before.
WIDTHS = (72, 8, 1)
#: Long texts are worked on in pieces of so many bytes.
PIECE = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@cache
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.full(size, _BASES[which], U64))
    down = np.cumprod(np.full(size, pow(_BASES[which], -1, 1 << 64), U64))
    return up, down


class _Hashes:
    """Hashes of the substrings of some bytes."""

    def __init__(self, data: np.ndarray, which: int = 0):
        size = 1 << max(16, len(data).bit_length())
        up, self.down = _powers(which, size)
        self.total = np.zeros(len(data) + 1, U64)
        np.cumsum(data * up[: len(data)], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.total[end] - self.total[start]) * self.down[start])


def _sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of the least, the first of equals."""
    n = len(h)
    v = (h & ~U64((1 << 24) - 1)) | np.arange(n, dtype=U64)
    padded = np.full(-(-n // width) * width, ~U64(0))
    padded[:n] = v
    rows = padded.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[: n - width + 1], before[width - 1 : n])
    return (least & U64((1 << 24) - 1)).astype(np.int64)


def anchor_runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of windows with one anchor: (text number, anchor, first start, last start), and the hashes of ``data``.

    ``data`` holds texts one after another, which end at ``ends``; no window spans two.
    """
    hashes = _Hashes(data)
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, hashes
    grams = np.arange(len(data) - GRAM + 1)
    anchor = _sliding_argmin(hashes.of(grams, grams + GRAM), LENGTH - GRAM + 1)
    starts = np.append(0, ends[:-1])
    text = np.repeat(np.arange(len(ends)), ends - starts)[: len(anchor)]
    valid = np.arange(len(anchor)) + LENGTH <= ends[text]
    p = np.flatnonzero(valid)
    if not len(p):
        return none, none, none, none, hashes
    new = np.ones(len(p), bool)
    new[1:] = (anchor[p[1:]] != anchor[p[:-1]]) | (text[p[1:]] != text[p[:-1]])
    first = p[new]
    last = np.append(p[np.flatnonzero(new)[1:] - 1], p[-1])
    return text[first], anchor[first], first, last, hashes


def _intervals(near: np.ndarray, far: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cuts ranges of d at multiples of ``width``: (row, interval, near, far)."""
    lo, hi = near // width, far // width
    count = hi - lo + 1
    row = np.repeat(np.arange(len(near)), count)
    interval = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + lo[row]
    return row, interval, np.maximum(near[row], interval * width), np.minimum(far[row], interval * width + width - 1)


def _cores(hashes: _Hashes, anchor: np.ndarray, interval: np.ndarray, width: int) -> np.ndarray:
    """The string that all windows with d in the interval contain."""
    nearest = interval * width
    farthest = np.minimum(nearest + width - 1, LENGTH - GRAM)
    core = hashes.of(anchor - nearest, anchor - farthest + LENGTH)
    return mixed(core + (interval + 1).astype(U64) * U64(0xD6E8FEB86659FD93))


def _screen(batches):
    """uid, core, anchor, near, far of the first intervals of all windows; each for itself."""
    width = WIDTHS[0]
    for batch in batches:
        pieces: list[tuple[int, int, bytes]] = []
        held = 0
        uids = batch.column(0).to_pylist()
        for uid, text in zip(uids, batch.column(1).to_pylist(), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            for at in range(0, max(len(data) - LENGTH + 1, 0), PIECE):
                pieces.append((uid, at, data[at : at + PIECE + LENGTH - 1]))
                held += len(pieces[-1][2])
                if held >= PIECE:
                    yield _screened(pieces, width)
                    pieces, held = [], 0
        if pieces:
            yield _screened(pieces, width)


def _screened(pieces: list[tuple[int, int, bytes]], width: int) -> pa.RecordBatch:
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    ends = np.cumsum([len(p[2]) for p in pieces])
    text, anchor, first, last, hashes = anchor_runs(data, ends)
    row, interval, near, far = _intervals(anchor - last, anchor - first, width)
    core = _cores(hashes, anchor[row], interval, width)
    uid = np.array([p[0] for p in pieces], np.int64)[text[row]]
    # where the piece lies in its document, against where it lies in data
    shift = np.array([p[1] for p in pieces], np.int64) - np.append(0, ends[:-1])
    place = (anchor[row] + shift[text[row]]) << 16 | near << 8 | far
    return pa.RecordBatch.from_arrays([pa.array(uid), pa.array(core.view(np.int64)), pa.array(place)], ["uid", "core", "place"])


def _refine(width: int):
    """From documents with their rows, the parts of these rows at the next width, with cores and hulls."""

    def run(batches):
        for batch in batches:
            for uid, text, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                place = np.array([r["place"] for r in rows], np.int64)
                known = np.array([r["known"] for r in rows], bool)
                order = np.argsort(place)
                place, known = place[order], known[order]
                at = 0
                while at < len(place):
                    begin = max(int(place[at] >> 16) - LENGTH, 0)
                    upto = int(np.searchsorted(place, (begin + PIECE) << 16))
                    upto = max(upto, at + 1)
                    some = place[at:upto]
                    part = data[begin : int(some[-1] >> 16) + 2 * LENGTH]
                    anchor = (some >> 16) - begin
                    row, interval, near, far = _intervals(some >> 8 & 255, some & 255, width)
                    start, end = anchor[row] - far, anchor[row] - near + LENGTH
                    hashes = _Hashes(part), _Hashes(part, 1)
                    ds = (near << 8 | far).astype(U64)
                    hulls = [mixed(h.of(start, end) + ds * U64(0xD6E8FEB86659FD93)).view(np.int64) for h in hashes]
                    core = _cores(hashes[0], anchor[row], interval, width).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), uid)), pa.array((anchor[row] + begin) << 16 | near << 8 | far),
                         pa.array(known[at:upto][row]), pa.array(core), *map(pa.array, hulls)],
                        ["uid", "place", "known", "core", "hull", "hull2"],
                    )
                    at = upto

    return run


def _settle(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows found to be repeated (uid, place), and those to refine (uid, place, known)."""
    weight = F.when(F.col("known"), 2).otherwise(1)
    hulls = rows.groupBy("hull", "hull2").agg(
        F.sum(weight).alias("times"), F.min(F.struct("uid", "place", "core")).alias("stands")
    )
    open_ = rows.where("not known").join(hulls.select("hull", "hull2", "times"), ["hull", "hull2"])
    repeated = open_.where("times > 1").select("uid", "place")
    settled = hulls.where("times > 1").select("stands.uid", "stands.place", F.lit(True).alias("known"), "stands.core")
    single = open_.where("times = 1").select("uid", "place", F.lit(False).alias("known"), "core")
    cores = (
        single.select("core", F.lit(1).alias("w"), F.lit(1).alias("undecided"))
        .unionByName(settled.select("core", F.lit(2).alias("w"), F.lit(0).alias("undecided")))
        .groupBy("core")
        .agg(F.sum("w").alias("w"), F.sum("undecided").alias("undecided"))
        .where("w > 1 and undecided > 0")
        .select("core")
    )
    go_on = single.unionByName(settled).join(cores, "core", "left_semi").drop("core")
    return repeated, go_on


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    ``spans`` are the maximal runs of marked bytes, as [start, end) in the UTF-8 form;
    ``kept_sha256`` is the digest of the other bytes.  A null text is the empty one; texts
    of fewer than ``LENGTH`` bytes have no marked byte; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "buckets")
    id_type = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    # rows are numbered once, in a saved table: a later scan of the input may be cut otherwise, as when executors are lost
    given = scratch.save(given.withColumn("uid", F.monotonically_increasing_id()), "given", "snappy")
    sha = F.sha2(F.col("text").cast("binary"), 256)
    light = scratch.save(
        given.select("uid", "id", sha.alias("sha"), F.octet_length("text").cast("bigint").alias("n_bytes")), "light"
    )
    copies = light.where(F.col("n_bytes") >= LENGTH).groupBy("sha", "n_bytes").agg(
        F.count("*").alias("c"), F.min("uid").alias("stands")
    ).where("c > 1")
    copied = scratch.save(
        light.join(copies, ["sha", "n_bytes"]).select("uid", (F.col("uid") == F.col("stands")).alias("stands")), "copied"
    )

    windows = given.where(F.octet_length("text") >= LENGTH).select("uid", "text")
    screened = windows.mapInArrow(_screen, "uid bigint, core bigint, place bigint")
    shared = screened.groupBy("core").agg(F.count("*").alias("c")).where("c > 1").select("core")
    rows = screened.join(shared, "core", "left_semi").join(copied, "uid", "left")
    nodes = scratch.save(
        rows.where("stands is null or stands").select("uid", "place", F.col("stands").isNotNull().alias("known"), "core"),
        "nodes",
    )
    undecided = nodes.where("not known").select("core").distinct()
    nodes = scratch.save(nodes.join(undecided, "core", "left_semi").drop("core"), "nodes_0")
    texts = scratch.save(
        windows.join(nodes.select("uid").distinct(), "uid", "left_semi"), "texts", "snappy"
    )
    scratch.keep("light", "copied", "nodes_0", "texts")
    repeated = None
    for level, width in enumerate(WIDTHS):
        listed = nodes.groupBy("uid").agg(F.collect_list(F.struct("place", "known")).alias("rows"))
        parts = scratch.save(
            texts.join(listed, "uid").select("uid", "text", "rows").mapInArrow(
                _refine(width), "uid bigint, place bigint, known boolean, core bigint, hull bigint, hull2 bigint"
            ),
            f"parts_{level}",
        )
        found, nodes = _settle(parts)
        found = scratch.save(found, f"repeated_{level}")
        repeated = found if repeated is None else repeated.unionByName(found)
        if level + 1 < len(WIDTHS):
            nodes = scratch.save(nodes, f"nodes_{level + 1}")
        scratch.drop(f"nodes_{level}")
        scratch.drop(f"parts_{level}")

    places = repeated.groupBy("uid").agg(F.collect_list("place").alias("places"))
    partly = texts.join(places, "uid").select("uid", "text", "places").mapInArrow(
        _cut, "uid bigint, kept_sha256 string, spans array<struct<start: bigint, end: bigint>>"
    )
    span = "array<struct<start: bigint, end: bigint>>"
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("end")))
    is_copy = F.col("copy").isNotNull()
    spans = F.when(is_copy, whole).otherwise(F.coalesce("spans", F.lit([]).cast(span)))
    kept = F.when(is_copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "sha"))
    return (
        light.join(copied.select("uid", F.lit(True).alias("copy")), "uid", "left")
        .join(partly, "uid", "left")
        .select("id", "n_bytes", spans.alias("spans"), kept.alias("kept_sha256"))
        .select(
            F.col("id").cast(id_type).alias(id_col), "n_bytes",
            F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"]).alias("n_removed"),
            F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256", "spans",
        )
    )


def _cut(batches):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out = []
        for uid, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            place = np.array(places, np.int64)
            start = (place >> 16) - (place & 255)
            end = (place >> 16) - (place >> 8 & 255) + LENGTH
            order = np.argsort(start)
            start, end = start[order], np.maximum.accumulate(end[order])
            new = np.append(True, start[1:] > end[:-1])
            spans = list(zip(start[new].tolist(), np.append(end[:-1][new[1:]], end[-1]).tolist(), strict=True))
            kept, at = hashlib.sha256(), 0
            for a, b in spans:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            out.append((uid, kept.hexdigest(), [{"start": a, "end": b} for a, b in spans]))
        if out:
            uids, shas, spans = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids, pa.int64()), pa.array(shas), pa.array(spans, kind)], ["uid", "kept_sha256", "spans"]
            )
