"""Benchmark decontamination: size-partitioned MinHash containment search.

Which documents contain a benchmark item, wholly or to ``threshold`` of its
five-word shingles?  A short item has almost no Jaccard similarity with a long
document, so sizes are partitioned on both sides: an item of q shingles belongs
to the class of the next power of two w, and for that class a document is a
series of overlapping windows of a little more than w shingles.  An item at
containment t then has Jaccard similarity of at least t*q/(w + 4 + q*(1 - t)),
a constant that does not fall with the document's length.  Item and window are
candidates if any of ``hashes`` min-wise hashes agree (bands of one row, which
is what such similarities need); a candidate is verified by exact containment
of the item's shingles, compared word by word, in the whole document.

Documents are never shuffled: the index of a block of items is broadcast, and
its size is bounded by ``BLOCK_ITEMS`` items and ``BLOCK_WORDS`` words.  A larger
benchmark takes one pass over the documents for each block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm._words import U64, multipliers, portions, shingles, values_of, word_hashes, words_of

WORDS, THRESHOLD, HASHES, SEED = 5, 0.8, 64, 9
#: Bounds of one broadcast index.
BLOCK_ITEMS, BLOCK_WORDS = 20_000, 2_000_000
#: Windows start at every block of so many shingles.
STEP = 4
_TOP = U64(2**64 - 1)


class _Index:
    """The min-wise hashes and shingles of a block of items that share the shingle length k."""

    def __init__(self, items: list[tuple[object, list[str]]], k: int, hashes: int):
        self.k, self.factors, self.items = k, multipliers(hashes, SEED).astype(np.uint32), []
        found: list[dict[int, list[int]]] = [defaultdict(list) for _ in range(hashes)]
        for item_id, words in items:
            x = shingles(word_hashes([" ".join(words)])[0], k)
            first = {}
            for i, h in enumerate(x.tolist()):
                first.setdefault(tuple(words[i : i + k]), h)
            window = STEP
            while window < len(first):
                window *= 2
            for j, a in enumerate(self.factors):
                found[j][int((x.astype(np.uint32) * a).min())].append(len(self.items))
            self.items.append((item_id, window // STEP + 1, first))
        self.found = [dict(x) for x in found]
        self.tables = np.zeros((hashes, 1 << 16), bool)
        for j, x in enumerate(self.found):
            self.tables[j, np.fromiter(x, U64, len(x)).astype(np.uint16)] = True

    def candidates(self, x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs; x: blocks of STEP shingles, of which document d has those from starts[d] to ends[d]."""
        out = set()
        block_of = None
        empty = x == _TOP
        rows = [np.ascontiguousarray(x[i::STEP].astype(np.uint32)) for i in range(STEP)]
        gaps = [np.flatnonzero(empty[i::STEP]) for i in range(STEP)]
        for j, a in enumerate(self.factors):
            v = None
            for row, gap in zip(rows, gaps, strict=True):
                y = row * a
                y[gap] = 0xFFFFFFFF
                v = y if v is None else np.minimum(v, y, out=v)
            hits = np.flatnonzero(self.tables[j, v.astype(np.uint16)])
            for b in hits.tolist():
                for i in self.found[j].get(int(v[b]), ()):
                    if block_of is None:
                        block_of = np.repeat(np.arange(len(starts)), ends - starts)
                    d = int(block_of[b])
                    if (d, i) not in out and _least_of_a_window(v, b, int(starts[d]), int(ends[d]), self.items[i][1]):
                        out.add((d, i))
        return out

    def containment(self, i: int, words: list[str]) -> int:
        """How many of the item's distinct shingles the words contain."""
        wanted, k = self.items[i][2], self.k
        firsts = {s[0] for s in wanted}
        return len({s for p, w in enumerate(words) if w in firsts and (s := tuple(words[p : p + k])) in wanted})


def _least_of_a_window(v: np.ndarray, b: int, start: int, end: int, length: int) -> bool:
    """Is v[b] the least of some window of ``length`` blocks of its document that contains b?"""
    length = min(length, end - start)
    lo = max(start, b - length + 1)
    left = np.flatnonzero(v[lo:b] < v[b])
    lo = lo + int(left[-1]) + 1 if len(left) else lo
    hi = min(end, b + length)
    right = np.flatnonzero(v[b:hi] < v[b])
    hi = b + int(right[0]) if len(right) else hi
    return hi - lo >= length


class _Searcher:
    """Finds the items of its indexes in texts; one for each task."""

    def __init__(self, indexes: list[_Index], threshold: float):
        self.indexes, self.threshold = indexes, threshold

    def search(self, texts: Iterable[str | None]) -> Iterator[tuple[int, object, int, int]]:
        """(text number, item id, shingles found, shingles of the item), in order of the texts."""
        base = 0
        for part in portions(texts, lambda t: len(t or "") + 64, 1_000_000):
            hashes = word_hashes(part)
            got = []
            for index in self.indexes:
                k = index.k
                rows = [shingles(h, k) if len(h) >= k else h[:0] for h in hashes]
                blocks = np.array([-(-len(r) // STEP) for r in rows])
                ends = np.cumsum(blocks)
                x = np.full(int(ends[-1]) * STEP, _TOP)
                for r, s in zip(rows, ((ends - blocks) * STEP).tolist(), strict=True):
                    x[s : s + len(r)] = r
                if not len(x):
                    continue
                words = cache(lambda d: words_of(part[d]))  # noqa: B023  used up before the next part
                for d, i in sorted(index.candidates(x, ends - blocks, ends)):
                    total = len(index.items[i][2])
                    n = index.containment(i, words(d))
                    if n >= self.threshold * total:
                        got.append((base + d, index.items[i][0], n, total))
            yield from sorted(got, key=lambda g: g[0])
            base += len(part)


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[_Index]]:
    """The benchmark in blocks of bounded size; items without a word can be found nowhere and are left out."""

    def indexes(block: list) -> list[_Index]:
        by_k = defaultdict(list)
        for item_id, words in block:
            by_k[min(WORDS, len(words))].append((item_id, words))
        return [_Index(items, k, HASHES) for k, items in sorted(by_k.items())]

    block, total = [], 0
    for row in benchmark.select(id_col, text_col).toLocalIterator():
        if words := words_of(row[1]):
            block.append((row[0], words))
            total += len(words)
        if len(block) >= BLOCK_ITEMS or total >= BLOCK_WORDS:
            yield indexes(block)
            block, total = [], 0
    if block:
        yield indexes(block)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document row and item it contains: id, item, n_found, n_shingles, containment.

    ``containment`` is the share of the item's distinct five-word shingles (of an
    item of fewer words: all its words as one shingle) that the document has.
    Null and empty texts contain nothing; repeated document rows give a row each;
    items with the same text are each reported; empty tables give no rows.
    """
    spark = docs.sparkSession
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField(item_col, benchmark.schema[item_col].dataType),
            T.StructField("n_found", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
        ]
    )
    out = spark.createDataFrame([], schema)
    names = schema.names

    for indexes in _item_blocks(benchmark, item_col, item_text_col):
        held = spark.sparkContext.broadcast(indexes)

        def find(batches, held=held):
            searcher = _Searcher(held.value, threshold)
            for batch in batches:
                hits = list(searcher.search(values_of(batch.column(1))))
                ids = batch.column(0).take(pa.array([h[0] for h in hits], pa.int64()))
                rest = [pa.array([h[n] for h in hits]) for n in (1, 2, 3)]
                if hits:
                    yield pa.RecordBatch.from_arrays([ids, *rest], names)

        out = out.unionByName(docs.select(id_col, text_col).mapInArrow(find, schema))
    return out.withColumn("containment", F.round(F.col("n_found") / F.col("n_shingles"), 6))


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` without the rows that contain an item, all columns unchanged and nothing shuffled."""
    for indexes in _item_blocks(benchmark, item_col, item_text_col):
        held = docs.sparkSession.sparkContext.broadcast(indexes)

        def clean(batches, held=held):
            searcher = _Searcher(held.value, threshold)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                texts = values_of(batch.column(batch.schema.get_field_index(text_col)))
                keep[[h[0] for h in searcher.search(texts)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
