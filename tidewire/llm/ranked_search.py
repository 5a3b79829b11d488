"""Ranked search by terms over a two-level quantised index.

``build_index`` cuts the documents into blocks and writes, for each block and term, the documents that hold the term with two
values: the impact of the term rounded up to a byte (first level) and its exact count (second level).  Parquet keeps the two in
columns of their own, so either is read without the other.

``search`` answers blocks of items in three steps:

* From the bytes alone, every block gets an upper and a lower bound of each document's score for each item; an impact lies within one
  step below its byte.  The block keeps the documents whose upper bound reaches its own kth lower bound.
* The kth lower bound of an item over all blocks is a score that k documents are known to reach.  Documents whose upper bound
  is less can't be among the first k.
* All others are scored anew in integers from the exact counts; a block returns its first k for each item.

Rows between the steps are (block, item), never (document, item): a term, a text or a passage in very many documents makes
no row of its own.  Blocks are bounded in documents and terms, so no task holds more than one block for one block of items.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewire.llm._common import Scratch
from tidewire.llm._words import values_of

#: Bounds of a block, and of a block of items.
BLOCK_DOCS, BLOCK_TERMS, BLOCK_ITEMS = 4096, 1 << 22, 256
#: An impact is less than a million; a byte counts it in steps, rounded up.
STEP = 3922
#: Terms are runs of these bytes of the UTF-8 form, A-Z in lower case: digits, letters, and all beyond ASCII.
_TERMS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in order, with repeats; none for null."""
    return text.translate(_TERMS).split() if text else []


def norm(n: int, docs: int, length: int) -> int:
    """How much a document of ``n`` terms is held back among ``docs`` documents of ``length`` terms together."""
    return 100 - 90 + (90 * n * docs) // max(length, 1)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The exact impact of terms with these counts in documents with these norms."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass(frozen=True)
class Index:
    """A saved index: the number of documents with a term, and of their terms."""

    table: DataFrame
    docs: int
    length: int


class _Codes(dict):
    """Numbers of terms in order of their first use."""

    def __missing__(self, term: bytes) -> int:
        self[term] = code = len(self)
        return code


class _Block:
    """Documents on their way into the index."""

    def __init__(self, number: int):
        self.number, self.codes, self.ids, self.lengths, self.held = number, _Codes(), [], [], 0
        self.of, self.counts = [], []

    def add(self, doc_id, terms: list[bytes]) -> None:
        codes, counts = np.unique(np.fromiter(map(self.codes.__getitem__, terms), np.int64, len(terms)), return_counts=True)
        self.ids.append(doc_id)
        self.lengths.append(len(terms))
        self.of.append(codes)
        self.counts.append(counts)
        self.held += len(terms)

    def rows(self, docs: int, length: int, id_type: pa.DataType):
        """The row of the block's documents, then those of its terms in their order."""
        ids = pa.array([self.ids], pa.list_(id_type))
        yield _batch(self.number, [None], [len(self.ids)], None, None, pa.array([self.lengths], pa.list_(pa.int32())), ids)
        terms = sorted(self.codes)
        if not terms:
            return
        rank = np.empty(len(terms), np.int64)
        rank[[self.codes[t] for t in terms]] = np.arange(len(terms))
        place = np.repeat(np.arange(len(self.ids)), [len(c) for c in self.of])
        of, counts = rank[np.concatenate(self.of)], np.concatenate(self.counts)
        order = np.argsort(of, kind="stable")
        place, counts = place[order], counts[order]
        norms = np.array([norm(n, docs, length) for n in self.lengths], np.int64)
        bytes_ = -(-impact(counts, norms[place]) // STEP)
        ends = np.cumsum(np.bincount(of, minlength=len(terms)))
        for first in range(0, len(terms), 4096):
            bound = np.append(ends[first - 1] if first else 0, ends[first : first + 4096])
            a, b = bound[0], bound[-1]
            lists = [
                pa.ListArray.from_arrays(pa.array((bound - a).astype(np.int32)), pa.array(x[a:b].astype(kind)))
                for x, kind in ((place, np.int16), (bytes_ - 128, np.int8), (counts, np.int32))
            ]
            yield _batch(self.number, terms[first : first + 4096], np.diff(bound), *lists, None, id_type)


def _batch(block: int, terms, n_docs, places, impacts, counts, ids, id_type: pa.DataType | None = None) -> pa.RecordBatch:
    n = len(terms)
    nothing = lambda kind: pa.nulls(n, pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block] * n, pa.int64()), pa.array(terms, pa.binary()), pa.array(n_docs, pa.int32()),
            nothing(pa.int16()) if places is None else places, nothing(pa.int8()) if impacts is None else impacts,
            counts, nothing(id_type) if ids is None else ids,
        ],
        ["block", "term", "n_docs", "places", "impacts", "counts", "ids"],
    )


def _rows(batches):
    """(id, text) of batches, a few at a time."""
    for batch in batches:
        yield from zip(values_of(batch.column(0)), values_of(batch.column(1)), strict=True)


def _count(batches):
    docs = length = 0
    for batch in batches:
        for text in values_of(batch.column(0)):
            n = len(terms_of(text))
            docs, length = docs + (n > 0), length + n
    yield pa.RecordBatch.from_arrays([pa.array([docs], pa.int64()), pa.array([length], pa.int64())], ["docs", "length"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS) -> Index:
    """An index of every row and whole text, saved in the shared folder.

    Rows are documents of their own even if their ids are equal or null.  A null text has no terms; documents without one are found by no
    item.  Further columns are not read.
    """
    if block_docs > 1 << 15:
        raise ValueError("a block has 32,768 documents at most")
    scratch = Scratch(docs.sparkSession, "terms")
    id_type = docs.schema[id_col].dataType
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    tally = texts.select("text").mapInArrow(_count, "docs bigint, length bigint").agg(F.sum("docs"), F.sum("length")).first()
    n_docs, length = int(tally[0] or 0), int(tally[1] or 0)
    kind = to_arrow_type(id_type)

    def build(batches):
        first = TaskContext.get().partitionId() << 32
        block = _Block(first)
        for doc_id, text in _rows(batches):
            block.add(doc_id, terms_of(text))
            if len(block.ids) == block_docs or block.held >= BLOCK_TERMS:
                yield from block.rows(n_docs, length, kind)
                first += 1
                block = _Block(first)
        if block.ids:
            yield from block.rows(n_docs, length, kind)

    schema = (
        "block bigint, term binary, n_docs int, places array<smallint>, impacts array<tinyint>, counts array<int>, "
        f"ids array<{id_type.simpleString()}>"
    )
    return Index(scratch.save(texts.mapInArrow(build, schema), "index", "zstd"), n_docs, length)


def _items(batches):
    """Items in blocks: their number, place, id and terms."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK_ITEMS):
            part = batch.slice(first, BLOCK_ITEMS)
            n = part.num_rows
            terms = [sorted(set(terms_of(t))) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * n, pa.int64()), pa.array(range(n), pa.int32()), part.column(0), pa.array(terms, pa.list_(pa.binary()))],
                ["item_block", "item", "item_id", "terms"],
            )
            number += 1


def _groups(batches, keys: int):
    """Rows with equal first columns, from batches that are sorted by them."""
    rows = (row for batch in batches for first in range(0, batch.num_rows, 256) for row in _plain(batch.slice(first, 256)))
    return groupby(rows, lambda r: r[:keys])


def _plain(part: pa.RecordBatch):
    """Rows, with lists of numbers (not of ids, which may be null) as arrays."""
    columns = []
    for name, c in zip(part.schema.names, part.columns, strict=True):
        numbers = name != "ids" and pa.types.is_list(c.type)
        columns.append([None if not x.is_valid else x.values.to_numpy() for x in c] if numbers else c.to_pylist())
    return zip(*columns, strict=True)


def _bounds(k: int, block_docs: int):
    """(block, item_block, weight, items, places, impacts) to the documents of a block that may be among the first k of an item."""

    def run(batches):
        for (block, item_block), rows in _groups(batches, 2):
            high, low = np.zeros((2, BLOCK_ITEMS, block_docs), np.int64)
            touched = set()
            for _, _, weight, items, places, impacts in rows:
                upper = (impacts.astype(np.int64) + 128) * (STEP * weight)
                lower = np.maximum(upper - (STEP - 1) * weight, 0)
                for i in items.tolist():
                    high[i, places] += upper
                    low[i, places] += lower
                touched.update(items.tolist())
            out = []
            for i in sorted(touched):
                lows = low[i][low[i] > 0]
                lows = -np.sort(np.partition(-lows, k - 1)[:k]) if len(lows) > k else np.sort(lows)[::-1]
                least = lows[k - 1] if len(lows) == k else 1
                places = np.flatnonzero(high[i] >= least)
                if len(places):
                    out.append((block, item_block, i, places.tolist(), high[i, places].tolist(), lows.tolist()))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int16()), pa.list_(pa.int64()), pa.list_(pa.int64()))
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "item_block", "item", "places", "highs", "lows"])

    return run


def _rescore(k: int, docs: int, length: int, id_type: pa.DataType):
    """Sorted rows (block, item_block, kind, item, weight, items, places, counts, ids) to the first k of a block for each item.

    Kind 0 is the block's documents, 1 an item with the places to be scored, 2 a term of items with its places and counts.
    """

    def run(batches):
        for (_, item_block), rows in _groups(batches, 2):
            open_: dict[int, np.ndarray] = {}
            for _, _, kind, item, weight, items, places, counts, ids in rows:
                if kind == 0:
                    names, norms = ids, np.array([norm(n, docs, length) for n in counts.tolist()], np.int64)
                    scores = np.zeros((BLOCK_ITEMS, len(norms)), np.int64)
                elif kind == 1:
                    open_[item] = places
                else:
                    wanted = [i for i in items.tolist() if i in open_]
                    if wanted:
                        gain = weight * impact(counts.astype(np.int64), norms[places])
                        for i in wanted:
                            scores[i, places] += gain
            out = []
            for i, places in open_.items():
                found = scores[i, places]
                least = max(np.partition(found, len(found) - k)[len(found) - k], 1) if len(found) > k else 1
                best = [(-int(s), names[p] is None, names[p]) for s, p in zip(found, places, strict=True) if s >= least]
                out += [(item_block, i, name, -s) for s, _, name in sorted(best, key=lambda b: b if b[2] is not None else b[:2])[:k]]
            if out:
                kinds = (pa.int64(), pa.int32(), id_type, pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["item_block", "item", "id", "score"])

    return run


def search(index: Index, items: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text", id_name: str = "doc_id") -> DataFrame:
    """The ``k`` documents of highest score above 0 for each row of ``items``: item id, rank from 1, document id, score.

    Equal scores are ranked by ascending document id, a null one last.  Rows of ``items`` with equal or null ids are items of their own; an
    item without a term that the documents have gets no row.
    """
    spark: SparkSession = items.sparkSession
    scratch = Scratch(spark, "search")
    table, block_docs = index.table, _largest(index)
    id_type = table.schema["ids"].dataType.elementType
    item_type = items.schema[item_col].dataType.simpleString()
    given = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    asked = scratch.save(given.mapInArrow(_items, f"item_block bigint, item int, item_id {item_type}, terms array<binary>"), "items", few=True)
    by_term = asked.select("item_block", "item", F.explode("terms").alias("term"))
    postings = table.where("term is not null")
    known = postings.select("term", "n_docs").join(by_term.select("term").distinct(), "term").groupBy("term").agg(F.sum("n_docs").alias("df"))
    ratio = F.lit(2.0 * index.docs + 2) / (F.col("df") * 2 + 1).cast("double")
    weighed = known.select("term", F.floor(F.log(ratio) * 1000).alias("weight")).where("weight > 0")
    lists = by_term.groupBy("item_block", "term").agg(F.array_sort(F.collect_list("item")).alias("items"))
    query = scratch.save(lists.join(weighed, "term").select("item_block", "term", "weight", "items"), "query", few=True)

    hits = postings.select("block", "term", "places", "impacts").join(query, "term")
    hits = hits.select("block", "item_block", "weight", "items", "places", "impacts")
    bounded = scratch.save(
        hits.repartition("block", "item_block").sortWithinPartitions("block", "item_block").mapInArrow(
            _bounds(k, block_docs), "block bigint, item_block bigint, item int, places array<smallint>, highs array<bigint>, lows array<bigint>"
        ),
        "bounded",
    )
    place = Window.partitionBy("item_block", "item").orderBy(F.desc("low"))
    lows = bounded.select("item_block", "item", F.explode("lows").alias("low")).withColumn("place", F.row_number().over(place))
    bar = lows.where(F.col("place") <= k).groupBy("item_block", "item").agg(
        F.when(F.count("*") == k, F.min("low")).otherwise(F.lit(1)).alias("bar")
    )
    reaching = F.filter(F.arrays_zip("places", "highs"), lambda p: p["highs"] >= F.col("bar"))
    reached = bounded.join(bar, ["item_block", "item"]).select("block", "item_block", "item", F.transform(reaching, lambda p: p["places"]).alias("places"))
    open_ = scratch.save(reached.where(F.size("places") > 0), "open")

    pairs = open_.select("block", "item_block").distinct()
    null = lambda name, kind: F.lit(None).cast(kind).alias(name)
    ids = f"array<{id_type.simpleString()}>"
    nothing = {"item": "int", "weight": "bigint", "items": "array<int>", "places": "array<smallint>", "counts": "array<int>", "ids": ids}

    def kind(df: DataFrame, number: int) -> DataFrame:
        columns = [F.col(c) if c in df.columns else null(c, t) for c, t in nothing.items()]
        return df.select("block", "item_block", F.lit(number).alias("kind"), *columns)

    documents = table.where("term is null").select("block", "counts", "ids").join(pairs, "block")
    exact = postings.select("block", "term", "places", "counts").join(query, "term").join(pairs, ["block", "item_block"], "left_semi")
    rows = kind(documents, 0).unionByName(kind(open_, 1)).unionByName(kind(exact.drop("term"), 2))
    found = rows.repartition("block", "item_block").sortWithinPartitions("block", "item_block", "kind").mapInArrow(
        _rescore(k, index.docs, index.length, to_arrow_type(id_type)),
        f"item_block bigint, item int, id {id_type.simpleString()}, score bigint",
    )
    best = Window.partitionBy("item_block", "item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item_block", "item", "item_id"), ["item_block", "item"]).select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_name), "score"
    )


def _largest(index: Index) -> int:
    """How many documents the largest block has."""
    return index.table.where("term is null").agg(F.max("n_docs")).first()[0] or 1
