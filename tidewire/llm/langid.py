"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the n-grams of one to three characters of the lower-cased text,
hashed into ``BUCKETS`` buckets: (1 + log count) * idf, scaled to length one.
Document frequencies are counted over all training documents.  The weights are
learned with follow-the-regularised-leader (proximal, per-coordinate rates) under
an elastic-net penalty, whose absolute part leaves most of them zero; then one
temperature is fitted on training documents that the weights have not seen, so
that the probability of the predicted language can be read as such.

Only the text is an input.  Learning uses documents with a label whose
``crc32(id) mod 5`` is not 0.  The weights are fitted on at most ``SAMPLE`` of
them: of each label about an equal share, those
whose hash of the id is smallest.  What is gathered on the driver is bounded by this
sample and the number of buckets.  Prediction reads whole texts where they lie;
no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm._common import fresh
from tidewire.llm._words import portions, values_of

BUCKETS, ORDERS = 4096, (1, 2, 3)
#: Bound of the fitting sample, unless there are more labels: each has a document in it.
SAMPLE = 6000
EPOCHS, BATCH, ALPHA, BETA, L1, L2 = 4, 16, 0.3, 1.0, 0.5, 0.01
#: Bounds of the temperature, for samples that the weights separate fully.
COLDEST, HOTTEST = 0.25, 16.0
UNDETERMINED = "und"
#: Texts are counted so many characters at a time, so that what a worker holds stays small and near the processor.
PORTION = 100_000


def held_out(id_col: Column) -> Column:
    """True for the fifth of the ids that nothing is learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def gram_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of the hashed n-grams: a row per text, a column per bucket."""
    lowered = [(t or "").lower() for t in texts]
    c = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in lowered])
    ends = np.cumsum(lengths)
    row = np.repeat(np.arange(len(texts), dtype=np.int64) * BUCKETS, lengths)
    places = []
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    for n in ORDERS:
        if len(c) < n:
            continue
        h = np.zeros(len(c) - n + 1, np.uint32)
        for i in range(n):
            h = (h + c[i : len(c) - n + 1 + i]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        h = (h + np.uint32(n)) * np.uint32(0x85EBCA6B) >> shift
        at = row[: len(h)] + h
        if n > 1:  # leave out what spans two texts
            inside = np.ones(len(h), bool)
            for back in range(1, n):
                e = ends - back
                inside[e[(e >= 0) & (e < len(h))]] = False
            at = at[inside]
        places.append(at)
    at = np.concatenate(places) if places else np.empty(0, np.int64)
    return np.bincount(at, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)


#: 1 + log of small counts, 0 for 0.
_LOGS = np.concatenate([[0], 1 + np.log(np.arange(1, 1 << 15))]).astype(np.float32)


def frequencies(counts: np.ndarray) -> np.ndarray:
    if counts.size and counts.max() >= len(_LOGS):
        return np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32)
    return _LOGS[counts]


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        """Those of the features, without making them: idf and length are brought into the weights."""
        tf = frequencies(counts)
        z = tf @ (self.idf[:, None] * self.weights)
        tf *= tf
        return z / np.maximum(np.sqrt(tf @ (self.idf**2)), 1e-12)[:, None] + self.bias

    def predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The number of the likeliest language of each text, and its probability."""
        p = _softmax(self.logits(gram_counts(texts)) / self.temperature)
        best = p.argmax(axis=1)
        return best, p[np.arange(len(p)), best]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Rows:
    """Sparse feature rows of length one: those of the fitting sample."""

    def __init__(self, offsets: np.ndarray, buckets: np.ndarray, values: np.ndarray):
        self.offsets, self.buckets, self.values = offsets, buckets, values

    @classmethod
    def of(cls, offsets: np.ndarray, buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> Rows:
        values = np.empty(len(buckets), np.float32)
        for first in range(0, len(offsets) - 1, 250):  # what is made on the way is a multiple of the rows
            ends = offsets[first : first + 251]
            at = slice(ends[0], ends[-1])
            found = frequencies(counts[at]) * idf[buckets[at]]
            row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            norms = np.sqrt(np.bincount(row, found.astype(np.float64) ** 2, minlength=len(ends) - 1))
            values[at] = found / np.maximum(norms, 1e-12)[row].astype(np.float32)
        return cls(offsets, buckets, values)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def dense(self, rows: np.ndarray) -> np.ndarray:
        """The given rows with a last column of ones; only ever a batch."""
        out = np.zeros((len(rows), BUCKETS + 1), np.float32)
        out[:, -1] = 1
        for i, r in enumerate(rows.tolist()):
            at = slice(self.offsets[r], self.offsets[r + 1])
            out[i, self.buckets[at]] = self.values[at]
        return out


def fit_ftrl(x: Rows, y: np.ndarray, n_classes: int, seen: np.ndarray, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by follow-the-regularised-leader over the ``seen`` rows; the bias has no penalty."""
    z = np.zeros((BUCKETS + 1, n_classes))
    n = np.zeros_like(z)
    l1 = np.full((BUCKETS + 1, 1), L1)
    l1[-1] = 0

    def weights():
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0)

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(seen)
        for first in range(0, len(order), BATCH):
            rows = order[first : first + BATCH]
            batch = x.dense(rows)
            w = weights()
            p = _softmax(batch @ w)
            p[np.arange(len(rows)), y[rows]] -= 1
            g = batch.T @ p
            sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
            z += g - sigma * w
            n += g * g
    w = weights()
    return w[:-1].astype(np.float32), w[-1].astype(np.float32)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least log loss, by golden section on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    lo, hi, r = np.log(COLDEST), np.log(HOTTEST), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in portions(values_of(batch.column(0)), _weight, PORTION):
            df += (gram_counts(part) > 0).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(df)], ["bucket", "df"])


def _weight(text: str | None) -> int:
    return len(text or "") + BUCKETS


def _sparse_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, places = batch.column(0), batch.column(1)
        first = 0
        for part in portions(values_of(batch.column(2)), _weight, PORTION):
            counts = gram_counts(part)
            rows, buckets = np.nonzero(counts)
            offsets = np.searchsorted(rows, np.arange(len(part) + 1)).astype(np.int32)
            arrays = [langs.slice(first, len(part)), places.slice(first, len(part))]
            for flat in (buckets.astype(np.int16), counts[rows, buckets].astype(np.int32)):
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
            first += len(part)
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "h", "buckets", "counts"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model of the labels of ``docs``, or None if no document can be learned from."""
    rows = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string"), F.lit("fit")).alias("h"),
        F.col(text_col).alias("text"),
    )
    totals = rows.groupBy("lang").agg(F.count("*").alias("count"), F.min("h").alias("first")).orderBy("lang").collect()
    if not totals:
        return None
    langs = sorted(r["lang"] for r in totals)
    share = max(SAMPLE // len(langs), 1)
    # hashes are uniform, so this part of their range holds about a label's share of rows
    parts = {r["lang"]: min(share / r["count"], 1.0) for r in totals}
    # and the first of each label is always among them
    cuts = [(r["lang"], max(min(int(parts[r["lang"]] * 2**64) - 2**63, 2**63 - 1), r["first"]), r["first"]) for r in totals]
    cut = F.broadcast(docs.sparkSession.createDataFrame(cuts, "lang string, cut bigint, first bigint"))
    sample = (
        rows.join(cut, "lang").where("h <= cut").select("lang", "h", "text")
        .mapInArrow(_sparse_counts, "lang string, h bigint, buckets array<smallint>, counts array<int>")
        .join(cut, "lang")
        .orderBy(F.col("h") > F.col("first"), "h", "lang")
        .select("lang", "buckets", "counts")
        .limit(max(SAMPLE, len(langs)))
        .toArrow()
    )
    df = np.zeros(BUCKETS)
    for r in rows.select("text").mapInArrow(_document_frequencies, "bucket bigint, df bigint").groupBy("bucket").agg(
        F.sum("df").alias("df")
    ).collect():
        df[r["bucket"]] = r["df"]
    n = sum(r["count"] for r in totals)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    lists = [sample[c].combine_chunks() for c in ("buckets", "counts")]
    if isinstance(lists[0], pa.ChunkedArray):
        lists = [pa.concat_arrays(c.chunks) for c in lists]
    offsets = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    buckets, counts = (c.flatten().to_numpy() for c in lists)
    place = {lang: i for i, lang in enumerate(langs)}
    y = np.array([place[v] for v in sample["lang"].to_pylist()], int)
    del sample, lists
    x = Rows.of(offsets, buckets, counts, idf)
    del counts
    every = np.arange(len(y))
    later = np.ones(len(y), bool)
    later[np.unique(y, return_index=True)[1]] = False  # no label is left to the rows held back
    back = later & (every % 5 == 4)
    seen, unseen = every[~back], every[back]
    weights, bias = fit_ftrl(x, y, len(langs), seen)
    logits = [x.dense(part)[:, :-1] @ weights + bias for part in np.array_split(unseen, len(unseen) // 500 + 1)]
    return Model(langs, idf, weights, bias, fit_temperature(np.concatenate(logits), y[unseen]))


def with_language(
    docs: DataFrame, model: Model | None, text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score"
) -> DataFrame:
    """``docs`` with two more columns: the predicted language and its probability.

    A null text and one without any letter get ``und`` and 0, as all texts do if
    there is no model.  Rows, their order and their other columns stay.
    """
    if model is None:
        return docs.withColumn(lang_name, F.lit(UNDETERMINED)).withColumn(score_name, F.lit(0.0))
    lettered = fresh(docs, "__lettered")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())]
    )
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = held.value
        names = np.array(model.langs, object)
        for batch in batches:
            texts = values_of(batch.column(batch.schema.get_field_index(text_col)))
            known = batch.column(batch.num_columns - 1).to_pylist()
            first = 0
            for part in portions(texts, _weight, PORTION):
                best, p = model.predict(part)
                ok = np.array(known[first : first + len(part)], bool)
                lang, score = np.where(ok, names[best], UNDETERMINED), np.where(ok, p, 0.0)
                kept = batch.slice(first, len(part)).columns[:-1]
                first += len(part)
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(lang.tolist(), pa.string()), pa.array(score, pa.float64())], schema.names
                )

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(lettered, letters).mapInArrow(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score; fitted on its own labels.

    Repeated rows are predicted alike; an empty table gives no rows.
    """
    model = fit(docs, id_col, text_col, lang_col)
    found = with_language(docs.select(F.col(id_col), F.col(text_col)), model, text_col)
    return found.select(id_col, held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score")
