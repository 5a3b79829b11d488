"""Whitening of embeddings by the singular value decomposition of their centred, distributed rows.

Vectors become integers, ``floor(scale * entry)``, so that copies are equal and sums are exact.  The fit works on every distinct
integer vector once: exact sums per dimension, then ``RowMatrix.computeSVD`` on the centred rows.  A singular value s of n rows is
rescaled to the eigenvalue s^2 / n of the covariance with divisor n.  The total variance doesn't come from the decomposition but from
the exact squared deviations of all vectors, so what the first components explain is measured against a value of its own.

Only matrices of the size of one covariance (dimension by dimension) reach the driver; rows stay where they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm._common import Scratch

SCALE, COMPONENTS = 256, 4
#: Components whose singular value is less than this part of the largest count as without variance: the decomposition squares
#: singular values, so smaller ones can't be told from rounding.
LEAST = 1e-7


@dataclass(frozen=True)
class Whitening:
    """What a fit has found: ``basis`` holds the unit eigenvectors as columns, ``values`` their eigenvalues, largest first."""

    n: int
    sums: tuple[int, ...]
    basis: np.ndarray
    values: np.ndarray
    total: float = math.nan
    identity_error: float = math.nan

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S of integer rows, exactly."""
        largest = max(map(abs, self.sums), default=0)
        if int(np.abs(x).max(initial=0)) * self.n + largest < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def squared(self, d: np.ndarray) -> list[int]:
        """The exact sum of squares of each row of ``deviations``."""
        if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * max(d.shape[1], 1) < 1 << 63:
            return (d * d).sum(axis=1).tolist()
        wide = d.astype(object)
        return (wide * wide).sum(axis=1).tolist()

    def whitened(self, d: np.ndarray) -> np.ndarray:
        return (d.astype(np.float64) / self.n) @ self.basis / np.sqrt(self.values)


def usable(vector: str, scale: int = SCALE) -> Column:
    """No null, no null entry, no entry that is not finite or whose multiple doesn't fit a 64-bit integer."""
    v = F.col(f"`{vector}`")
    return v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & F.coalesce(F.abs(c.cast("double")) * scale < 2.0**63, F.lit(False)) & ~F.isnan(c))


def integers(vector: str, scale: int = SCALE) -> Column:
    return F.transform(F.col(f"`{vector}`"), lambda c: F.floor(c.cast("double") * scale))


def _rows(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    kept = vectors.where(usable(vector_col, scale))
    return kept.select(F.col(f"`{id_col}`").alias("id"), integers(vector_col, scale).alias("x")).where(F.size("x") > 0)


def _matrices(column: pa.Array, dimension: int) -> Iterator[tuple[int, np.ndarray]]:
    """Arrow lists of ``dimension`` integers as matrices of some rows, with the first row's place."""
    for first in range(0, len(column), 4096):
        part = column.slice(first, 4096)
        yield first, part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), dimension)


def _sums(dimension: int):
    """Per task: (dimension, exact sum, rows)."""

    def run(batches):
        sums, n = [0] * dimension, 0
        for batch in batches:
            for _, x in _matrices(batch.column(0), dimension):
                small = int(np.abs(x).max(initial=0)) < 1 << 48
                sums = [a + int(b) for a, b in zip(sums, (x if small else x.astype(object)).sum(axis=0), strict=True)]
                n += len(x)
        if n:
            exact = pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))
            columns = [pa.array(range(dimension), pa.int32()), exact, pa.array([n] * dimension, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["at", "s", "n"])

    return run


def _project(model: Whitening):
    """(x) to (deviation, whitened)."""

    def run(batches):
        for batch in batches:
            for _, x in _matrices(batch.column(0), len(model.sums)):
                d = model.deviations(x)
                exact = pa.array([Decimal(s) for s in model.squared(d)], pa.decimal128(38, 0))
                w = model.whitened(d)
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1], w.ravel())
                yield pa.RecordBatch.from_arrays([exact, lists], ["deviation", "whitened"])

    return run


def fit(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening | None:
    """The whitening of every distinct vector; None if no vector is usable.

    Where vectors have several dimensions, the most frequent one counts, the larger of equals.
    """
    spark = vectors.sparkSession
    rows = _rows(vectors, id_col, vector_col, scale)
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return None
    dimension = common["d"]
    scratch = Scratch(spark, "whiten")
    distinct = scratch.save(rows.where(F.size("x") == dimension).select("x").distinct(), "distinct", "zstd")
    tallies = distinct.mapInArrow(_sums(dimension), "at int, s decimal(38,0), n bigint")
    tally = sorted(tallies.groupBy("at").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect(), key=lambda r: r["at"])
    n, sums = tally[0]["n"], tuple(int(r["s"]) for r in tally)
    none = Whitening(n, sums, np.zeros((dimension, 0)), np.zeros(0))
    mean = F.lit([s / n for s in sums])
    centred = distinct.select(array_to_vector(F.zip_with("x", mean, lambda a, m: a - m)).alias("v"))
    found = RowMatrix(MLUtils.convertVectorColumnsFromML(centred, "v")).computeSVD(dimension, False, LEAST) if n > 1 else None
    if found is not None and found.s.size and found.s[0] > 0:
        keep = min(components, int((found.s.toArray() > 0).sum()))
        none = Whitening(n, sums, found.V.toArray()[:, :keep], found.s.toArray()[:keep] ** 2 / n)
    return _measured(distinct, none)


def _measured(distinct: DataFrame, model: Whitening) -> Whitening:
    """The model with its total variance, and how far the whitened rows' covariance is from the identity."""
    k = len(model.values)
    projected = distinct.mapInArrow(_project(model), "deviation decimal(38,0), whitened array<double>")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    covariance = [F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs]
    row = projected.agg(F.sum("deviation").alias("deviation"), *covariance).first()
    total = float(int(row["deviation"]) / model.n**3)
    error = max((abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs), default=math.nan)
    return Whitening(model.n, model.sums, model.basis, model.values, total, error)


def apply(vectors: DataFrame, model: Whitening, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per usable vector of the model's dimension and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    ``deviation`` is null if it doesn't fit a 64-bit integer.
    """
    id_type = vectors.schema[id_col].dataType
    rows = _rows(vectors, id_col, vector_col, scale).where(F.size("x") == len(model.sums))
    k = len(model.values)

    def run(batches):
        for batch in batches:
            for first, x in _matrices(batch.column(1), len(model.sums)):
                d = model.deviations(x)
                squared = [s if s < 1 << 63 else None for s in model.squared(d)]
                n = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n).take(pa.array(np.repeat(np.arange(n), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                        pa.array(squared, pa.int64()).take(pa.array(np.repeat(np.arange(n), k))),
                        pa.array(model.whitened(d).ravel()),
                        pa.array(np.tile(model.values / model.total, n)),
                    ],
                    ["id", "component", "deviation", "whitened", "explained"],
                )

    out = rows.mapInArrow(run, f"id {id_type.simpleString()}, component int, deviation bigint, whitened double, explained double")
    constants = F.lit(model.n).cast("bigint").alias("n"), F.lit(model.identity_error).alias("identity_error")
    return out.select(F.col("id").alias(id_col), "component", constants[0], "deviation", "whitened", "explained", constants[1])


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``apply`` of ``fit`` to the same rows.

    Rows whose vector is null or empty, or holds null, non-finite or unfit entries (``usable``), are dropped, and so are vectors of
    another dimension than most.  Copies of a vector and rows of equal id each get their rows; null ids are kept.  Vectors that span
    fewer than ``components`` dimensions have fewer components, none if all are equal.  Further columns are not read; an empty table
    gives no rows.
    """
    model = fit(vectors, components, scale, id_col, vector_col)
    if model is None:
        model = Whitening(1, (), np.zeros((0, 0)), np.zeros(0))
        vectors = vectors.limit(0)
    return apply(vectors, model, scale, id_col, vector_col)
