import math

import numpy as np
import pytest

from tidewire.llm import whiten


def brute(rows, components=4):
    """id, component -> (n, deviation, |whitened|, explained) of (id, vector)."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(n * c - s) for c, s in zip(x, sums, strict=True)] for x in fit]) / n
    covariance = centred.T @ centred / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    out = {}
    for i, x in kept:
        d = [n * c - s for c, s in zip(x, sums, strict=True)]
        w = np.array(d, float) / n @ basis / np.sqrt(values)
        for k in range(len(values)):
            out[i, k + 1] = n, sum(c * c for c in d), abs(w[k]), values[k] / np.trace(covariance)
    return out


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")


def random_rows(count, dimension, seed=0):
    r = np.random.default_rng(seed)
    spread = r.normal(size=(dimension, dimension)) * np.linspace(2, 0.1, dimension)[:, None]
    return [(i, [float(np.float32(c)) for c in r.normal(size=dimension) @ spread + 1]) for i in range(count)]


def check(got, want):
    assert {(r.vec_id, r.component) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        n, deviation, whitened, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(whitened, abs=1e-8) and r.explained == pytest.approx(explained, rel=1e-9)
        assert r.identity_error < 1e-9


@pytest.mark.parametrize("dimension", [3, 12, 130])
def test_equals_eigenvectors(spark, dimension):
    rows = random_rows(400, dimension, dimension)
    rows += [(1000 + i, rows[5][1]) for i in range(200)]  # copies count once
    got = whiten.whiten(table(spark, rows).repartition(5)).collect()
    check(got, brute(rows))


def test_signs_are_the_same_for_all_rows(spark):
    rows = random_rows(200, 6)
    got = {(r.vec_id, r.component): r.whitened for r in whiten.whiten(table(spark, rows)).collect()}
    w = np.array([[got[i, k] for k in range(1, 5)] for i, _ in rows])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(4)).max() < 1e-9


def test_unusable_vectors(spark):
    rows = random_rows(50, 5)
    bad = [(900, None), (901, [1.0, None, 2.0, 3.0, 4.0]), (902, [math.nan] * 5), (903, [math.inf, 0.0, 0.0, 0.0, 0.0]), (904, []),
           (905, [-math.inf, 0.0, 0.0, 0.0, 0.0]), (906, [1.0, 2.0])]
    same = [(None, rows[3][1]), (7, rows[7][1])]
    got = whiten.whiten(table(spark, rows + bad + same).withColumn("x", bad_column()).withColumn("id", bad_column())).collect()
    assert {r.vec_id for r in got} == {*range(50), None} and len(got) == 52 * 4
    check([r for r in got if r.vec_id not in (None, 7)], {k: v for k, v in brute(rows).items() if k[0] != 7})


def bad_column():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_few_dimensions_and_no_rows(spark):
    line = [(i, [float(i), 2.0 * i, 0.5]) for i in range(20)]
    got = whiten.whiten(table(spark, line)).collect()
    assert {r.component for r in got} == {1} and {round(r.explained, 12) for r in got} == {1.0}
    for rows in ([], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]):
        assert whiten.whiten(table(spark, rows)).collect() == []


def test_huge_entries_are_exact(spark):
    rows = [(i, [float(3**i), float(-(2**i)), float(i)]) for i in range(30)]
    got = whiten.whiten(table(spark, rows, "double")).collect()
    want = brute(rows)
    for r in got:
        deviation = want[r.vec_id, r.component][1]
        assert r.deviation == (deviation if deviation < 1 << 63 else None)
    assert any(r.deviation is None for r in got)
    unfit = [*rows, (99, [1e300, 0.0, 0.0])]
    assert {r.vec_id for r in whiten.whiten(table(spark, unfit, "double")).collect()} == set(range(30))
