import random

import pytest
from pyspark.sql import functions as F

from tidewire.operators.packing import greedy_chunks, running


def folded(sizes, most):
    """The chunk of each entry, one after another."""
    out, chunk, held, entries = [], 0, 0, 0
    for size in sizes:
        size = size or 0
        if size > most:
            chunk, held, entries = chunk + (entries > 0), 0, 1
        else:
            if held + size > most:
                chunk, held, entries = chunk + 1, 0, 0
            held, entries = held + size, entries + 1
        out.append(chunk)
    return out


def sizes(kind):
    r = random.Random(kind)
    return {
        "random": [r.randrange(1, 60) for _ in range(700)], "tiny": [1] * 500, "exact": [50, 50] * 100, "just over": [51] * 120, "half and more": [50, 51] * 90,
        "all too large": [101 + i for i in range(40)], "mixed": [r.choice([0, 1, 49, 50, 51, 99, 100, 101, 500, None]) for _ in range(600)], "one": [7], "none": [],
        "long tail": [100] + [1] * 300 + [100, 101, 1, 1], "zeros": [0] * 100 + [100] + [0] * 100 + [1],
    }[kind]


@pytest.mark.parametrize("kind", ["random", "tiny", "exact", "just over", "half and more", "all too large", "mixed", "one", "none", "long tail", "zeros"])
def test_equals_the_fold(spark, kind):
    values = sizes(kind)
    df = spark.createDataFrame([(f"k{i:05}", s) for i, s in enumerate(values)], "path string, size bigint").repartition(3)
    got = [r.chunk for r in greedy_chunks(df, ["path"], "size", 100).orderBy("path").collect()]
    assert got == folded(values, 100)


def test_running_sums(spark):
    r = random.Random(1)
    rows = [(r.randrange(50), i, r.choice([None, r.randrange(-5, 9)])) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b int, v int").repartition(5)
    got = running(df, ["a", "b"], {"total": F.col("v"), "n": F.lit(1)}, ranges=7).orderBy("a", "b").collect()
    total = 0
    for n, ((a, b, v), x) in enumerate(zip(sorted(rows, key=lambda t: t[:2]), got, strict=True), 1):
        total += v or 0
        assert (x.a, x.b, x.v, x.total, x.n) == (a, b, v, total, n)
