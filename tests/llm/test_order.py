import random

from tidewire.llm._order import shards


def dealt(spark, rows, shard_bytes, parts=3):
    df = spark.createDataFrame(rows, "id bigint, sha string, n bigint").repartition(parts)
    deal, n = shards(df, shard_bytes)
    found = deal(df).collect()
    order = sorted(found, key=lambda r: (r.id is not None, r.id or 0, r.sha))
    assert [r.shard for r in order] == sorted(r.shard for r in found) and 0 <= order[0].shard and order[-1].shard < n
    sizes = {}
    for r in found:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.n
    return sizes, {(r.id, r.sha): r.shard for r in found}


def sha(r):
    return f"{r.getrandbits(160):040x}"


def test_even_shards_wherever_the_ids_are(spark):
    r = random.Random(3)
    tables = {
        "far": [(i, sha(r), 100) for i in range(2000)] + [(10**12, sha(r), 100)],
        "clusters": [(c * 10**15 + i, sha(r), 100) for c in (0, 1, 7, 8000) for i in range(500)],
        "extremes": [(-(2**63), sha(r), 100), (2**63 - 1, sha(r), 100), (None, sha(r), 100)] + [(i, sha(r), 100) for i in range(2000)],
        "one id": [(7, sha(r), 100) for _ in range(2000)],
    }
    for name, rows in tables.items():
        sizes, of = dealt(spark, rows, 5000)
        assert max(sizes.values()) <= 5000 and len(sizes) < 100, name
        assert dealt(spark, rows[::-1], 5000, 5)[1] == of, name


def test_equal_rows_and_no_rows(spark):
    sizes, _ = dealt(spark, [(1, "ab" * 20, 100)] * 50 + [(2, "cd" * 20, 100)], 300)
    assert sorted(sizes.values()) == [100, 5000]
    empty = spark.createDataFrame([], "id bigint, sha string, n bigint")
    deal, n = shards(empty, 300)
    assert n == 1 and deal(empty).columns == ["id", "sha", "n", "shard"]
