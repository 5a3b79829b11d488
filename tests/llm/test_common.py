import time
import tracemalloc

import numpy as np

from tidewire.llm import langid
from tidewire.llm._common import CLEANUP, Scratch


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_a_saved_table_leaves_no_shuffle_files(spark):
    held = spark.conf.get(CLEANUP)
    rows = spark.range(2000).selectExpr("id", "id % 7 as k").repartition(4, "k")  # held here, so that no collector clears it
    before = _shuffle_files(spark)
    table = Scratch(spark, "test").save(rows.join(rows.groupBy("k").count().hint("merge"), "k"), "joined")
    for _ in range(100):
        new = _shuffle_files(spark) - before
        if not new:
            break
        time.sleep(0.1)
    assert not new
    assert spark.conf.get(CLEANUP) == held
    assert table.count() == 2000


def test_rows_of_the_sample_are_made_a_few_at_a_time():
    n, each = 4000, 300
    offsets = np.arange(n + 1) * each
    buckets = np.tile(np.arange(each, dtype=np.int16), n)
    counts = np.ones(n * each, np.int32)
    idf = np.ones(langid.BUCKETS, np.float32)
    tracemalloc.start()
    try:
        x = langid.Rows.of(offsets, buckets, counts, idf)
        assert tracemalloc.get_traced_memory()[1] < 2 * x.values.nbytes
    finally:
        tracemalloc.stop()
    assert np.allclose(x.dense(np.array([0, n - 1]))[:, :each], each**-0.5)
