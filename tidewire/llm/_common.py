"""Helpers that several corpus operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whether the files of a query's shuffles are deleted as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a fresh one where it is unset and all runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="tidewire-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files behind.

    Otherwise they stay until the driver happens to collect its garbage, so that the disk of an operator with many
    steps is the sum of its shuffles, not the largest one.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


class Scratch:
    """Tables of one operator call, written to the shared folder so that lost executors cost no result.

    ``save`` cuts the lineage: what follows reads a committed Parquet table, and the shuffles behind it are deleted.  The
    tables hold mostly hashes, which don't compress, and compressors keep memory
    outside the heap for each file, so they are written plainly unless told otherwise.
    Tables far smaller than what they are made from are saved with ``few`` files: a few for each slot of the
    cluster instead of one for each partition of the shuffle, whose number follows the large tables.
    """

    FILES_PER_SLOT = 3

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.names: set[str] = set()

    def save(self, df: DataFrame, name: str, compression: str = "uncompressed", few: bool = False) -> DataFrame:
        schema = df.schema
        self.names.add(name)
        if few:
            df = df.coalesce(self.FILES_PER_SLOT * max(self.spark.sparkContext.defaultParallelism, 4))
        path = f"{self.path}/{name}"
        with passing_shuffles(self.spark):
            df.write.mode("overwrite").option("compression", compression).parquet(path)
        # the driver's plans and results of tasks up to here are garbage; its heap would grow to its bound before it collects them
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(schema).parquet(path)

    def save_parts(self, parts: Iterable[DataFrame], name: str, compression: str = "uncompressed", few: bool = False) -> DataFrame:
        """Parts with the same columns as one table; they are saved one after another, so the disk never holds the shuffles of two."""
        saved = [self.save(part, f"{name}-{i}", compression, few) for i, part in enumerate(parts)]
        return self.spark.read.schema(saved[0].schema).parquet(*(f"{self.path}/{name}-{i}" for i in range(len(saved))))

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.names.discard(name)

    def keep(self, *names: str) -> None:
        """Delete all tables but these: those that the result, which is read later, is made of."""
        for name in self.names - set(names):
            self.drop(name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text"):
    """Null counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def one_of_each(keyed: DataFrame, docs: DataFrame, id_col: str, text_col: str, sha: str) -> DataFrame:
    """One row per id and ``sha`` with the columns of ``docs``; of several, the one whose further columns come first as JSON."""
    key, found = fresh(keyed, "__key"), fresh(keyed, "__found")
    column = lambda c: F.col(f"`{c}`")
    others = [column(c) for c in docs.columns if c not in (id_col, text_col)]
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    first = F.min_by(F.struct(*map(column, docs.columns)), order)
    rows = keyed.groupBy(column(id_col).alias(key), sha).agg(first.alias(found))
    return rows.select(*(F.col(found)[c].alias(c) for c in docs.columns))
