"""Continuous merging: a stream of article records is folded into versioned snapshots.

The merge of the batch plan is associative over (snapshot, new records), so each micro-batch is one
publication.  A batch that is run again after a failure finds its number in the pointer and does nothing, so a
stream keeps one checkpoint for its root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire import publish
from tidewire.functions.urls import safe_url
from tidewire.operators import merge


def merge_into(spark: SparkSession, root: str, batch: DataFrame, keys: list[str], number: int | None = None) -> str:
    """One publication of the snapshot's articles merged with the batch's; a batch whose number is published already does nothing."""
    store = publish.Store(spark, root)
    parent = publish.current_version(store)
    if number is not None and parent is not None and number <= publish.published_batch(store):
        return parent
    fields = [c for c in batch.columns if c not in (*keys, "pos")]
    new = batch.where(safe_url(F.col("url")).isNotNull()).withColumn("pos", F.struct(F.lit(1).alias("age"), F.col("pos").cast("bigint").alias("pos")))
    if parent is not None:
        old = publish.read_version(spark, root, "articles", parent)
        old = old.select(*keys, *fields, F.struct(F.lit(0).alias("age"), F.col("rank").cast("bigint").alias("pos")).alias("pos"))
        new = old.unionByName(new.select(*keys, *fields, "pos"))
    merged = merge.merge_news(new, keys).drop("first_pos", "last_pos")
    return publish.publish(spark, root, {"articles": merged}, parent, batch=number)


def start(stream: DataFrame, root: str, keys: list[str], checkpoint: str, **options: str) -> StreamingQuery:
    """Fold a stream of records into the snapshots under ``root``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        merge_into(batch.sparkSession, root, batch, keys, batch_id)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    for key, value in options.items():
        writer = writer.option(key, value)
    return writer.trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, at: str = "ts", key: str = "event_type", size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Records per window and source, with a bound on lateness."""
    return stream.withWatermark(at, late).groupBy(F.window(at, size), key).agg(F.count("*").alias("n"))
