"""Running sums and greedy packing of an ordered table of any size.

A running sum over all rows needs no window without a partition: the rows are cut into ranges of their order, each range is summed up
by itself, and only the sums of the ranges, whose number is fixed, are added up in one place.

Greedy packing is a fold that looks sequential, since where a chunk begins depends on where the one before has ended.  But where a chunk
that begins at a given row ends depends on that row alone.  So every row finds its successor, the first row that no longer fits, in the
running sums; and the chunks that really begin are the rows that the first one reaches along the successors, found by doubling the
reach in each round.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.scratch import shared_root


def cut_by_range(rows: DataFrame, order: list[str], ranges: int | None = None) -> DataFrame:
    """Rows with ``__range``, the number of their range in an order, kept in the checkpoint folder; equal rows share a range."""
    spark = rows.sparkSession
    shared_root(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()).checkpoint()


def running(rows: DataFrame, order: list[str], sums: dict[str, Column], ranges: int | None = None) -> DataFrame:
    """Rows with the running sums, including their own value, in a total order.

    There are as many ranges as shuffles have partitions; their sums are added up in one task.  They are cut once and kept in the
    checkpoint folder, so that both passes over them see the same ones.
    """
    valued = rows.withColumns({f"__{n}": F.coalesce(v, F.lit(0)) for n, v in sums.items()})
    cut = cut_by_range(valued, order, ranges)
    totals = cut.groupBy("__range").agg(*(F.sum(f"__{n}").alias(n) for n in sums))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__range", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__before_{n}") for n in sums))
    within = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = cut.join(totals, "__range").withColumns({n: F.sum(f"__{n}").over(within) + F.col(f"__before_{n}") for n in sums})
    return out.drop("__range", *(f"__{n}" for n in sums), *(f"__before_{n}" for n in sums))


def successors(rows: DataFrame, most: int) -> DataFrame:
    """at, next: for each row the first later one that begins a new chunk if this one does; null at the end.

    rows: at (1, 2, …), size, alone (begins a chunk and counts nothing), total (the running sum of sizes).  Sums lie in cells as wide as a
    chunk; since no row is larger than a chunk, the successor lies in the cell of the sum that is too much or in the one behind it.
    """
    cell = lambda c: F.floor(c / F.lit(most)).cast("bigint")
    limit = F.col("total") - F.col("size") + most
    asks = rows.select(cell(limit).alias("cell"), limit.alias("value"), F.lit(1).alias("kind"), "at")
    sums = rows.select(cell(F.col("total")).alias("cell"), F.col("total").alias("value"), F.lit(0).alias("kind"), "at")
    # of equal values the sums come first, since only a larger one is too much; of equal sums the first row counts
    least = Window.partitionBy("cell").orderBy("value", "kind", "at").rowsBetween(1, Window.unboundedFollowing)
    found = asks.unionByName(sums).withColumn("over", F.first(F.when(F.col("kind") == 0, F.col("at")), True).over(least))
    heads = sums.groupBy(F.col("cell").alias("behind")).agg(F.min("at").alias("head"))
    over = found.where("kind = 1").join(heads, F.expr("cell + 1 = behind"), "left").select("at", F.coalesce("over", "head").alias("over"))
    # the next row that must begin a chunk anyway, by the same two levels
    forced = _next_alone(rows)
    return over.join(forced, "at").select("at", F.least("over", "alone_at").alias("next"))


def _next_alone(rows: DataFrame) -> DataFrame:
    """at, alone_at: the next later row that is alone."""
    width = 4096
    block = F.floor(F.col("at") / width).cast("bigint")
    r = rows.select("at", block.alias("block"), F.when(F.col("alone"), F.col("at")).alias("a"))
    later = Window.partitionBy("block").orderBy("at").rowsBetween(1, Window.unboundedFollowing)
    firsts = r.groupBy("block").agg(F.min("a").alias("first"))
    blocks = firsts.withColumn("group", F.floor(F.col("block") / width))
    in_group = Window.partitionBy("group").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    groups = blocks.groupBy("group").agg(F.min("first").alias("group_first"))
    after = Window.orderBy("group").rowsBetween(1, Window.unboundedFollowing)
    groups = groups.select("group", F.first("group_first", True).over(after).alias("in_later_group"))
    blocks = blocks.withColumn("in_later_block", F.first("first", True).over(in_group)).join(groups, "group")
    own = r.withColumn("own", F.first("a", True).over(later))
    return own.join(blocks.select("block", "in_later_block", "in_later_group"), "block").select("at", F.coalesce("own", "in_later_block", "in_later_group").alias("alone_at"))


def reached(links: DataFrame, first: int, steps: int) -> DataFrame:
    """at: the rows that ``first`` reaches along at → next in at most ``steps`` steps.  Each round doubles how far."""
    known = links.where(F.col("at") == first).select("at")
    jump = links.where("next is not null")
    for _ in range(max(math.ceil(math.log2(steps + 1)), 1)):
        known = known.unionByName(known.join(jump, "at").select(F.col("next").alias("at"))).checkpoint()
        far = jump.select(F.col("at").alias("next"), F.col("next").alias("far"))
        jump = jump.join(far, "next").select("at", F.col("far").alias("next")).checkpoint()
        if jump.isEmpty():
            break
    return known.distinct()


def greedy_chunks(rows: DataFrame, order: list[str], size: str, most: int) -> DataFrame:
    """Rows with ``chunk`` (from 0), as one packs them in their order: a row that no longer fits begins the next chunk.

    A row larger than ``most`` is sent by itself beforehand: it begins a chunk, in which it takes no room.  ``order`` must be total; a null
    size is none; an empty table gives no rows.
    """
    big = F.coalesce(F.col(size) > most, F.lit(False))
    own = F.when(big, 0).otherwise(F.coalesce(F.col(size), F.lit(0))).cast("bigint")
    placed = running(rows.withColumn("__own", own).withColumn("__alone", big), order, {"__total": F.col("__own"), "__at": F.lit(1).cast("bigint")}).checkpoint()
    flat = placed.select(F.col("__at").alias("at"), F.col("__own").alias("size"), F.col("__alone").alias("alone"), F.col("__total").alias("total"))
    # each chunk but the last is more than half full together with its successor, or ends at a row that is alone
    ends = flat.agg(F.max("total").alias("total"), F.count_if("alone").alias("alone")).first()
    steps = 2 * ((ends["total"] or 0) // most + 1) + 2 * ends["alone"] + 1
    starts = reached(successors(flat, most), 1, steps).withColumn("starts", F.lit(1))
    marked = placed.join(starts.withColumnRenamed("at", "__at"), "__at", "left")
    out = running(marked, ["__at"], {"chunk": F.col("starts").cast("bigint")})
    return out.withColumn("chunk", F.col("chunk") - 1).drop("__own", "__alone", "__total", "__at", "starts")
