"""Exact dedup by deterministic block naming, with DataFrame functions only.

A text is cut into blocks of ``block_chars`` characters.  Sorting the blocks
gives each distinct block an integer name; then adjacent pairs of names are
sorted and named in turn, which halves the sequence, until one name is left.
Two documents of the same depth have the same last name exactly if their texts
are equal: a name stands for one content, never for a hash of it.

The 64-bit key of a block only spreads and orders the sort.  Where two contents
share a key they get ranks by their own order, so a collision of keys costs time
and never a wrong name.  Names of different depths are kept apart by the depth.

Block contents are shuffled once (combined on the map side, so thousands of
copies of a block leave a partition as one row); everything else moves integers.
The joins that give names back are plain equi-joins, which adaptive execution
splits where a third of all rows share one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm._common import Scratch, fresh, one_of_each, text_or_empty

BLOCK_CHARS = 16_384


def _named(rows: DataFrame, keys: list[str], scratch: Scratch, table: str) -> DataFrame:
    """``rows`` with an integer ``name``: the place of its ``keys`` in sorted order."""
    ids = scratch.save(
        rows.select(*keys).distinct().orderBy(*keys).withColumn("name", F.monotonically_increasing_id()), table
    )
    return rows.join(ids, keys)


def _block_ranks(blocks: DataFrame, scratch: Scratch) -> DataFrame | None:
    """Ranks (key, content, rank) of contents that share a key with others, or None if no key is shared."""
    shared = scratch.save(
        blocks.groupBy("key")
        .agg(F.min("content").alias("lo"), F.max("content").alias("hi"))
        .where("lo <> hi")
        .select("key"),
        "shared_keys",
    )
    if shared.isEmpty():
        return None
    contents = blocks.join(shared, "key").select("key", "content").distinct()
    order = Window.partitionBy("key").orderBy("content")
    return scratch.save(contents.withColumn("rank", F.row_number().over(order).cast("bigint")), "ranks")


def block_names(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    key: Column | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """One row per row of ``docs``: uid, id, sha256, depth, name.

    ``key`` is a function of the column ``content`` that orders the sort
    (default: xxhash64); tests pass a weak one so that keys collide.
    A null text is the empty text.  ``uid`` numbers the rows, so repeated rows
    and null ids stay apart.
    """
    scratch = scratch or Scratch(docs.sparkSession, "blocks")
    key = F.xxhash64("content") if key is None else key
    text = F.col("__t")
    n_blocks = F.greatest(F.ceil(F.char_length(text) / F.lit(block_chars)), F.lit(1)).cast("int")
    cut = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("__t")).select(
        F.monotonically_increasing_id().alias("uid"),
        "id",
        "__t",
        F.transform(
            F.sequence(F.lit(0), n_blocks - 1),
            lambda i: F.substring(text, i * block_chars + 1, F.lit(block_chars)),
        ).alias("parts"),
    )
    blocks = cut.select(F.explode("parts").alias("content")).select("content", key.alias("key"))
    ranks = _block_ranks(blocks, scratch)
    occurrences = cut.select(
        "uid",
        "id",
        F.sha2(F.col("__t").cast("binary"), 256).alias("sha256"),
        F.size("parts").alias("n"),
        F.posexplode("parts").alias("pos", "content"),
    ).select("uid", "id", "sha256", "n", "pos", "content", key.alias("key"))
    if ranks is None:
        occurrences = occurrences.drop("content").withColumn("rank", F.lit(0).cast("bigint"))
    else:
        occurrences = occurrences.join(ranks, ["key", "content"], "left").drop("content").fillna(0, ["rank"])
    occurrences = scratch.save(occurrences, "occurrences")

    done = None
    depth = 0
    rows = _named(occurrences, ["key", "rank"], scratch, "names_0").select("uid", "id", "sha256", "n", "pos", "name")
    while True:
        rows = scratch.save(rows, f"level_{depth}")
        last = rows.where("n = 1").select("uid", "id", "sha256", F.lit(depth).alias("depth"), "name")
        done = last if done is None else done.unionByName(last)
        more = rows.where("n > 1")
        if more.isEmpty():
            scratch.keep(*(f"level_{i}" for i in range(depth + 1)))
            return done
        depth += 1
        pairs = (
            more.groupBy("uid", F.expr("pos div 2").cast("int").alias("pos"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left_name"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right_name"),
                F.first("id").alias("id"),
                F.first("sha256").alias("sha256"),
                F.first("n").alias("m"),
            )
            .withColumn("n", F.expr("(m + 1) div 2").cast("int"))
        )
        rows = _named(pairs, ["left_name", "right_name"], scratch, f"names_{depth}").select(
            "uid", "id", "sha256", "n", "pos", "name"
        )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays (a null id is the smallest);
    of repeated rows with that id, one.  An empty table gives no rows.
    """
    names = block_names(docs, id_col, text_col, **options)
    best = names.groupBy("depth", "name").agg(
        F.max(F.struct("id", "uid")).alias("best"), F.count("*").alias("group_size")
    )
    return names.join(best, ["depth", "name"]).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.col("best.uid")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text, all its columns unchanged.

    Of repeated rows with other values in further columns, the one whose further columns come first as JSON stays.
    """
    kept = exact_groups(docs, id_col, text_col).where("kept")
    sha, kid, ksha = (fresh(docs, x) for x in ("__sha", "__kid", "__ksha"))
    kept = kept.select(F.col(id_col).alias(kid), F.col("text_sha256").alias(ksha))
    keyed = docs.withColumn(sha, F.sha2(text_or_empty(text_col).cast("binary"), 256))
    same = keyed[id_col].eqNullSafe(kept[kid]) & (keyed[sha] == kept[ksha])
    return one_of_each(keyed.join(kept, same, "left_semi"), docs, id_col, text_col, sha)
