"""Chat formatting with cumulative-snapshot collapse, with DataFrame functions only.

Logged conversations are often snapshots: the same dialogue saved again after
every turn.  A conversation is dropped if all its turns are the first turns of a
longer one; of conversations with the same turns the largest id stays.  What is
left is rendered as one text.

Every turn-prefix gets a rolling hash: the running sums, over the turns in order,
of two 60-bit parts of SHA-256(position, role, text).  The position is hashed,
so such a sum identifies an ordered prefix; it needs one streaming window and no
list of turns.  Texts are not moved for this: only hashes are, and the texts of
the conversations that stay are shuffled once, for rendering.

Hot prefixes (a first turn that a third of all conversations share) are
de-duplicated before the shuffle, and conversations with equal turns are
aggregated to one row before the anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN_OPEN, TURN_CLOSE = "<|im_start|>", "<|im_end|>"


def _turn_sha(role: Column, text: Column) -> Column:
    """SHA-256 of a turn; a null role or text differs from an empty one."""
    part = lambda c: F.when(c.isNull(), F.lit("-")).otherwise(
        F.concat(F.char_length(c).cast("string"), F.lit(":"), c)
    )
    return F.sha2(F.concat(part(role), part(text)).cast("binary"), 256)


def _sixty_bits(sha: Column, first: int) -> Column:
    return F.conv(F.substring(sha, first, 15), 16, 10).cast("decimal(38,0)")


def turn_prefixes(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """A row per turn: conv, k (its place from 1), h1, h2 (hash of the first k turns)."""
    light = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), _turn_sha(F.col(role), F.col(text)).alias("sha")
    )
    order = Window.partitionBy("conv").orderBy("turn", "sha")
    placed = light.withColumn("k", F.row_number().over(order))
    sha = F.sha2(F.concat_ws(":", F.col("k").cast("string"), F.col("sha")).cast("binary"), 256)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.withColumn("at", sha).select(
        "conv",
        "k",
        F.sum(_sixty_bits(F.col("at"), 1)).over(running).alias("h1"),
        F.sum(_sixty_bits(F.col("at"), 16)).over(running).alias("h2"),
    )


def maximal_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Conversations that no other one repeats or continues: conv, n_turns, n_copies.

    Rows with a null conversation id belong to no conversation and are left out.
    A null turn comes before all numbered ones; turns with the same number are ordered by the hash of their role and
    text; repeated rows count as turns of their own.  Of a conversation only hashes of its turns come together here, so a
    very long one costs some bytes a turn; its texts come together when it is rendered.  Other columns are not read.
    An empty table gives no rows.
    """
    prefixes = turn_prefixes(turns.where(F.col(conv).isNotNull()), conv, turn, role, text)
    last = Window.partitionBy("conv")
    marked = prefixes.withColumn("n", F.max("k").over(last))
    whole = (
        marked.where("k = n")
        .groupBy("k", "h1", "h2")
        .agg(F.max("conv").alias("conv"), F.count("*").alias("n_copies"))
    )
    inner = marked.where("k < n").select("k", "h1", "h2").distinct()
    return whole.join(inner, ["k", "h1", "h2"], "left_anti").select(
        F.col("conv").alias(conv), F.col("k").cast("bigint").alias("n_turns"), "n_copies"
    )


def render_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The maximal conversations with their rendered ``text``.

    Each turn becomes an opening mark with the role, a line break, the text and a
    closing mark with a line break; a null role or text is rendered as empty.
    """
    kept = maximal_conversations(turns, conv, turn, role, text)
    said = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv),
        F.struct(
            F.col(turn).alias("turn"),
            _turn_sha(F.col(role), F.col(text)).alias("sha"),
            F.concat(
                F.lit(TURN_OPEN),
                F.coalesce(F.col(role), F.lit("")),
                F.lit("\n"),
                F.coalesce(F.col(text), F.lit("")),
                F.lit(TURN_CLOSE + "\n"),
            ).alias("shown"),
        ).alias("said"),
    )
    return (
        said.join(kept, conv)
        .groupBy(conv, "n_turns", "n_copies")
        .agg(F.array_join(F.array_sort(F.collect_list("said"))["shown"], "").alias("text"))
    )
