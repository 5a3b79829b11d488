"""Recruiting lists: sections carried to their rows, totals reconciled, ratings read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.dates import optional_number
from tidewire.operators.classify import recruiting_status
from tidewire.operators.windows import carry_forward

MAX_ROWS = 1000


def listed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``sources.parsers.sections`` with the heading above them: section, declared, status."""
    heads = rows.withColumn("h", F.when(F.col("kind") == "heading", F.struct("text", "declared")))
    told = carry_forward(heads, keys, "pos", "h", "head").where("kind = 'row'")
    section = F.trim(F.regexp_replace("head.text", r"\s*\(\d{1,4}\)\s*$", ""))
    return told.select(
        *keys, "pos", "text", "href", section.alias("section"), F.col("head.declared").cast("int").alias("declared"),
        F.regexp_extract("href", r"/player/[^/?#]*?-?(\d+)(?:[/?#]|$)", 1).alias("player_id"),
    ).withColumn("status", recruiting_status(F.col("section")))


def reconciled(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per document: whether each section has the rows that it declares, and no player twice with other text."""
    per = rows.groupBy(*keys, "section").agg(F.count("*").alias("n"), F.max("declared").alias("declared"))
    sums = per.groupBy(*keys).agg(
        F.bool_and(F.col("declared").isNull() | (F.col("n") == F.col("declared"))).alias("counts_agree"), F.sum("n").alias("rows")
    )
    players = rows.groupBy(*keys, "player_id").agg(F.count("*").alias("n"), F.count_distinct("text").alias("texts"))
    twice = players.groupBy(*keys).agg(
        F.sum(F.col("n") - F.col("texts")).alias("repeated"), F.count_if(F.col("texts") > 1).alias("conflicts")
    )
    out = sums.join(twice, keys)
    return out.withColumn("ok", F.col("counts_agree") & (F.col("conflicts") == 0) & (F.col("rows") <= MAX_ROWS))


def ranks(text: Column) -> Column:
    """National, position and state rank and the state of a row's ranking line (P20)."""
    number = lambda pattern: optional_number(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")), 100_000).cast("int")
    # the state stands behind the position, whose rank looks like one
    behind = F.regexp_replace(text, r"(?i)^.*?\b(?:Pos|[A-Z]{1,4})\.?\s*#\d+", "")
    of_state = lambda i: F.nullif(F.regexp_extract(behind, r"\b([A-Z]{2})\s+#?(\d+)\s*$", i), F.lit(""))
    return F.struct(
        number(r"(?i)\bNatl?\.?\s*#?(\d+)").alias("national_rank"),
        number(r"(?i)\b(?:Pos|[A-Z]{1,4})\.?\s*#(\d+)").alias("position_rank"),
        optional_number(of_state(2), 100_000).cast("int").alias("state_rank"),
        of_state(1).alias("ranking_state"),
    )


def continued(sections: DataFrame, shown: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """Sections of an offers list with their rows (P18): keys, section, rows, whole.

    sections: keys, section, declared; shown, more: keys, section, player_id, of the list and of the sections' continuations.
    A continuation takes the place of what the list shows of its section; one that lacks a row shown first is not whole.
    """
    n_more = more.groupBy(*keys, "section").agg(F.count("*").alias("n_more"))
    n_shown = shown.groupBy(*keys, "section").agg(F.count("*").alias("n_shown"))
    lost = shown.join(n_more, [*keys, "section"]).join(more.select(*keys, "section", "player_id").distinct(), [*keys, "section", "player_id"], "left_anti")
    lost = lost.groupBy(*keys, "section").agg(F.count("*").alias("n_lost"))
    out = sections
    for part in (n_more, n_shown, lost):
        out = out.join(part, [*keys, "section"], "left")
    rows = F.coalesce("n_more", "n_shown", F.lit(0))
    return out.select(*keys, "section", "declared", rows.alias("rows"), ((rows == F.col("declared")) & F.col("n_lost").isNull()).alias("whole"))


#: Fields of a recruit that a source may leave out.
OPTIONAL = ("profile_url", "image_url", "school_name", "hometown", "rating", "rating_system", "stars", "national_rank", "position_rank", "state_rank", "ranking_state", "ranking_group")


def with_defaults(rows: DataFrame) -> DataFrame:
    """Recruits with every optional field, null where the source has none."""
    return rows.select("*", *(F.lit(None).cast("string").alias(c) for c in OPTIONAL if c not in rows.columns))
