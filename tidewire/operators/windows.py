"""Ordered groups: ranks for enrichment, running budgets, carry-forward, slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COOL_DOWN = "INTERVAL 7 DAYS"
PER_SPORT, PER_SCHOOL = 5, 24


def needs_enrichment(observed_at: Column) -> Column:
    """No image or no author, and never checked or at least seven days ago."""
    due = F.col("metadata_checked_at").isNull() | (F.col("metadata_checked_at") <= observed_at - F.expr(COOL_DOWN))
    return (F.col("image_url").isNull() | F.col("author").isNull()) & due


def enrichment_rank(candidates: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """Never checked first, then those without image, then by position."""
    order = [F.col("metadata_checked_at").isNotNull(), F.col("image_url").isNotNull(), F.col(pos)]
    return candidates.withColumn("enrich_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))


def running_budget(
    programs: DataFrame, school: str, order: list[Column], wanted: str, each: int = PER_SPORT, total: int = PER_SCHOOL
) -> DataFrame:
    """What each program may use when those before it have taken theirs."""
    asked = F.least(F.col(wanted), F.lit(each))
    before = Window.partitionBy(school).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(asked).over(before), F.lit(0))
    return programs.withColumn("budget", F.greatest(F.lit(0), F.least(asked, F.lit(total) - taken)))


def first_candidates(rows: DataFrame, keys: list[str], url: str, at: str, k: int = 10) -> DataFrame:
    """The k newest distinct URLs per program."""
    distinct = rows.groupBy(*keys, url).agg(F.max(at).alias(at))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(at).desc(), url))
    return distinct.withColumn("r", rank).where(F.col("r") <= k).drop("r")


def carry_forward(rows: DataFrame, keys: list[str], pos: str, value: str, name: str) -> DataFrame:
    """The last header at or before each row."""
    so_far = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(so_far))


def latest_slot(at: Column, minutes: list[int]) -> Column:
    """The latest of the day's slots (minutes after midnight, UTC) that is due at ``at``."""
    day = F.date_trunc("day", at)
    due = [
        F.timestamp_seconds(F.unix_seconds(day) + F.lit(60 * m - 86_400 * back)) for m in minutes for back in (0, 1)
    ]
    return F.array_max(F.filter(F.array(*due), lambda d: d <= at))
