"""Dataset state: what a source's attempt, its rows and the state before it come to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEGRADED = ("stale", "unavailable")


def refreshed(attempts: DataFrame) -> DataFrame:
    """The state of each source after an attempt.

    attempts: keys..., at, source_url, error (null: fetched and parsed), n_rows, empty_confirmed,
    season, reason, and of the state before: prior_success_at, prior_source_url, prior_rows.
    An unconfirmed empty result does not erase known rows; a failure keeps the last good
    state of the same source as stale, and is unavailable otherwise.
    """
    unexpected = (F.col("n_rows") == 0) & (F.coalesce("prior_rows", F.lit(0)) > 0) & ~F.coalesce("empty_confirmed", F.lit(False))
    error = F.coalesce(F.col("error"), F.when(unexpected, "unexpected-empty-source"))
    keeps = F.col("prior_success_at").isNotNull() & F.col("prior_source_url").eqNullSafe(F.col("source_url"))
    failed = F.col("failure").isNotNull()
    return (
        attempts.withColumn("failure", error)
        .withColumn(
            "status",
            F.when(failed & keeps, "stale").when(failed, "unavailable").when(F.col("n_rows") > 0, "ok").otherwise("empty"),
        )
        .withColumn("last_success_at", F.when(~failed, F.col("at")).when(keeps, F.col("prior_success_at")))
        .withColumn("reason", F.when(failed, F.col("failure")).otherwise(F.col("reason")))
        .withColumn(
            "record_count",
            F.when(~failed, F.col("n_rows")).when(keeps, F.coalesce("prior_rows", F.lit(0))).otherwise(0),
        )
        .withColumnRenamed("at", "last_attempt_at")
        .drop("failure", "error")
    )


def status_fold(any_success: Column, any_degraded: Column, n_records: Column) -> Column:
    """The state of a collection from those of its sources."""
    return F.when(~any_success, "unavailable").when(any_degraded, "stale").when(n_records > 0, "ok").otherwise("empty")


def collection_state(sources: DataFrame, keys: list[str], order: str, records: DataFrame | None = None) -> DataFrame:
    """Per program: status, the oldest of its sources' last successes, the first source.

    ``records`` (keys..., n_records) has the rows after merging across sources; without
    it the sources' own counts are summed.
    """
    out = sources.groupBy(*keys).agg(
        F.bool_or(F.col("last_success_at").isNotNull()).alias("any_success"),
        F.bool_or(F.col("status").isin(*DEGRADED)).alias("any_degraded"),
        F.min("last_success_at").alias("last_success_at"),
        F.min_by("source_url", order).alias("source_url"),
        F.sum("record_count").alias("source_records"),
    )
    if records is not None:
        out = out.join(records, keys, "left")
        n = F.coalesce("n_records", F.lit(0))
    else:
        n = F.col("source_records")
    reason = F.when(F.col("any_degraded"), "one-or-more-news-sources-degraded")
    return out.withColumn("n_records", n).select(
        *keys, status_fold(F.col("any_success"), F.col("any_degraded"), F.col("n_records")).alias("status"),
        "last_success_at", "source_url", reason.alias("reason"), "n_records",
    )


def disabled_refresh(prior_success_at: Column) -> tuple[Column, Column]:
    """Status and reason of a collection that a news-only run leaves as it was."""
    known = prior_success_at.isNotNull()
    return (
        F.when(known, "stale").otherwise("unavailable"),
        F.when(known, "refresh-disabled-news-only").otherwise("disabled-news-only"),
    )


def empty_dataset(at: Column, status: Column, reason: Column, source_url: Column) -> Column:
    """An envelope without records."""
    none = F.lit(None)
    return F.struct(
        status.alias("status"), at.alias("last_attempt_at"), none.cast("timestamp").alias("last_success_at"), source_url.alias("source_url"),
        none.cast("string").alias("season"), reason.alias("reason"), F.array().cast("array<string>").alias("records"),
    )
