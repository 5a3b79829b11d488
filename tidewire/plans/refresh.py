"""The refresh of all programs' news as one plan: parse, filter, merge per source, fold to programs, keep the last good."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.dates import not_future, publication_date
from tidewire.functions.text import clean_author, clean_text
from tidewire.functions.urls import canonical_url, safe_url
from tidewire.operators import merge, state

KEYS = ["school", "sport"]
SOURCE = [*KEYS, "source_url"]
RECORD = [
    "url", "title", "published_at", "published_at_precision", "publisher", "discovery_source_url", "image_url", "image_alt", "author",
    "metadata_checked_at",
]


def feed_records(items: DataFrame, context: list[str], observed_at: Column) -> DataFrame:
    """Article records of parsed feed items (R4): cleaned, dated, safe, the last of each URL; descriptions are for routing only."""
    date = publication_date(F.col("published"))
    rows = items.where("pos >= 0").select(
        *context, "pos", safe_url(F.col("url")).alias("url"), clean_text(F.col("title")).alias("title"), date["at"].alias("published_at"),
        date["precision"].alias("published_at_precision"), safe_url(F.col("image_url")).alias("image_url"),
        F.nullif(clean_text(F.col("image_alt")), F.lit("")).alias("image_alt"), clean_author(F.col("author")).alias("author"),
    )
    rows = rows.where(F.col("url").isNotNull() & (F.col("title") != "") & not_future(F.col("published_at"), observed_at))
    return merge.unique_by_id(rows.withColumn("url", canonical_url(F.col("url"))), [*context, "url"])


def refresh_news(sources: DataFrame, fetched: DataFrame, prior: DataFrame, prior_state: DataFrame, observed_at: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(articles, source states, program states) after one attempt (R2).

    sources: school, sport, source_url, source_order, error, empty_confirmed, publisher.
    fetched: school, sport, source_url, pos and record fields.  prior: the same of the run before, by
    discovery source.  prior_state: school, sport, source_url, last_success_at, record_count.
    """
    fresh = fetched.where(not_future(F.col("published_at"), observed_at))
    n_fresh = fresh.groupBy(*SOURCE).agg(F.count("*").alias("fresh"))
    n_all = fetched.groupBy(*SOURCE).agg(F.count("*").alias("parsed"))
    before = prior_state.select(*SOURCE, F.col("last_success_at").alias("prior_success_at"), F.col("record_count").alias("prior_rows"))
    attempts = sources.join(n_fresh, SOURCE, "left").join(n_all, SOURCE, "left").join(before, SOURCE, "left").select(
        *SOURCE, "source_order", observed_at.alias("at"), "error", "empty_confirmed", F.coalesce("fresh", F.lit(0)).alias("fresh"),
        F.when(F.coalesce("parsed", F.lit(0)) > F.coalesce("fresh", F.lit(0)), "future-article-dates-filtered").alias("reason"),
        "prior_success_at", F.when(F.col("prior_success_at").isNotNull(), F.col("source_url")).alias("prior_source_url"), "prior_rows",
    )
    # whether an attempt counts is decided on what it brought, what it then holds on what was merged
    decided = state.refreshed(attempts.withColumn("n_rows", F.col("fresh")))
    good = decided.where(F.col("last_success_at").eqNullSafe(F.col("last_attempt_at"))).select(*SOURCE)
    kept = decided.where("status = 'stale'").select(*SOURCE)
    old = prior.withColumn("discovery_source_url", F.col("source_url"))
    new = fresh.withColumn("discovery_source_url", F.col("source_url"))
    both = old.withColumn("age", F.lit(0)).unionByName(new.withColumn("age", F.lit(1)), allowMissingColumns=True)
    # the order within a source: prior records first, then those of the attempt
    both = both.withColumn("pos", F.struct("age", "pos"))
    per_source = merge.merge_news(both.join(good, SOURCE, "left_semi"), SOURCE)
    stale = old.join(kept, SOURCE, "left_semi").withColumn("rank", F.col("pos").cast("bigint"))
    rows = per_source.select(*SOURCE, *RECORD, "rank").unionByName(stale.select(*SOURCE, *RECORD, "rank"))
    counts = rows.groupBy(*SOURCE).agg(F.count("*").alias("held"))
    states = decided.join(counts, SOURCE, "left").withColumn("record_count", F.coalesce("held", F.lit(0))).drop("held", "n_rows")
    states = states.withColumn("status", F.when((F.col("status") == "empty") & (F.col("record_count") > 0), "ok").otherwise(F.col("status")))
    ordered = rows.join(sources.select(*SOURCE, "source_order"), SOURCE).withColumn("pos", F.struct("source_order", "rank"))
    articles = merge.merge_news(ordered, KEYS)
    n = articles.groupBy(*KEYS).agg(F.count("*").alias("n_records"))
    return articles, states, state.collection_state(states, KEYS, "source_order", n)
