"""Audits of state: per-program issues and warnings, counters, source groups, violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.dates import age_hours
from tidewire.operators.joins import missing

# How old what may be.
MAX_AGE_HOURS, REVIEW_AGE_DAYS, SKEW_HOURS = 12, 14, 5 / 60


def program_issues(status: Column, last_success_at: Column, generated_at: Column, n_sources: Column, now: Column) -> Column:
    """What is wrong with a program's news, as an array of texts."""
    seen, made = age_hours(last_success_at, now), age_hours(generated_at, now)
    return F.array_compact(
        F.array(
            F.when(~status.isin("ok", "empty"), F.concat(F.lit("news status: "), status)),
            F.when(seen.isNull(), "no successful news observation")
            .when(seen < -SKEW_HOURS, "news observation is in the future")
            .when(seen > MAX_AGE_HOURS, "news observation is overdue"),
            F.when(made.isNull() | (made < -SKEW_HOURS), "invalid snapshot observation time")
            .when(made > MAX_AGE_HOURS, "snapshot is overdue"),
            F.when(n_sources == 0, "no configured news source observations"),
        )
    )


def program_warnings(n_articles: Column, last_article_at: Column, now: Column) -> Column:
    """What a person should look at."""
    return F.array_compact(
        F.array(
            F.when(n_articles == 0, "no published articles")
            .when(last_article_at.isNull(), "article publication dates are unknown")
            .when(age_hours(last_article_at, now) > REVIEW_AGE_DAYS * 24, "publisher content age needs review")
        )
    )


def healthy_source(status: Column, last_success_at: Column, now: Column) -> Column:
    age = age_hours(last_success_at, now)
    return status.isin("ok", "empty") & F.coalesce((age >= -SKEW_HOURS) & (age <= MAX_AGE_HOURS), F.lit(False))


def news_metrics(records: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """Per program: articles, with images, the newest, whether it is stale."""
    out = records.groupBy(*keys).agg(
        F.count("*").alias("articles"),
        F.count_if(F.col("image_url").isNotNull()).alias("with_images"),
        F.max("published_at").alias("newest"),
    )
    return out.withColumn("needs_review", F.coalesce(age_hours(F.col("newest"), now) > REVIEW_AGE_DAYS * 24, F.lit(True)))


def source_groups(sources: DataFrame) -> DataFrame:
    """Programs per source address, state and reason (A3)."""
    return sources.groupBy("source_url", "status", F.coalesce("reason", F.lit("")).alias("reason")).agg(
        F.count("*").alias("programs")
    )


def totals(programs: DataFrame) -> DataFrame:
    """One row of counters over program rows."""
    return programs.agg(
        F.count("*").alias("checked_programs"),
        F.count_if(F.size("issues") == 0).alias("healthy_programs"),
        F.count_if(F.size("warnings") > 0).alias("programs_to_review"),
        F.coalesce(F.sum("articles"), F.lit(0)).alias("articles"),
        F.count_if(F.col("articles") == 0).alias("programs_without_articles"),
    )


def health_report(expected: DataFrame, programs: DataFrame, key: str) -> DataFrame:
    """The counters of a whole report, expected programs that are missing counted as errors.

    One aggregate over one full outer join.
    """
    both = programs.withColumn("told", F.lit(True)).join(expected.select(key).distinct().withColumn("wanted", F.lit(True)), key, "full_outer")
    told, wanted = F.col("told").isNotNull(), F.col("wanted").isNotNull()
    out = both.agg(
        F.count_if(told).alias("checked_programs"), F.count_if(told & (F.size("issues") == 0)).alias("healthy_programs"),
        F.count_if(told & (F.size("warnings") > 0)).alias("programs_to_review"), F.coalesce(F.sum("articles"), F.lit(0)).alias("articles"),
        F.count_if(told & (F.col("articles") == 0)).alias("programs_without_articles"), F.count_if(wanted & ~told).alias("missing_programs"),
        F.count_if(wanted).alias("expected_programs"), F.coalesce(F.sum(F.when(told, F.size("issues"))), F.lit(0)).alias("issue_count"),
    )
    return out.withColumn("repair_programs", F.col("expected_programs") - F.col("healthy_programs")).withColumn(
        "passed", (F.col("issue_count") == 0) & (F.col("missing_programs") == 0)
    )


def summarize(records: DataFrame, keys: list[str], status: str, has_image: Column, counted: list[str], group: str) -> DataFrame:
    """Per school: records, of which statuses, with images, from how many sources."""
    return records.groupBy(*keys).agg(
        F.count("*").alias("records"), *(F.count_if(F.col(status) == s).alias(s) for s in counted), F.count_if(has_image).alias("with_image"),
        F.count_distinct(group).alias("sources"),
    )


def health_projection(collections: DataFrame, records: str = "records") -> DataFrame:
    """Envelopes as health rows (J3): without records and season, with their number."""
    return collections.withColumn("record_count", F.coalesce(F.size(records), F.lit(0))).drop(records, "season")


def provenance(articles: DataFrame, declared: DataFrame, keys: list[str], url: str, count: str) -> DataFrame:
    """Distinct articles per source against what the source has declared (A17, K9): keys, n_records, record_count, agrees."""
    n = articles.groupBy(*keys).agg(F.count_distinct(url).alias("n_records"))
    return n.join(declared.select(*keys, F.col(count).alias("record_count")), keys).withColumn("agrees", F.col("n_records") <= F.col("record_count"))


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are there more than once (A23): keys, n_rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """One row per broken rule: rule, key.  A rule is a condition that must hold; null counts as broken."""
    broken = F.filter(
        F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())),
        lambda r: r.isNotNull(),
    )
    return rows.select(F.col(key).cast("string").alias("key"), F.explode(broken).alias("rule"))


def snapshot_rules(now: Column) -> dict[str, Column]:
    """Invariants of a dataset's envelope (X7): columns status, n_records, last_attempt_at, last_success_at,
    source_url, generated_at."""
    c = F.col
    unavailable = c("status") == "unavailable"
    return {
        "unsupported": c("status") != "unsupported",
        "unavailable-has-no-rows": ~unavailable | ((c("n_records") == 0) & c("last_success_at").isNull()),
        "provenance": unavailable | (c("last_success_at").isNotNull() & c("source_url").isNotNull()),
        "ok-has-rows": (c("status") != "ok") | (c("n_records") > 0),
        "empty-has-none": (c("status") != "empty") | (c("n_records") == 0),
        "attempt-before-snapshot": c("last_attempt_at") <= c("generated_at"),
        "success-before-attempt": c("last_success_at").isNull() | (c("last_success_at") <= c("last_attempt_at")),
        "not-in-future": c("generated_at") <= now + F.expr("INTERVAL 5 MINUTES"),
    }


def reconcile(declared: DataFrame, rows: DataFrame, key: str, total: str) -> DataFrame:
    """Declared totals against rows (A10): key, declared, found, agrees."""
    found = rows.groupBy(key).agg(F.count("*").alias("found"))
    return declared.select(key, F.col(total).alias("declared")).join(found, key, "left").select(
        key, "declared", F.coalesce("found", F.lit(0)).alias("found"),
        (F.col("declared") == F.coalesce("found", F.lit(0))).alias("agrees"),
    )
