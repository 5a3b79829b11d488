"""The refresh of news as a whole, its sources, and the counts of an import."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.operators import discovery
from tidewire.plans.refresh import refresh_news
from tidewire.plans.registry import Tables, query


@query(
    """WITH s AS (SELECT user_id AS school, event_type AS source_url, count(*) FILTER (value > 60 AND event_id % 10 <> 0) AS fresh, count(*) FILTER (value > 60) AS parsed FROM events GROUP BY ALL)
    SELECT school, source_url, CASE WHEN source_url = 'error' THEN 'unavailable' WHEN fresh > 0 THEN 'ok' ELSE 'empty' END AS status,
        CASE WHEN source_url = 'error' THEN 'timeout' WHEN parsed > fresh THEN 'future-article-dates-filtered' END AS reason, CASE WHEN source_url = 'error' THEN 0 ELSE fresh END AS record_count FROM s""",
    "R1 R2 U2 F3 C10",
)
def refreshed_sources(t: Tables) -> DataFrame:
    """The states of all sources after one attempt: fetched, empty, failed, with dates that are not believed."""
    return _refresh(t)[1].select("school", "source_url", "status", "reason", F.col("record_count").cast("bigint").alias("record_count"))


@query(
    """SELECT user_id AS school, CASE WHEN bool_or(event_type = 'error') THEN (CASE WHEN count(*) FILTER (event_type <> 'error') = 0 THEN 'unavailable' ELSE 'stale' END)
            WHEN count(*) FILTER (value > 60 AND event_id % 10 <> 0) > 0 THEN 'ok' ELSE 'empty' END AS status,
        count(*) FILTER (event_type <> 'error' AND value > 60 AND event_id % 10 <> 0) AS n_records FROM events GROUP BY user_id""",
    "R1 R2 K8 A15 A16",
)
def refreshed_programs(t: Tables) -> DataFrame:
    return _refresh(t)[2].select("school", "status", F.col("n_records").cast("bigint").alias("n_records"))


def _refresh(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = t.events
    keys = [F.col("user_id").alias("school"), F.lit("golf").alias("sport"), F.col("event_type").alias("source_url")]
    failed = F.col("event_type") == "error"
    sources = e.select("user_id", "event_type").distinct().select(
        *keys, F.expr("CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END").alias("source_order"),
        F.when(failed, "timeout").alias("error"), F.lit(True).alias("empty_confirmed"),
    )
    none, id_ = F.lit(None).cast("string"), F.col("event_id").cast("string")
    at = F.expr("TIMESTAMP '2024-01-01 00:00:00'") + F.when(F.col("event_id") % 10 == 0, F.expr("INTERVAL 900 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    fetched = e.where("value > 60").where(~failed).select(
        *keys, F.col("event_id").alias("pos"), F.concat(F.lit("https://x.org/"), id_).alias("url"), F.concat(F.lit("t "), id_).alias("title"), at.alias("published_at"),
        F.lit("instant").alias("published_at_precision"), F.lit("p").alias("publisher"), none.alias("image_url"), none.alias("image_alt"), none.alias("author"),
        F.lit(None).cast("timestamp").alias("metadata_checked_at"),
    )
    state = sources.limit(0).select("school", "sport", "source_url", F.lit(None).cast("timestamp").alias("last_success_at"), F.lit(0).cast("bigint").alias("record_count"))
    return refresh_news(sources, fetched, fetched.limit(0), state, F.expr("TIMESTAMP '2024-01-31 00:00:00'"))


@query(
    """SELECT n.n_nationkey AS school, f.feed, 'https://' || f.feed || '.org/rss' AS url, f.feed || '.org' AS host FROM nation n
    JOIN (VALUES ('f1', NULL, TRUE), ('f2', 3, TRUE), ('f3', NULL, FALSE)) f(feed, school, verified) ON f.verified AND (f.school IS NULL OR f.school = n.n_nationkey)""",
    "R5 F4 K6",
)
def feed_sources(t: Tables) -> DataFrame:
    """The verified feeds that each program reads."""
    feeds = t.spark.createDataFrame([("f1", None, "verified"), ("f2", 3, "verified"), ("f3", None, "unavailable")], "feed string, school int, status string")
    feeds = feeds.withColumn("sport", F.lit(None).cast("string")).withColumn("url", F.concat(F.lit("https://"), F.col("feed"), F.lit(".org/rss")))
    programs = t.nation.select(F.col("n_nationkey").alias("school"), F.lit("golf").alias("sport"))
    return discovery.feed_sources(programs, feeds).select("school", "feed", "url", "host")


@query(
    """SELECT count(DISTINCT o_custkey) AS schools, count(*) AS programs, count(DISTINCT o_orderpriority) AS sports, count(DISTINCT o_orderstatus) AS conferences,
        count(*) FILTER (o_orderstatus <> CASE WHEN o_orderkey % 3 = 0 THEN 'F' ELSE o_orderstatus END) AS affiliates FROM orders""",
    "A12 A13 R22",
)
def import_counts(t: Tables) -> DataFrame:
    programs = t.orders.select(
        F.col("o_custkey").alias("school"), F.col("o_orderpriority").alias("sport"), F.col("o_orderstatus").alias("primary_conference"),
        F.when(F.col("o_orderkey") % 3 == 0, "F").otherwise(F.col("o_orderstatus")).alias("conference"),
    )
    return discovery.import_evidence(programs)
