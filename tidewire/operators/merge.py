"""Merging article records: upsert by URL, headline dedup, top-k, ordered groups.

Input records have (keys..., url, title, published_at, image_url, image_alt, author,
metadata_checked_at, discovery_source_url, pos); pos says which came later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.text import stable_id, title_key
from tidewire.functions.urls import canonical_url

MAX_NEWS = 1000
#: Taken from the last record as they are, null or not.
_LAST = ("title", "published_at", "published_at_precision", "publisher", "discovery_source_url")


def _last_known(value: str, order: Column) -> Column:
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), order))


def upsert_by_url(records: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """One row per keys and canonical URL (A5).

    The last record gives most fields; image and author fall back to earlier ones that
    have them; the alternative text belongs to the image that stays: it is the last one
    told since the URL of that image last changed, or null; the metadata check is the latest.
    All is pre-aggregated before the shuffle and no group is gathered into a list, so a URL that is
    seen ever so often costs no more than others.  An unsafe URL is an error in the source; its
    rows must be filtered before.
    """
    order = F.col(pos)
    last = [c for c in _LAST if c in records.columns]
    rows = records.withColumn("url", canonical_url(F.col("url")))
    told = F.when(F.col("image_alt").isNotNull(), order)
    author = F.when(F.col("author").isNotNull(), F.struct(order.alias("p"), F.col("author").alias("v")))
    # a row per image, which carries the fold of everything else; so records are read and sent once
    images = rows.groupBy(*keys, "url", "image_url").agg(
        F.max_by(F.struct(*last), order).alias("l"), F.max(author).alias("author"), F.max("metadata_checked_at").alias("metadata_checked_at"),
        F.min(order).alias("first_pos"), F.max(order).alias("at"), F.max_by("image_alt", told).alias("alt"), F.max(told).alias("alt_at"),
    )
    # the image of the last place stays; its text counts if it was told after the last place of any other image
    of_url = Window.partitionBy(*keys, "url").orderBy(F.col("image_url").isNull(), F.col("at").desc())
    other_at = F.lead(F.when(F.col("image_url").isNotNull(), F.col("at"))).over(of_url)
    images = images.withColumn("r", F.row_number().over(of_url)).withColumn("other_at", other_at)
    alt = F.when(F.col("other_at").isNull() | (F.col("alt_at") > F.col("other_at")), F.col("alt"))
    final = F.when((F.col("r") == 1) & F.col("image_url").isNotNull(), F.struct("image_url", alt.alias("image_alt")))
    folded = images.groupBy(*keys, "url").agg(
        F.max_by("l", "at").alias("l"), F.max(final).alias("i"), F.max("author").alias("author"), F.max("metadata_checked_at").alias("metadata_checked_at"),
        F.min("first_pos").alias("first_pos"), F.max("at").alias("last_pos"),
    )
    return folded.select(
        *keys, "url", *(F.col(f"l.{c}").alias(c) for c in last), F.col("i.image_url").alias("image_url"), F.col("i.image_alt").alias("image_alt"),
        F.col("author.v").alias("author"), "metadata_checked_at", "first_pos", "last_pos",
    ).withColumn("id", stable_id(*(F.col(k) for k in keys), F.col("url")))


def newest_first(published_at: str = "published_at", url: str = "url") -> list[Column]:
    """Newest first, undated as of 1970, then by URL (O1)."""
    return [F.coalesce(F.unix_millis(F.col(published_at).cast("timestamp")), F.lit(0)).desc(), F.col(url).asc()]


def headline_dedup(records: DataFrame, keys: list[str]) -> DataFrame:
    """The first of each headline and day."""
    key = title_key(F.col("title"), F.col("published_at"), F.col("url"))
    rank = F.row_number().over(Window.partitionBy(*keys, "headline").orderBy(*newest_first()))
    return records.withColumn("headline", key).withColumn("r", rank).where("r = 1").drop("r", "headline")


def top_k(records: DataFrame, keys: list[str], k: int = MAX_NEWS, order: list[Column] | None = None) -> DataFrame:
    """The newest k per program (W2); Spark prunes groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*(order or newest_first())))
    return records.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= k)


def merge_news(records: DataFrame, keys: list[str], k: int = MAX_NEWS) -> DataFrame:
    """A5, then W1, then W2."""
    return top_k(headline_dedup(upsert_by_url(records, keys), keys), keys, k)


def unique_by_id(records: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """The last value at the first position."""
    rest = [c for c in records.columns if c not in (*keys, pos)]
    out = records.groupBy(*keys).agg(F.max_by(F.struct(*rest), pos).alias("v"), F.min(pos).alias(pos))
    return out.select(*keys, pos, *(F.col(f"v.{c}").alias(c) for c in rest))


# How exactly a date is known.
PRECISION = {"unknown": 0, "day": 1, "instant": 2}


def precision_merge(records: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """The most exact date wins, of equals the later; the newest image and author known stay."""
    rank = F.create_map(*(F.lit(x) for kv in PRECISION.items() for x in kv))[F.col("published_at_precision")]
    return records.groupBy(*keys).agg(
        F.max_by(F.struct("title", "published_at", "published_at_precision"), F.struct(rank.alias("r"), F.col(pos).alias("p"))).alias("v"),
        _last_known("image_url", F.col(pos)).alias("image_url"),
        _last_known("author", F.col(pos)).alias("author"),
    ).select(*keys, "v.title", "v.published_at", "v.published_at_precision", "image_url", "author")


def conflicting(records: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Per key: rows, repeated identical rows, whether different values conflict."""
    n = F.count_distinct(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}))
    return records.groupBy(*key).agg(F.count("*").alias("n_rows"), n.alias("n_values")).select(
        *key, "n_rows", (F.col("n_rows") - F.col("n_values")).alias("n_repeated"), (F.col("n_values") > 1).alias("conflict")
    )


def by_date_text(records: DataFrame, at: str) -> DataFrame:
    """Newest first by the text of the date; no date sorts last (O2)."""
    return records.orderBy(F.coalesce(F.col(at), F.lit("")).desc())
