"""Raw documents: landed responses, decoded and checked within bounds; failures become codes, not errors.

Fetching is left to whatever lands responses as files or tables (url, status, content_type,
encoding, body, error); there is no network here.
"""

from __future__ import annotations

import gzip
import ipaddress
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tidewire.functions.urls import host_of, safe_url

# Bounds and codes.
MAX_BYTES, BUDGET = 4_000_000, 180
TRANSIENT = ("timeout", "network-error", "http-502", "http-503", "http-504")
CONTENT_TYPES = r"(?i)\b(?:json|html|xml|plain)\b|[+/](?:json|html|xml|plain)"
_DECODED = "struct<text: string, error: string>"


def _decode(body: bytes | None, encoding: str | None, most: int) -> tuple[str | None, str | None]:
    if not body:
        return None, "empty-response"
    if len(body) > most:
        return None, "response-too-large"
    kind = (encoding or "identity").strip().lower()
    try:
        if kind in ("gzip", "x-gzip"):
            body = zlib.decompressobj(31).decompress(body, most + 1)
        elif kind == "deflate":
            body = zlib.decompressobj().decompress(body, most + 1)
        elif kind == "br":
            body = pa.CompressedInputStream(pa.BufferReader(body), "brotli").read(most + 1)
        elif kind != "identity":
            return None, "unexpected-encoding"
    except (zlib.error, gzip.BadGzipFile, EOFError, OSError, pa.ArrowException):
        return None, "invalid-compressed-response"
    if len(body) > most:
        return None, "response-too-large"
    try:
        return body.decode("utf-8"), None
    except UnicodeDecodeError:
        return None, "invalid-utf8"


def decode_body(body: Column, encoding: Column, most: int = MAX_BYTES) -> Column:
    """The text of a body or the code of what is wrong with it (S9, S14).  An Arrow UDF: inflating needs one."""

    @pandas_udf(_DECODED)
    def decode(bodies: pd.Series, encodings: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_decode(b, e, most) for b, e in zip(bodies, encodings, strict=True)], columns=["text", "error"])

    return decode(body, encoding)


@pandas_udf(T.BinaryType())
def encoded_body(texts: pd.Series, encodings: pd.Series) -> pd.Series:
    """Texts as a server sends them: plain, gzip, deflate or br (to land documents)."""

    def one(text, encoding):
        body = (text or "").encode()
        if encoding == "gzip":
            return gzip.compress(body, mtime=0)
        if encoding == "deflate":
            return zlib.compress(body)
        return pa.compress(body, codec="brotli", asbytes=True) if encoding == "br" else body

    return pd.Series([one(t, e) for t, e in zip(texts, encodings, strict=True)])


@pandas_udf(T.BooleanType())
def is_public_address(addresses: pd.Series) -> pd.Series:
    """Whether an address is a global unicast one."""

    def one(a):
        try:
            ip = ipaddress.ip_address(a)
        except ValueError:
            return False
        return ip.is_global and not ip.is_multicast

    return addresses.map(one)


def allowed(url: Column, hosts: Column) -> Column:
    """A safe URL whose host is listed, with or without www.."""
    return safe_url(url).isNotNull() & F.array_contains(F.transform(hosts, lambda h: F.regexp_replace(F.lower(h), "^www[.]", "")), host_of(url))


def accepted(responses: DataFrame, most: int = MAX_BYTES) -> DataFrame:
    """Responses with ``text`` or an ``error_code`` (S7, S8, S9): the first fault in order of the exchange."""
    told = responses.withColumn("decoded", decode_body(F.col("body"), F.col("encoding"), most))
    code = F.coalesce(
        F.col("error"),
        F.when(F.col("status") != 200, F.concat(F.lit("http-"), F.col("status").cast("string"))),
        F.when(~F.coalesce(F.col("content_type").rlike(CONTENT_TYPES), F.lit(False)), "invalid-content-type"),
        F.col("decoded.error"),
    )
    rows = told.withColumn("error_code", code)
    return rows.withColumn("text", F.when(code.isNull(), F.col("decoded.text"))).drop("decoded", "body", "error")


def best_attempt(responses: DataFrame) -> DataFrame:
    """One response per URL: the first that is no transient failure, else the last."""
    good = ~F.coalesce(F.col("error_code").isin(*TRANSIENT), F.lit(False))
    order = F.when(good, -F.col("attempt")).otherwise(F.col("attempt"))
    rest = [c for c in responses.columns if c != "url"]
    best = responses.groupBy("url").agg(F.max_by(F.struct(*rest), F.struct(good.alias("g"), order.alias("o"))).alias("b"))
    return best.select("url", "b.*")


def within_budget(requests: DataFrame, school: str = "school", url: str = "url", order: str = "pos", most: int = BUDGET) -> DataFrame:
    """Marks requests beyond a school's budget of distinct URLs."""
    first = requests.groupBy(school, url).agg(F.min(order).alias("first"))
    place = F.row_number().over(Window.partitionBy(school).orderBy("first", url))
    over = first.select(school, url, (place > most).alias("over"))
    out = requests.join(over, [school, url])
    return out.withColumn("error_code", F.when(F.col("over"), "school-request-budget-exhausted")).drop("over")


def pages_complete(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Whether a paged listing is whole (S11): keys..., found, declared, complete."""
    return pages.groupBy(*keys).agg(F.sum(F.size("rows")).alias("found"), F.max("total_count").alias("declared")).withColumn(
        "complete", F.col("found") == F.col("declared")
    )


MAX_PAGES = 10


def listed_pages(pages: DataFrame, keys: list[str], most: int = MAX_PAGES) -> DataFrame:
    """The pages of a listing that are read (S11): one after another until the declared total is reached, ``most`` at most.

    pages: keys, page (from 1), total_count, rows.  Later pages are not read; a gap ends the listing, which is then not complete.
    """
    so_far = Window.partitionBy(*keys).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    known = pages.withColumn("n_before", F.coalesce(F.sum(F.size("rows")).over(so_far), F.lit(0)))
    known = known.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("page")))
    return known.where((F.col("page") == F.col("place")) & (F.col("page") <= most) & (F.col("n_before") < F.col("total_count"))).drop("place", "n_before")


#: A directory is asked again after a rate limit or a server's error, so many times in all, waiting no longer than this.
MAX_ATTEMPTS, MAX_WAIT_SECONDS = 3, 30


def directory_response(attempts: DataFrame, most: int = 4 << 20) -> DataFrame:
    """One response per address of a directory (S15): url, attempt, waited, error_code.

    attempts: url, attempt (from 1), status, retry_after (seconds, null: none), n_bytes.  The first answer that is
    neither a rate limit nor a server's error counts, else the last of ``MAX_ATTEMPTS``.
    """
    again = (F.col("status") == 429) | (F.col("status") >= 500)
    wait = F.when(F.col("retry_after") > 0, F.least(F.col("retry_after"), F.lit(MAX_WAIT_SECONDS))).otherwise(F.col("attempt") * 2)
    rows = attempts.where(F.col("attempt") <= MAX_ATTEMPTS)
    best = rows.groupBy("url").agg(
        F.min_by(F.struct("attempt", "status", "n_bytes"), F.when(~again, F.col("attempt"))).alias("good"),
        F.max_by(F.struct("attempt", "status", "n_bytes"), "attempt").alias("last"),
        F.map_from_entries(F.collect_list(F.struct("attempt", F.when(again, wait).otherwise(0).alias("w")))).alias("waits"),
    )
    best = best.withColumn("b", F.coalesce("good", "last"))
    waited = F.aggregate(F.map_entries("waits"), F.lit(0).cast("bigint"), lambda a, e: a + F.when(e["key"] < F.col("b.attempt"), e["value"]).otherwise(0))
    code = F.when(~F.col("b.status").between(200, 299), F.concat(F.lit("http-"), F.col("b.status").cast("string"))).when(F.col("b.n_bytes") > most, "response-too-large")
    return best.select("url", F.col("b.attempt").alias("attempt"), waited.alias("waited"), code.alias("error_code"))


def feed_checks(feeds: DataFrame, counted: DataFrame) -> DataFrame:
    """The state of each registered feed (A21, R25): id, status, item_count, sha256, reason.

    feeds: id, text (null: not fetched), error_code; counted: id, n_items, error_code of the parsed document.  A failed feed has
    neither digest nor count.
    """
    c = counted.select("id", "n_items", F.col("error_code").alias("parse_error"))
    rows = feeds.join(c, "id", "left")
    reason = F.coalesce("error_code", "parse_error", F.when(F.col("text").isNull(), "empty-response"))
    ok = reason.isNull()
    return rows.select(
        "id", F.when(ok, "verified").otherwise("unavailable").alias("status"), F.when(ok, F.coalesce("n_items", F.lit(0))).alias("item_count"),
        F.when(ok, F.sha2(F.col("text").cast("binary"), 256)).alias("sha256"), reason.alias("reason"),
    )
