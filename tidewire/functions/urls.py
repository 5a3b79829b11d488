"""URLs: which are safe to publish, and their canonical forms."""

from __future__ import annotations

from urllib.parse import quote, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# Query keys that grant access, suffixes of private hosts, tracking keys.
SECRET_KEYS = (
    "access[-_]?token|api[-_]?key|authorization|auth|token|secret|password|signature|sig|x-amz-[^=&]+|x-goog-[^=&]+"
)
PRIVATE_HOSTS = "localhost|local|internal|test|invalid"
TRACKING_KEYS = "utm_[^=&]+|fbclid|gclid|mc_cid|mc_eid"
IDENTITY_TRACKING_KEYS = "utm_[^=&]+|fbclid|gclid"
LONGEST = 2048

_SHAPE = r"^https://([A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+)(?::443)?(?:[/?#]|$)"
_NO_HOST = rf"(?i)^https://(?:[0-9.]+|(?:[^/?#:]*\.)?(?:{PRIVATE_HOSTS}))(?:[:/?#]|$)"
_SECRET = rf"(?i)^[^?#]*\?(?:[^#]*&)?(?:{SECRET_KEYS})(?:[=&#]|$)"


def safe_url(url: Column) -> Column:
    """An absolute https URL that may be published, its host in lower case, or null.

    No userinfo, no port but 443, a host name with a dot that is neither an address nor
    private, and no query key that grants access.
    """
    host = F.regexp_extract(url, _SHAPE, 1)
    rest = F.regexp_replace(url, r"^https://[^/?#]*", "")
    ok = url.rlike(_SHAPE) & ~url.rlike(_NO_HOST) & ~url.rlike(_SECRET) & (F.char_length(url) <= LONGEST) & ~url.rlike(r"\s")
    slash = F.when(rest.startswith("/"), F.lit("")).otherwise("/")
    return F.when(ok, F.concat(F.lit("https://"), F.lower(host), slash, rest))


def _absolute(url: str | None, base: str | None) -> str | None:
    if not url or len(url) > LONGEST:
        return None
    try:
        parts = urlsplit(urljoin(base or "", url.strip()))
        path = quote(parts.path or "/", safe="/%:@!$&'()*+,;=~-._")
        query = quote(parts.query, safe="=&?/%:@!$'()*+,;~-._[]")
        return urlunsplit((parts.scheme.lower(), parts.netloc, path, query, parts.fragment))
    except ValueError:
        return None


@pandas_udf(T.StringType())
def _resolved(urls: pd.Series, bases: pd.Series) -> pd.Series:
    return pd.Series([_absolute(u, b) for u, b in zip(urls, bases, strict=True)])


@pandas_udf(T.ArrayType(T.StringType()))
def _resolved_each(urls: pd.Series, bases: pd.Series) -> pd.Series:
    return pd.Series([None if us is None else [_absolute(u, b) for u in us] for us, b in zip(urls, bases, strict=True)])


def resolve_url(url: Column, base: Column) -> Column:
    """A link of a page as a safe absolute URL.  An Arrow UDF: the JVM side does not resolve links."""
    return safe_url(_resolved(url, base))


def resolve_each(urls: Column, base: Column) -> Column:
    """``resolve_url`` of every link of an array; null for those that may not be published."""
    return F.transform(_resolved_each(urls, base), safe_url)


def _without_keys(url: Column, keys: str) -> Column:
    """Without fragment and the named query keys; other pairs keep their order."""
    bare = F.regexp_replace(url, "#.*$", "")
    query = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")
    kept = F.filter(query, lambda p: ~p.rlike(rf"(?i)^(?:{keys})(?:=|$)") & (p != ""))
    path = F.regexp_replace(bare, r"\?.*$", "")
    return F.concat(path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def canonical_url(url: Column) -> Column:
    """The key by which articles are merged."""
    return _without_keys(safe_url(url), TRACKING_KEYS)


def article_identity(url: Column) -> Column:
    """The form in which a page's own address is compared."""
    text = _without_keys(safe_url(url), IDENTITY_TRACKING_KEYS)
    return F.regexp_replace(F.regexp_replace(text, "^https://www[.]", "https://"), "/$", "")


def host_of(url: Column) -> Column:
    """The host without a leading ``www.``."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(host, "^www[.]", "")


def sport_route(url: Column) -> Column:
    """The sport that a site's path names, or null."""
    return F.nullif(F.regexp_extract(F.lower(url), r"^[^?#]*/sports?/([a-z0-9-]+)", 1), F.lit(""))


def has_segment(url: Column, segment: str) -> Column:
    """Whether a path segment is the given one."""
    return F.array_contains(F.split(F.regexp_replace(url, r"^[a-z]+://[^/]*|[?#].*$", ""), "/"), segment)


def in_scope(url: Column, host: Column, prefix: Column) -> Column:
    """Whether an article lies on the host and below the path."""
    path = F.regexp_replace(F.regexp_replace(url, r"^https://[^/?#]*", ""), r"[?#].*$", "")
    return (host_of(url) == host) & path.startswith(prefix)



def in_article_scope(url: Column, prefix: Column, feed_url: Column) -> Column:
    """Whether an article is the feed's (P3): below its path, and of its sport where the feed's own address names one.

    Indoor and outdoor track of both genders share their announcements.
    """
    path = F.regexp_replace(F.regexp_replace(url, r"^https://[^/?#]*", ""), r"[?#].*$", "")
    below = prefix.isNull() | path.startswith(prefix)
    sport = F.nullif(F.regexp_extract(feed_url, r"^https://www\.ncaa\.com/news/([^/]+)/(?:d[123]|nc|fbs|fcs)/rss\.xml$", 1), F.lit(""))
    route = F.regexp_extract(path, r"^/(?:news|video|live-updates)/([^/]+)/", 1)
    track = r"^trackfield-(?:indoor|outdoor)-(?:men|women)$"
    same = F.when(sport.rlike(track), route.rlike(track)).otherwise(route == sport)
    return F.coalesce(below & (sport.isNull() | same), F.lit(False))


def athletics_url(raw: Column) -> Column:
    """A directory's athletics address with https and without fragment; null if there is none or it is not a public host."""
    text = F.trim(F.regexp_replace(raw, r"(?U)\s+", " "))
    full = F.when(text.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), text).otherwise(F.concat(F.lit("https://"), text))
    bare = F.regexp_replace(F.regexp_replace(full, r"(?i)^https?://", "https://"), "#.*$", "")
    public = full.rlike(r"(?i)^https?://") & ~bare.rlike(r"^https://[^/?#]*[@:]") & ~bare.rlike(_NO_HOST) & bare.rlike(r"^https://[^/?#]*\.[^/?#]")
    host = F.lower(F.regexp_extract(bare, r"^https://([^/?#]*)", 1))
    rest = F.regexp_replace(bare, r"^https://[^/?#]*", "")
    slash = F.when(rest.startswith("/"), F.lit("")).otherwise("/")
    return F.when((text != "") & public & ~bare.rlike(r"\s"), F.concat(F.lit("https://"), host, slash, rest))


def official_hosts(url: Column) -> Column:
    """The host of a school's site with and without www. (T25); none for an unsafe address."""
    host = F.regexp_extract(safe_url(url), "^https://([^/?#]*)", 1)
    other = F.when(host.startswith("www."), F.substring(host, 5, 2048)).otherwise(F.concat(F.lit("www."), host))
    return F.when(safe_url(url).isNotNull(), F.array(host, other)).otherwise(F.array().cast("array<string>"))


def official_link(url: Column, hosts: Column) -> Column:
    """A link of a site as an address of its own pages, without fragment, or null (F14, R20).  ``url`` is absolute."""
    host = F.regexp_extract(safe_url(url), "^https://([^/?#]*)", 1)
    bare = F.regexp_replace(safe_url(url), "#.*$", "")
    path = F.regexp_replace(bare, r"\?.*$", "")
    return F.when(F.array_contains(hosts, host) & ~path.rlike(r"(?i)\.(?:pdf|jpg|png|gif|mp4|zip)$"), bare)


def source_route(url: Column, slugs: Column, kind: str) -> Column:
    """Whether an address is the sport's page of a kind (R13): its route one of the slugs, a segment the kind."""
    return F.coalesce(F.array_contains(slugs, sport_route(url)) & has_segment(url, kind), F.lit(False))
