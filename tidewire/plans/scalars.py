"""Scalar functions over pages, documents, events and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions import dates, sports, text, urls
from tidewire.operators.classify import recruit_headline, recruiting_status
from tidewire.operators.windows import needs_enrichment
from tidewire.plans.registry import Tables, query

#: The observation time of all queries over events.
NOW = "TIMESTAMP '2024-01-31 00:00:00'"
_SPACE = r"[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0085}\x{000b}]+"


def _clean_sql(column: str, longest: int = 300) -> str:
    text = rf"regexp_replace(substring(coalesce({column}, ''), 1, 10000), '<[^>]*>', ' ', 'g')"
    text = rf"regexp_replace({text}, '[<>\x00-\x1f\x7f]', ' ', 'g')"
    return rf"substring(trim(regexp_replace({text}, '{_SPACE}', ' ', 'g')), 1, {longest})"


_HOST = r"^https://([A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+)(?::443)?(?:[/?#]|$)"


def _safe_sql(u: str) -> str:
    return rf"""CASE WHEN regexp_matches({u}, '{_HOST}')
        AND NOT regexp_matches({u}, '(?i)^https://(?:[0-9.]+|(?:[^/?#:]*\.)?(?:localhost|local|internal|test|invalid))(?:[:/?#]|$)')
        AND NOT regexp_matches({u}, '(?i)^[^?#]*\?(?:[^#]*&)?(?:access[-_]?token|api[-_]?key|authorization|auth|token|secret|password|signature|sig|x-amz-[^=&]+|x-goog-[^=&]+)(?:[=&#]|$)')
        AND length({u}) <= 2048 AND NOT regexp_matches({u}, '\s')
        THEN 'https://' || lower(regexp_extract({u}, '{_HOST}', 1))
             || (CASE WHEN starts_with(regexp_replace({u}, '^https://[^/?#]*', ''), '/') THEN '' ELSE '/' END)
             || regexp_replace({u}, '^https://[^/?#]*', '') END"""


def _canonical_sql(safe: str, keys: str = "utm_[^=&]+|fbclid|gclid|mc_cid|mc_eid") -> str:
    bare = f"regexp_replace({safe}, '#.*$', '')"
    kept = (
        rf"list_filter(string_split(regexp_extract({bare}, '\?(.*)$', 1), '&'),"
        rf" lambda p: NOT regexp_matches(p, '(?i)^(?:{keys})(?:=|$)') AND p <> '')"
    )
    return rf"""regexp_replace({bare}, '\?.*$', '')
        || (CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END)"""


@query(f"SELECT page_id, {_clean_sql('html')} AS cleaned FROM pages")
def clean_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.clean_text(F.col("html")).alias("cleaned"))


@query(f"SELECT doc_id, {_clean_sql('text', 160)} AS cleaned FROM documents")
def clean_document(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.clean_text(F.col("text"), 160).alias("cleaned"))


@query(f"SELECT page_id, {_safe_sql('url')} AS safe FROM pages")
def safe_url(t: Tables) -> DataFrame:
    return t.pages.select("page_id", urls.safe_url(F.col("url")).alias("safe"))


@query(f"WITH s AS (SELECT page_id, {_safe_sql('url')} AS safe FROM pages) SELECT page_id, {_canonical_sql('safe')} AS canonical FROM s")
def canonical_url(t: Tables) -> DataFrame:
    return t.pages.select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


@query(
    f"""WITH s AS (SELECT page_id, {_safe_sql("url")} AS safe FROM pages),
    c AS (SELECT page_id, {_canonical_sql("safe", "utm_[^=&]+|fbclid|gclid")} AS u FROM s)
    SELECT page_id, regexp_replace(regexp_replace(u, '^https://www[.]', 'https://'), '/$', '') AS identity FROM c"""
)
def article_identity_url(t: Tables) -> DataFrame:
    return t.pages.select("page_id", urls.article_identity(F.col("url")).alias("identity"))


@query("SELECT page_id, substring(sha256(coalesce(url, '') || '|' || page_id || '|'), 1, 24) AS id FROM pages")
def stable_id(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    return t.pages.select("page_id", text.stable_id(F.col("url"), F.col("page_id"), none).alias("id"))


@query(r"SELECT doc_id, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) || '|' || lang AS title_key FROM documents")
def title_key(t: Tables) -> DataFrame:
    none = F.lit(None).cast("timestamp")
    return t.documents.select("doc_id", text.title_key(F.col("text"), none, F.col("lang")).alias("title_key"))


@query(
    r"""SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(p_name || ' & ' || p_brand)),
        '[''’"]', '', 'g'), '&', ' and ', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM part"""
)
def slugify(t: Tables) -> DataFrame:
    name = F.concat(F.col("p_name"), F.lit(" & "), F.col("p_brand"))
    return t.part.select("p_partkey", text.slugify(name).alias("slug"))


def _label_sql(column: str) -> str:
    out = f"CASE WHEN {column} IS NULL OR length({column}) > 200 THEN '' ELSE lower({column}) END"
    for pattern, to in sports.LABEL_STEPS:
        to = to.replace("$1", r"\1").replace("$2", r"\2")
        out = f"regexp_replace({out}, '{pattern.replace(chr(39), chr(39) * 2)}', '{to}', 'g')"
    return out


_LABELS = "(p_type || ' & ' || p_name || CASE p_partkey % 4 WHEN 0 THEN ' (W)' WHEN 1 THEN ' - Men''s' WHEN 2 THEN '/Female' ELSE '' END)"


@query(f"SELECT p_partkey, {_label_sql(_LABELS)} AS label FROM part")
def label_normalize(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", sports.normal_label(F.expr(_LABELS.replace("Men''s", "Men\\'s"))).alias("label"))


@query(
    rf"""SELECT source, count(*) AS n_docs,
        count(*) FILTER (regexp_matches(text, '{text.CREDENTIALS}') OR regexp_matches(text, '(?i)[A-Z]:[\\/]Users[\\/]|/(?:home|Users)/[^/\s]+/')) AS n_flagged,
        count(*) FILTER (regexp_matches(text, '\b[0-9a-f]{{40}}\b')) AS n_digests
        FROM documents GROUP BY source"""
)
def public_value_scan(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(
        F.count("*").alias("n_docs"),
        F.count_if(text.has_credential(F.col("text"))).alias("n_flagged"),
        F.count_if(F.col("text").rlike(r"\b[0-9a-f]{40}\b")).alias("n_digests"),
    )


@query(
    f"""SELECT page_id, {_clean_sql("replace(replace(replace(replace(replace(replace(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&amp;', '&')")} AS title
    FROM pages"""
)
def html_title_text(t: Tables) -> DataFrame:
    title = F.regexp_extract("html", r"(?s)<title[^>]*>(.*?)</title>", 1)
    return t.pages.select("page_id", text.plain(title).alias("title"))


@query(
    r"""SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www[.]', '') AS host,
        nullif(regexp_extract(lower(replace(url, '/en/', '/sports/')), '^[^?#]*/sports?/([a-z0-9-]+)', 1), '') AS route
        FROM pages"""
)
def url_host_route(t: Tables) -> DataFrame:
    route = urls.sport_route(F.replace(F.col("url"), F.lit("/en/"), F.lit("/sports/")))
    return t.pages.select("page_id", urls.host_of(F.col("url")).alias("host"), route.alias("route"))


_WRITTEN = """CASE o_orderkey % 5 WHEN 0 THEN {iso} || 'T10:30:00Z' WHEN 1 THEN {us} WHEN 2 THEN {iso}
    WHEN 3 THEN {iso} || 'T10:30:00' ELSE '2026-02-30' END"""
_WRITTEN_SPARK = _WRITTEN.format(iso="date_format(o_orderdate, 'yyyy-MM-dd')", us="date_format(o_orderdate, 'M/d/yyyy')")
_WRITTEN_DUCK = _WRITTEN.format(iso="strftime(o_orderdate, '%Y-%m-%d')", us="strftime(o_orderdate, '%-m/%-d/%Y')")


@query(
    f"""WITH w AS (SELECT o_orderkey, {_WRITTEN_DUCK} AS written FROM orders), v AS (
        SELECT o_orderkey,
            CASE WHEN regexp_matches(written, 'Z$') THEN try_strptime(written, '%Y-%m-%dT%H:%M:%SZ') END AS instant,
            CASE WHEN regexp_matches(written, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN try_strptime(written, '%m/%d/%Y')
                 WHEN regexp_matches(written, '^\\d{{4}}-\\d\\d-\\d\\d$') THEN try_strptime(written, '%Y-%m-%d') END AS day
        FROM w)
    SELECT o_orderkey, strftime(coalesce(instant, day), '%Y-%m-%dT%H:%M:%S.000Z') AS at,
        CASE WHEN instant IS NOT NULL THEN 'instant' WHEN day IS NOT NULL THEN 'day' ELSE 'unknown' END AS date_precision FROM v"""
)
def date_precision(t: Tables) -> DataFrame:
    told = dates.date_value(F.expr(_WRITTEN_SPARK))
    return t.orders.select("o_orderkey", told.alias("d")).select(
        "o_orderkey", dates.iso(F.col("d.at")).alias("at"), F.col("d.precision").alias("date_precision")
    )


@query("SELECT o_orderkey, CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 3 THEN 1 ELSE 0 END AS INTEGER) AS cycle FROM orders")
def recruiting_cycle(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.recruiting_cycle(F.col("o_orderdate")).cast("int").alias("cycle"))


@query(
    """WITH v AS (SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, TRY_CAST(value * 10 AS DOUBLE) AS s FROM events)
    SELECT event_id, CASE WHEN s >= 0 AND s < 1000 THEN s END AS score, CASE WHEN k > 0 AND k <= 50 THEN k END AS national_rank FROM v"""
)
def bounded_score(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return t.events.select(
        "event_id", dates.score(F.col("value") * 10).alias("score"), dates.optional_number(k, 50).alias("national_rank")
    )


@query(f"SELECT event_id, (epoch_us({NOW}) // 1000 - epoch_us(ts) // 1000) / 3600000.0::DOUBLE AS age FROM events")
def age_hours(t: Tables) -> DataFrame:
    return t.events.select("event_id", dates.age_hours(F.col("ts"), F.expr(NOW)).alias("age"))


@query("SELECT event_id FROM events WHERE ts IS NULL OR ts <= TIMESTAMP '2024-01-15 00:00:00' + INTERVAL 24 HOURS")
def future_filter(t: Tables) -> DataFrame:
    return t.events.where(dates.not_future(F.col("ts"), F.expr("TIMESTAMP '2024-01-15 00:00:00'"))).select("event_id")


@query(
    f"""SELECT event_id FROM events WHERE (event_type = 'error' OR value < 5)
    AND (value < 20 OR ts <= {NOW} - INTERVAL 7 DAYS)"""
)
def cooldown_candidates(t: Tables) -> DataFrame:
    rows = t.events.select(
        "event_id",
        F.when(F.col("event_type") != "error", F.lit("i")).alias("image_url"),
        F.when(F.col("value") >= 5, F.lit("a")).alias("author"),
        F.when(F.col("value") >= 20, F.col("ts")).alias("metadata_checked_at"),
    )
    return rows.where(needs_enrichment(F.expr(NOW))).select("event_id")


_RECRUIT_TEXT = "CASE doc_id % 4 WHEN 0 THEN 'Team signs ' WHEN 1 THEN 'Coach adds five to roster ' WHEN 2 THEN 'No designs here ' ELSE '' END || text"


@query(
    f"""SELECT doc_id FROM documents WHERE regexp_matches({_RECRUIT_TEXT},
    '(?i)\\b(?:signs?|signing|signees?|recruiting class|adds\\b.{{0,80}}\\bto roster|welcomes\\b.{{0,80}}\\bclass)\\b')"""
)
def recruit_headline_whole(t: Tables) -> DataFrame:
    """Texts that announce recruits, read whole."""
    return t.documents.where(recruit_headline(F.expr(_RECRUIT_TEXT))).select("doc_id")


@query(
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'committed' WHEN '2-HIGH' THEN 'signed'
        WHEN '3-MEDIUM' THEN 'enrolled' WHEN '5-LOW' THEN 'unknown' END AS status FROM orders"""
)
def recruiting_section_status(t: Tables) -> DataFrame:
    section = F.expr(
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'Hard Commits' WHEN '2-HIGH' THEN 'Signees' WHEN '3-MEDIUM' THEN 'Enrolled'
        WHEN '5-LOW' THEN 'Targets' ELSE 'Transfers' END"""
    )
    return t.orders.select("o_orderkey", recruiting_status(section).alias("status"))


@query(
    """SELECT c_custkey, replace(replace(replace(replace(c_name || ' <&> ' || c_mktsegment || '|x', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '|', '\\|') AS cell
    FROM customer"""
)
def markdown_cell(t: Tables) -> DataFrame:
    raw = F.concat("c_name", F.lit(" <&> "), "c_mktsegment", F.lit("|x"))
    return t.customer.select("c_custkey", text.cell(raw).alias("cell"))


@query(
    r"""SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS author FROM customer"""
)
def clean_author(t: Tables) -> DataFrame:
    raw = F.expr("CASE WHEN c_custkey % 7 = 0 THEN 'by:  undefined' ELSE concat('By ', c_name, ' ') END")
    return t.customer.select("c_custkey", text.clean_author(raw).alias("author"))
