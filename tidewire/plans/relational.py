"""Joins, merges, state, windows and audits.

Stand-ins: events are articles (user_id the program, event_type the source), region, nation and
supplier or customer are conference, school and program, orders and lineitem declared totals
and rows, conversations sectioned listings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire import publish
from tidewire.functions import text, urls
from tidewire.operators import discovery, health, joins, merge, providers, slots, state, windows
from tidewire.plans.registry import Tables, query
from tidewire.plans.scalars import NOW, _canonical_sql, _clean_sql, _safe_sql

_NOW = F.expr


def articles(t: Tables) -> DataFrame:
    """Events as article records: ten thousand sightings of a few URLs per program."""
    e = t.events
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("user_id").alias("program"),
        F.col("event_type").alias("source"),
        F.concat(F.lit("https://news.example.com/a/"), (k % 30).cast("string"), F.when(k % 3 == 0, "?utm_source=x").otherwise("")).alias("url"),
        F.concat(F.lit("Title "), (k % 12).cast("string")).alias("title"),
        F.when(k % 10 != 0, F.col("ts")).alias("published_at"),
        F.when(k % 10 == 0, "unknown").when(k % 2 == 0, "day").otherwise("instant").alias("published_at_precision"),
        F.col("event_type").alias("publisher"),
        F.concat(F.lit("https://"), F.col("event_type"), F.lit(".example.com/")).alias("discovery_source_url"),
        F.when(F.col("value") > 40, F.concat(F.lit("https://img.example.com/"), (F.col("event_id") % 3).cast("string"))).alias("image_url"),
        F.when(F.col("value") > 60, F.concat(F.lit("alt "), F.col("event_id").cast("string"))).alias("image_alt"),
        F.when(F.col("value") > 50, F.concat(F.lit("By "), F.col("event_type"))).alias("author"),
        F.when(F.col("value") > 70, F.col("ts")).alias("metadata_checked_at"),
        F.col("event_id").alias("pos"),
    )


_ARTICLES = """a0 AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
), articles AS (
    SELECT user_id AS program, event_type AS source, 'https://news.example.com/a/' || (k % 30) AS url,
        'Title ' || (k % 12) AS title, CASE WHEN k % 10 <> 0 THEN ts END AS published_at,
        CASE WHEN k % 10 = 0 THEN 'unknown' WHEN k % 2 = 0 THEN 'day' ELSE 'instant' END AS published_at_precision,
        event_type AS publisher, 'https://' || event_type || '.example.com/' AS discovery_source_url,
        CASE WHEN value > 40 THEN 'https://img.example.com/' || (event_id % 3) END AS image_url,
        CASE WHEN value > 60 THEN 'alt ' || event_id END AS image_alt,
        CASE WHEN value > 50 THEN 'By ' || event_type END AS author,
        CASE WHEN value > 70 THEN ts END AS metadata_checked_at, event_id AS pos
    FROM a0
)"""

# The image's text: the last told since the URL of the last image has last changed.
_UPSERT = f"""{_ARTICLES}, images AS (
    SELECT program, url, pos, image_url, image_alt,
        sum(CASE WHEN image_url IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY program, url ORDER BY pos) AS run
    FROM (SELECT *, lag(image_url) OVER (PARTITION BY program, url ORDER BY pos) AS before FROM articles WHERE image_url IS NOT NULL)
), last_run AS (
    SELECT *, max(run) OVER (PARTITION BY program, url) AS final FROM images
), picked AS (
    SELECT program, url, any_value(image_url) AS image_url, arg_max(image_alt, pos) FILTER (image_alt IS NOT NULL) AS image_alt
    FROM last_run WHERE run = final GROUP BY program, url
), upserted AS (
    SELECT program, url, arg_max(struct_pack(t := title, p := published_at, s := discovery_source_url), pos) AS l,
        arg_max(author, pos) FILTER (author IS NOT NULL) AS author, max(metadata_checked_at) AS metadata_checked_at
    FROM articles GROUP BY program, url
), merged AS (
    SELECT u.program, u.url, u.l.t AS title, u.l.p AS published_at, u.l.s AS discovery_source_url, p.image_url, p.image_alt, u.author,
        u.metadata_checked_at, substring(sha256(u.program || '|' || u.url), 1, 24) AS id
    FROM upserted u LEFT JOIN picked p ON u.program = p.program AND u.url = p.url
)"""
_MERGED = ["program", "url", "title", "published_at", "discovery_source_url", "image_url", "image_alt", "author", "metadata_checked_at", "id"]


@query(f"WITH {_UPSERT} SELECT {', '.join(_MERGED)} FROM merged")
def news_upsert(t: Tables) -> DataFrame:
    return merge.upsert_by_url(articles(t), ["program"]).select(*_MERGED)


_HEADLINES = """headlines AS (
    SELECT *, row_number() OVER (PARTITION BY program, trim(regexp_replace(lower(title), '[^\\p{L}\\p{N}]+', ' ', 'g')) || '|'
        || coalesce(strftime(published_at, '%Y-%m-%d'), url) ORDER BY coalesce(epoch_ms(published_at), 0) DESC, url) AS r
    FROM merged
)"""


@query(f"WITH {_UPSERT}, {_HEADLINES} SELECT program, url, id FROM headlines WHERE r = 1")
def headline_day_dedup(t: Tables) -> DataFrame:
    rows = merge.upsert_by_url(articles(t), ["program"])
    return merge.headline_dedup(rows, ["program"]).select("program", "url", "id")


@query(
    """SELECT user_id, event_id, rank FROM (SELECT user_id, event_id,
        row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts) DESC, event_id) AS rank FROM events) WHERE rank <= 10"""
)
def top_k_per_program(t: Tables) -> DataFrame:
    order = merge.newest_first("ts", "event_id")
    return merge.top_k(t.events.select("user_id", "event_id", "ts"), ["user_id"], 10, order).select("user_id", "event_id", "rank")


@query(
    f"""WITH s AS (SELECT page_id, {_safe_sql("url")} AS safe,
            {_clean_sql("replace(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1), '&amp;', '&')")} AS title,
            TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(page_id % 500 AS INTEGER)) AS published_at FROM pages),
    c AS (SELECT page_id, {_canonical_sql("safe")} AS url, title, published_at, regexp_extract(safe, '^https://([^/]*)', 1) AS site FROM s WHERE safe IS NOT NULL),
    u AS (SELECT site, url, arg_max(title, page_id) AS title, arg_max(published_at, page_id) AS published_at FROM c GROUP BY site, url),
    h AS (SELECT *, row_number() OVER (PARTITION BY site, trim(regexp_replace(lower(title), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || '|' || strftime(published_at, '%Y-%m-%d')
        ORDER BY epoch_ms(published_at) DESC, url) AS r FROM u),
    k AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY epoch_ms(published_at) DESC, url) AS rank FROM h WHERE r = 1)
    SELECT site, url, title, published_at, rank, substring(sha256(site || '|' || url), 1, 24) AS id FROM k WHERE rank <= 1000"""
)
def news_merge_topk(t: Tables) -> DataFrame:
    """Pages as articles of their sites: safe and canonical URL, title, id, upsert, headline dedup, top k."""
    title = text.clean_text(F.replace(F.regexp_extract("html", r"(?s)<title[^>]*>(.*?)</title>", 1), F.lit("&amp;"), F.lit("&")))
    at = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(page_id % 500 as int))")
    none = F.lit(None).cast("string")
    records = t.pages.select(
        urls.safe_url(F.col("url")).alias("url"), title.alias("title"), at.alias("published_at"), none.alias("image_url"),
        none.alias("image_alt"), none.alias("author"), F.lit(None).cast("timestamp").alias("metadata_checked_at"), F.col("page_id").alias("pos"),
    ).where("url is not null").withColumn("site", F.regexp_extract("url", "^https://([^/]*)", 1))
    return merge.merge_news(records, ["site"]).select("site", "url", "title", "published_at", F.col("rank"), "id")


@query(
    """SELECT user_id, event_type, CAST(min(event_id) AS BIGINT) AS pos, arg_max(value, event_id) AS value, arg_max(props, event_id) AS props
    FROM events GROUP BY user_id, event_type"""
)
def unique_by_id_last(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", "value", "props", F.col("event_id").alias("pos"))
    return merge.unique_by_id(rows, ["user_id", "event_type"])


@query(
    f"""WITH {_ARTICLES}, r AS (SELECT *, CASE published_at_precision WHEN 'unknown' THEN 0 WHEN 'day' THEN 1 ELSE 2 END AS p FROM articles)
    SELECT program, url, arg_max(published_at_precision, p * 1000000000 + pos) AS published_at_precision, arg_max(title, p * 1000000000 + pos) AS title,
        arg_max(image_url, pos) FILTER (image_url IS NOT NULL) AS image_url, arg_max(author, pos) FILTER (author IS NOT NULL) AS author
    FROM r GROUP BY program, url"""
)
def precision_merge(t: Tables) -> DataFrame:
    rows = articles(t).withColumn("url", F.regexp_replace("url", r"\?.*", ""))
    return merge.precision_merge(rows, ["program", "url"]).drop("published_at")


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(*) - count(DISTINCT (l_partkey, l_suppkey)) AS n_repeated,
        count(DISTINCT (l_partkey, l_suppkey)) > 1 AS conflict FROM lineitem GROUP BY l_orderkey, l_linenumber"""
)
def conflicting_duplicates(t: Tables) -> DataFrame:
    return merge.conflicting(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


# ---- joins


@query("SELECT n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'")
def scope_partition(t: Tables) -> DataFrame:
    rows = t.nation.join(t.region, F.expr("n_regionkey = r_regionkey")).withColumn("conference", F.lower("r_name"))
    return rows.where(publish.scope(conference="asia")).select("n_nationkey", "n_name")


@query(
    """SELECT c_custkey, coalesce(n, 0) AS n_orders, last_order FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey"""
)
def previous_left_join(t: Tables) -> DataFrame:
    prior = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.max("o_orderdate").alias("last_order"))
    return joins.with_previous(t.customer.select("c_custkey"), prior, ["c_custkey"], {"n_orders": F.lit(0)})


@query(
    """SELECT source, CASE WHEN l.doc_id IS NULL THEN 'noProvider' WHEN quality = 1 THEN 'verified' ELSE 'unverified' END AS mapping, count(*) AS n
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2"""
)
def provider_mapping_status(t: Tables) -> DataFrame:
    labels = t.labels.withColumn("known", F.lit(True))
    mapping = providers.mapping_status(F.col("known"), F.col("quality") == 1)
    out = t.documents.select("doc_id", "source").join(labels, "doc_id", "left")
    return out.groupBy("source", mapping.alias("mapping")).agg(F.count("*").alias("n"))


_FEEDS = [("f1", None, None), ("f2", 3, None), ("f3", None, 2), ("f4", 5, 0), ("f5", 3, 3)]
_FEEDS_SQL = ", ".join(f"('{f}', {'NULL' if a is None else a}::INTEGER, {'NULL' if b is None else b}::INTEGER)" for f, a, b in _FEEDS)


@query(
    f"""SELECT n.n_nationkey AS school, n.n_regionkey AS sport, f.feed FROM nation n JOIN (VALUES {_FEEDS_SQL}) f(feed, school, sport)
    ON (f.school IS NULL OR f.school = n.n_nationkey) AND (f.sport IS NULL OR f.sport = n.n_regionkey)"""
)
def feed_wildcard_join(t: Tables) -> DataFrame:
    feeds = t.spark.createDataFrame(_FEEDS, "feed string, school int, sport int")
    programs = t.nation.select(F.col("n_nationkey").alias("school"), F.col("n_regionkey").alias("sport"))
    return joins.wildcard_join(programs, feeds, ["school", "sport"]).select("school", "sport", "feed")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def missing_expected(t: Tables) -> DataFrame:
    seen = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.missing(t.customer, seen, ["c_custkey"])


@query(
    """WITH x AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 100)
    SELECT user_id, count(*) AS n_seen, user_id IN (SELECT user_id FROM x) AS expected FROM events WHERE event_type = 'signup' GROUP BY user_id
    HAVING count(*) > 1 OR user_id NOT IN (SELECT user_id FROM x)"""
)
def unexpected_or_duplicate(t: Tables) -> DataFrame:
    seen = t.events.where("event_type = 'signup'").select("user_id")
    return joins.unexpected_or_repeated(seen, t.events.where("event_type = 'purchase' and value > 100"), ["user_id"])


@query(
    """SELECT k AS n_nationkey, 'left' AS side FROM (SELECT n_nationkey AS k FROM nation WHERE n_regionkey <> 0 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 0)
    UNION ALL SELECT k, 'right' FROM (SELECT s_nationkey AS k FROM supplier WHERE s_acctbal > 0 EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey <> 0)"""
)
def set_equality_check(t: Tables) -> DataFrame:
    right = t.supplier.where("s_acctbal > 0").select(F.col("s_nationkey").alias("n_nationkey"))
    return joins.set_difference(t.nation.where("n_regionkey <> 0"), right, ["n_nationkey"])


@query(
    "SELECT p_name || ' ' || p_size AS alias, min(p_brand) AS owner FROM part GROUP BY p_name || ' ' || p_size HAVING count(DISTINCT p_brand) = 1"
)
def alias_unique_owner(t: Tables) -> DataFrame:
    return joins.unique_owner(t.part.select(F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("alias"), F.col("p_brand").alias("owner")), "alias", "owner")


_TEAMS = [(1, "customer 1"), (2, "The University of Customer 2"), (3, "Customer 3 College"), (4, "Nobody"), (5, "customer#000000005")]


@query(
    """WITH s AS (SELECT c_custkey AS school, lower(c_name) AS exact, 'customer ' || c_custkey AS loose FROM customer),
    l(team, name) AS (VALUES (1, 'customer 1'), (2, 'the university of customer 2'), (3, 'customer 3 college'), (4, 'nobody'), (5, 'customer#000000005')),
    k AS (SELECT team, name AS exact, trim(regexp_replace(regexp_replace(trim(regexp_replace(name, '[^a-z0-9]+', ' ', 'g')), '\\b(university|college|the|of)\\b', ' ', 'g'), ' +', ' ', 'g')) AS loose FROM l)
    SELECT team, coalesce(e.school, o.school) AS school, CASE WHEN e.school IS NOT NULL THEN 'exact' WHEN o.school IS NOT NULL THEN 'loose' ELSE 'none' END AS how
    FROM k LEFT JOIN s e ON k.exact = e.exact LEFT JOIN s o ON k.loose = o.loose"""
)
def match_provider_school(t: Tables) -> DataFrame:
    teams = t.spark.createDataFrame(_TEAMS, "team int, name string")
    teams = teams.select("team", F.lower("name").alias("exact"), text.school_name_key(F.col("name")).alias("loose"))
    schools = t.customer.select(
        F.col("c_custkey").alias("school"), F.lower("c_name").alias("exact"), F.concat(F.lit("customer "), F.col("c_custkey").cast("string")).alias("loose")
    )
    return joins.match_unique(teams, schools, "team", "school", "exact", "loose")


@query(
    """WITH d AS (SELECT event_id, ts, date_trunc('day', ts) AS day FROM events)
    SELECT event_id, (SELECT max(s) FROM (VALUES (day + INTERVAL 139 MINUTES), (day + INTERVAL 859 MINUTES), (day - INTERVAL 1 DAY + INTERVAL 859 MINUTES)) v(s) WHERE s <= ts) AS slot
    FROM d"""
)
def asof_slot(t: Tables) -> DataFrame:
    runs = t.events.select("event_id", F.lit("texas-news").alias("lane"), F.col("ts").cast("timestamp").alias("created_at"))
    return slots.run_slots(runs).select("event_id", F.col("slot").cast("timestamp_ntz").alias("slot"))


@query(
    """WITH r AS (SELECT event_id AS run_id, user_id % 3 + 1 AS attempt, user_id, event_type, value, date_trunc('day', ts) AS slot FROM events),
    ok AS (SELECT DISTINCT run_id, attempt FROM r WHERE event_type IN ('purchase', 'view') AND (value > 100 OR user_id % 5 = 0)),
    done AS (SELECT slot, count(DISTINCT run_id) AS n, min(run_id) AS one_run FROM r SEMI JOIN ok USING (run_id, attempt) GROUP BY slot)
    SELECT run_id, NOT coalesce(n > 1 OR one_run <> run_id, FALSE) AS eligible FROM r LEFT JOIN done USING (slot)"""
)
def slot_plan(t: Tables) -> DataFrame:
    runs, jobs = _runs(t)
    return slots.plan(runs, jobs).select("run_id", "eligible")


@query(
    """SELECT DISTINCT event_id AS run_id FROM events WHERE event_type IN ('purchase', 'view') AND (value > 100 OR user_id % 5 = 0)"""
)
def confirmed_receipts(t: Tables) -> DataFrame:
    return slots.confirmed(_runs(t)[1], ["run_id", "attempt"]).select("run_id")


def _runs(t: Tables) -> tuple[DataFrame, DataFrame]:
    e = t.events.withColumn("run_id", F.col("event_id")).withColumn("attempt", F.col("user_id") % 3 + 1)
    runs = e.select("run_id", "attempt", F.lit("news").alias("lane"), F.date_trunc("day", "ts").alias("slot"))
    jobs = e.select(
        "run_id", "attempt", F.lit("maintain").alias("job"), F.lit("completed").alias("status"),
        F.col("event_type").isin("purchase", "view").alias("published"),
        F.when(F.col("value") > 100, "success").otherwise("failure").alias("conclusion"), (F.col("user_id") % 5 == 0).alias("confirmed"),
    )
    return runs, jobs


@query(
    """WITH p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts, event_id AS seen FROM events WHERE event_type = 'view')
    SELECT p.event_id, v.seen AS last_view FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts"""
)
def asof_last_view(t: Tables) -> DataFrame:
    e = t.events
    views = e.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("last_view"))
    rows = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return joins.as_of(rows, "ts", views, "ts", ["user_id"], "last_view").select("event_id", "last_view")


# ---- aggregates and state


@query(
    """SELECT n_regionkey AS conference, count(*) AS programs, count(*) FILTER (s_nationkey % 5 <> n_regionkey) AS affiliates
    FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_regionkey"""
)
def affiliate_count(t: Tables) -> DataFrame:
    rows = t.supplier.join(t.nation, F.expr("s_nationkey = n_nationkey"))
    programs = rows.select(
        F.col("s_nationkey").alias("school"), F.col("s_suppkey").alias("sport"), F.col("n_regionkey").alias("primary_conference"), (F.col("s_nationkey") % 5).alias("conference")
    )
    found = discovery.import_evidence(programs, ["primary_conference"])
    return found.select(F.col("primary_conference").alias("conference"), "programs", "affiliates")


@query("SELECT r_name, string_agg(n_name, ',' ORDER BY n_name) AS members FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name")
def affiliations_collect(t: Tables) -> DataFrame:
    rows = t.region.join(t.nation, F.expr("r_regionkey = n_regionkey"))
    return discovery.affiliations(rows, "r_name", "n_name").select("r_name", F.array_join("members", ",").alias("members"))


@query(
    """SELECT user_id, count(*) AS records, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (value > 40) AS with_image,
        count(DISTINCT event_type) AS sources FROM events GROUP BY user_id"""
)
def summarize_school(t: Tables) -> DataFrame:
    found = health.summarize(t.events, ["user_id"], "event_type", F.col("value") > 40, ["error"], "event_type")
    return found.withColumnRenamed("error", "errors")


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def count_by(t: Tables) -> DataFrame:
    return discovery.count_by(t.documents, "lang")


@query(
    f"""WITH {_ARTICLES} SELECT program, count(*) AS articles, count(image_url) AS with_images, max(published_at) AS newest,
        coalesce((epoch_ms({NOW}) - epoch_ms(max(published_at))) / 3600000.0 > 336, TRUE) AS needs_review FROM articles GROUP BY program"""
)
def program_health(t: Tables) -> DataFrame:
    return health.news_metrics(articles(t), ["program"], _NOW(NOW))


def source_states(t: Tables) -> DataFrame:
    """Attempts at each program's sources and what they come to."""
    e = t.events.groupBy("user_id", "event_type").agg(
        F.count_if(F.col("value") > 80).alias("n_rows"), F.max("ts").alias("at"), F.min("ts").alias("first_at"), F.sum("event_id").alias("s")
    )
    attempts = e.select(
        F.col("user_id").alias("program"), F.col("at"), F.col("event_type").alias("source_url"),
        F.when(F.col("s") % 5 == 0, "timeout").when(F.col("s") % 7 == 0, "http-503").alias("error"), "n_rows",
        (F.col("s") % 2 == 0).alias("empty_confirmed"), F.lit(None).cast("string").alias("reason"),
        F.when(F.col("s") % 3 != 0, F.col("first_at")).alias("prior_success_at"), F.col("event_type").alias("prior_source_url"),
        (F.col("s") % 4).alias("prior_rows"),
    )
    return state.refreshed(attempts)


_STATES = """e AS (SELECT user_id AS program, event_type AS source_url, count(*) FILTER (value > 80) AS n_rows, max(ts) AS at_, min(ts) AS first_at, CAST(sum(event_id) AS BIGINT) AS s
    FROM events GROUP BY ALL),
f AS (SELECT *, CASE WHEN s % 3 <> 0 THEN first_at END AS prior, s % 4 AS prior_rows,
    CASE WHEN s % 5 = 0 THEN 'timeout' WHEN s % 7 = 0 THEN 'http-503' WHEN n_rows = 0 AND s % 4 > 0 AND s % 2 <> 0 THEN 'unexpected-empty-source' END AS failure FROM e),
states AS (SELECT program, source_url, failure AS reason,
    CASE WHEN failure IS NULL THEN (CASE WHEN n_rows > 0 THEN 'ok' ELSE 'empty' END) WHEN prior IS NOT NULL THEN 'stale' ELSE 'unavailable' END AS status,
    CASE WHEN failure IS NULL THEN at_ ELSE prior END AS last_success_at,
    CASE WHEN failure IS NULL THEN n_rows WHEN prior IS NOT NULL THEN prior_rows ELSE 0 END AS record_count FROM f)"""


@query(f"WITH {_STATES} SELECT program, source_url, status, reason, last_success_at, record_count FROM states")
def refresh_state(t: Tables) -> DataFrame:
    return source_states(t).select("program", "source_url", "status", "reason", "last_success_at", "record_count")


@query(
    f"""WITH {_STATES} SELECT program, CASE WHEN count(last_success_at) = 0 THEN 'unavailable' WHEN bool_or(status IN ('stale', 'unavailable')) THEN 'stale'
        WHEN sum(record_count) > 0 THEN 'ok' ELSE 'empty' END AS status, min(last_success_at) AS last_success_at, min(source_url) AS source_url,
        CASE WHEN bool_or(status IN ('stale', 'unavailable')) THEN 'one-or-more-news-sources-degraded' END AS reason, CAST(sum(record_count) AS BIGINT) AS n_records
    FROM states GROUP BY program"""
)
def status_fold(t: Tables) -> DataFrame:
    return state.collection_state(source_states(t), ["program"], "source_url")


@query(f"WITH {_STATES} SELECT program, min(last_success_at) AS oldest_success FROM states WHERE last_success_at IS NOT NULL GROUP BY program")
def oldest_success(t: Tables) -> DataFrame:
    found = state.collection_state(source_states(t), ["program"], "source_url").where("last_success_at is not null")
    return found.select("program", F.col("last_success_at").alias("oldest_success"))


@query(f"WITH {_STATES} SELECT source_url, status, coalesce(reason, '') AS reason, count(*) AS programs FROM states GROUP BY ALL")
def source_health_groups(t: Tables) -> DataFrame:
    return health.source_groups(source_states(t))


@query(
    f"""WITH {_ARTICLES}, c AS (SELECT program, source, count(DISTINCT url) AS n_records FROM articles GROUP BY ALL), d AS (SELECT user_id AS program, event_type AS source, count(*) AS record_count FROM events GROUP BY ALL)
    SELECT program, source, n_records, record_count, n_records <= record_count AS agrees FROM c JOIN d USING (program, source)"""
)
def provenance_counts(t: Tables) -> DataFrame:
    a = articles(t).withColumn("url", urls.canonical_url(F.col("url")))
    declared = t.events.groupBy(F.col("user_id").alias("program"), F.col("event_type").alias("source")).agg(F.count("*").alias("declared"))
    return health.provenance(a, declared, ["program", "source"], "url", "declared")


@query(
    """SELECT o_orderkey, CAST(o_custkey % 8 AS BIGINT) AS declared, coalesce(n, 0) AS found, o_custkey % 8 = coalesce(n, 0) AS agrees
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey"""
)
def declared_total_reconcile(t: Tables) -> DataFrame:
    declared = t.orders.select("o_orderkey", (F.col("o_custkey") % 8).cast("bigint").alias("total"))
    return health.reconcile(declared, t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "total")


_HEALTH = f"""{_STATES}, p AS (
    SELECT program, CASE WHEN count(last_success_at) = 0 THEN 'unavailable' WHEN bool_or(status IN ('stale', 'unavailable')) THEN 'stale'
        WHEN sum(record_count) > 0 THEN 'ok' ELSE 'empty' END AS status, min(last_success_at) AS seen, count(*) AS n_sources, CAST(sum(record_count) AS BIGINT) AS articles FROM states GROUP BY program
), g AS (SELECT user_id AS program, max(ts) AS made, max(ts) FILTER (value > 80) AS last_article FROM events GROUP BY user_id
), h AS (SELECT program, articles, list_filter([
        CASE WHEN status NOT IN ('ok', 'empty') THEN 'news status: ' || status END,
        CASE WHEN seen IS NULL THEN 'no successful news observation' WHEN (epoch_ms({NOW}) - epoch_ms(seen)) / 3600000.0 > 12 THEN 'news observation is overdue' END,
        CASE WHEN (epoch_ms({NOW}) - epoch_ms(made)) / 3600000.0 > 12 THEN 'snapshot is overdue' END], lambda x: x IS NOT NULL) AS issues,
        list_filter([CASE WHEN articles = 0 THEN 'no published articles' WHEN last_article IS NULL THEN 'article publication dates are unknown'
            WHEN (epoch_ms({NOW}) - epoch_ms(last_article)) / 3600000.0 > 336 THEN 'publisher content age needs review' END], lambda x: x IS NOT NULL) AS warnings
    FROM p JOIN g USING (program))"""


def program_reports(t: Tables) -> DataFrame:
    sources = source_states(t)
    n = sources.groupBy("program").agg(F.count("*").alias("n_sources"))
    made = t.events.groupBy(F.col("user_id").alias("program")).agg(
        F.max("ts").alias("made"), F.max(F.when(F.col("value") > 80, F.col("ts"))).alias("last_article")
    )
    out = state.collection_state(sources, ["program"], "source_url").join(n, "program").join(made, "program")
    now = _NOW(NOW)
    return out.select(
        "program", F.col("n_records").alias("articles"),
        health.program_issues(F.col("status"), F.col("last_success_at"), F.col("made"), F.col("n_sources"), now).alias("issues"),
        health.program_warnings(F.col("n_records"), F.col("last_article"), now).alias("warnings"),
    )


@query(f"WITH {_HEALTH} SELECT program, articles, array_to_string(issues, '; ') AS issues, array_to_string(warnings, '; ') AS warnings FROM h")
def football_health(t: Tables) -> DataFrame:
    return program_reports(t).select("program", "articles", F.array_join("issues", "; ").alias("issues"), F.array_join("warnings", "; ").alias("warnings"))


@query(
    f"""WITH {_HEALTH}, x AS (SELECT c_custkey AS program FROM customer)
    SELECT count(*) AS checked_programs, count(*) FILTER (len(issues) = 0) AS healthy_programs, count(*) FILTER (len(warnings) > 0) AS programs_to_review,
        CAST(sum(articles) AS BIGINT) AS articles, count(*) FILTER (articles = 0) AS programs_without_articles,
        (SELECT count(*) FROM x WHERE program NOT IN (SELECT program FROM h)) AS missing_programs, (SELECT count(*) FROM x) AS expected_programs,
        CAST(sum(len(issues)) AS BIGINT) AS issue_count, (SELECT count(*) FROM x) - count(*) FILTER (len(issues) = 0) AS repair_programs,
        sum(len(issues)) = 0 AND (SELECT count(*) FROM x WHERE program NOT IN (SELECT program FROM h)) = 0 AS passed FROM h"""
)
def health_totals(t: Tables) -> DataFrame:
    expected = t.customer.select(F.col("c_custkey").alias("program"))
    return health.health_report(expected, program_reports(t), "program")


@query(
    """WITH line AS (SELECT n_regionkey, n_name || '|' || n_nationkey || chr(10) AS body FROM nation),
    f AS (SELECT n_regionkey, sha256(string_agg(body, '' ORDER BY body)) AS sha256, CAST(sum(strlen(body)) AS BIGINT) AS bytes FROM line GROUP BY n_regionkey)
    SELECT n_regionkey, sha256, bytes, CAST(sum(bytes) OVER (ORDER BY n_regionkey) AS BIGINT) AS running FROM f"""
)
def manifest_digest(t: Tables) -> DataFrame:
    body = F.concat("n_name", F.lit("|"), F.col("n_nationkey").cast("string"), F.lit("\n"))
    files = t.nation.select("n_regionkey", body.alias("body")).groupBy("n_regionkey").agg(
        F.array_join(F.sort_array(F.collect_list("body")), "").alias("text")
    )
    files = files.select("n_regionkey", text.digest(F.col("text")).alias("sha256"), F.octet_length("text").cast("bigint").alias("bytes"))
    return publish.running_size(files, "n_regionkey").drop("fits")


_RULES = {
    "quantity-positive": "l_quantity > 0",
    "discount-below-tax": "l_discount <= l_tax + 0.05",
    "shipped-after-start": "l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'",
    "flag-known": "l_returnflag IN ('A', 'N')",
}


@query(" UNION ALL ".join(f"SELECT '{r}' AS rule, CAST(l_orderkey AS VARCHAR) AS key FROM lineitem WHERE NOT coalesce({c}, FALSE)" for r, c in _RULES.items()))
def violations(t: Tables) -> DataFrame:
    return health.violations(t.lineitem, "l_orderkey", {name: F.expr(rule) for name, rule in _RULES.items()})


@query(
    f"""WITH {_STATES}, v AS (SELECT program || '/' || source_url AS key, status, record_count AS n_records, last_success_at FROM states)
    SELECT key, 'ok-has-rows' AS rule FROM v WHERE status = 'ok' AND n_records = 0 UNION ALL
    SELECT key, 'success-before-attempt' FROM v WHERE last_success_at > TIMESTAMP '2024-01-29 00:00:00'"""
)
def snapshot_violations(t: Tables) -> DataFrame:
    at = F.expr("TIMESTAMP_NTZ '2024-01-29 00:00:00'")
    rows = source_states(t).select(
        F.concat_ws("/", F.col("program").cast("string"), "source_url").alias("key"), "status", F.col("record_count").alias("n_records"),
        at.alias("last_attempt_at"), "last_success_at", "source_url", F.expr(NOW).alias("generated_at"),
    )
    return health.violations(rows, "key", health.snapshot_rules(F.expr(NOW)))


# ---- windows


@query(
    f"""WITH {_ARTICLES} SELECT program, pos, row_number() OVER (PARTITION BY program ORDER BY metadata_checked_at IS NOT NULL, image_url IS NOT NULL, pos) AS enrich_rank FROM articles
    WHERE (image_url IS NULL OR author IS NULL) AND (metadata_checked_at IS NULL OR metadata_checked_at <= {NOW} - INTERVAL 7 DAYS)"""
)
def enrichment_rank(t: Tables) -> DataFrame:
    rows = articles(t).where(windows.needs_enrichment(_NOW(NOW)))
    return windows.enrichment_rank(rows, ["program"]).select("program", "pos", "enrich_rank")


@query(
    """WITH c AS (SELECT user_id, event_type, count(*) FILTER (value > 60) AS wanted FROM events GROUP BY ALL),
    s AS (SELECT *, least(wanted, 5) AS asked, coalesce(sum(least(wanted, 5)) OVER (PARTITION BY user_id ORDER BY event_type <> 'signup', event_type
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken FROM c)
    SELECT user_id, event_type, wanted, CAST(greatest(0, least(asked, 12 - taken)) AS BIGINT) AS budget FROM s"""
)
def metadata_budget(t: Tables) -> DataFrame:
    rows = t.events.groupBy("user_id", "event_type").agg(F.count_if(F.col("value") > 60).alias("wanted"))
    order = [F.col("event_type") != "signup", F.col("event_type")]
    return windows.running_budget(rows, "user_id", order, "wanted", 5, 12).withColumn("budget", F.col("budget").cast("bigint"))


@query(
    """WITH d AS (SELECT user_id, props AS url, max(ts) AS ts FROM events GROUP BY ALL)
    SELECT user_id, url, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, url) AS r FROM d) WHERE r <= 10"""
)
def bounded_confirmations(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.col("props").alias("url"), "ts")
    return windows.first_candidates(rows, ["user_id"], "url", "ts")


@query(
    """SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM conversations"""
)
def section_carry_forward(t: Tables) -> DataFrame:
    rows = t.conversations.withColumn("header", F.when(F.col("role") == "user", F.col("text")))
    return windows.carry_forward(rows, ["conv_id"], "turn", "header", "section").select("conv_id", "turn", "section")


@query(
    """SELECT r_name AS conference, n_name AS school, 'v1/conferences/' || lower(r_name) || '/schools/' || lower(n_name) || '.json' AS path,
        count(s_suppkey) AS programs FROM region JOIN nation ON r_regionkey = n_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY r_name, n_name"""
)
def public_index(t: Tables) -> DataFrame:
    schools = t.region.join(t.nation, F.expr("r_regionkey = n_regionkey")).select(F.col("r_name").alias("conference"), F.col("n_name").alias("school"))
    programs = t.supplier.join(t.nation, F.expr("s_nationkey = n_nationkey")).select(F.col("n_name").alias("school"))
    return publish.public_index(schools, programs)
