"""Audits of snapshots, reports, registries and files, and the projections that are published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.operators import audit, discovery, enrich, health, joins, windows
from tidewire.plans.registry import Tables, pick, query
from tidewire.plans.relational import _ARTICLES, _HEALTH, _STATES, articles, program_reports, source_states
from tidewire.plans.scalars import NOW

# ---- public values

_TEXTS = ["fine", "a < b", "AKIA" + "A" * 16, "x\ty"]


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS key, field, rule FROM (
        SELECT c_custkey, unnest(['title', 'url', 'publishedAt', 'alt']) AS field, unnest([
            CASE c_custkey % 4 WHEN 1 THEN 'unsafe-text' WHEN 2 THEN 'credential' WHEN 3 THEN 'unsafe-text' END, CASE WHEN c_custkey % 3 = 0 THEN 'unsafe-url' END,
            CASE WHEN c_custkey % 5 = 0 THEN 'noncanonical-instant' END, CASE WHEN c_custkey % 4 = 1 THEN 'unsafe-text' WHEN c_custkey % 4 = 2 THEN 'credential' WHEN c_custkey % 4 = 3 THEN 'unsafe-text' END]) AS rule
        FROM customer) WHERE rule IS NOT NULL""",
    "X8 T3",
)
def public_values(t: Tables) -> DataFrame:
    """Unsafe texts anywhere in nested records."""
    k = F.col("c_custkey")
    said = pick(k, _TEXTS, "string")
    record = F.struct(
        said.alias("title"), F.when(k % 3 == 0, "http://x.org/").otherwise("https://x.org/").alias("url"),
        F.when(k % 5 == 0, "2026-01-01").otherwise("2026-01-01T00:00:00.000Z").alias("publishedAt"), F.array(F.struct(said.alias("alt"))).alias("images"),
    )
    rows = t.customer.select("c_custkey", F.create_map(F.lit("golf"), F.struct(F.array(record).alias("records"))).alias("sports"))
    return audit.public_value_violations(rows, "c_custkey", ["sports"])


# ---- snapshots


@query(
    """WITH r AS (SELECT CAST(c_custkey AS VARCHAR) AS key, c_custkey AS k FROM customer)
    SELECT key, 'name-differs' AS rule FROM r WHERE k % 5 = 1 AND k % 7 <> 0 UNION ALL SELECT key, 'conference-differs' FROM r WHERE k % 6 = 2 AND k % 7 <> 0
    UNION ALL SELECT key, 'sport-inventory' FROM r WHERE k % 4 = 3 AND k % 7 <> 0 UNION ALL SELECT key, 'future' FROM r WHERE k % 9 = 4 UNION ALL SELECT key, 'registered' FROM r WHERE k % 7 = 0""",
    "X7",
)
def snapshot_identities(t: Tables) -> DataFrame:
    """Snapshots against the catalog: unknown schools, other names, conferences, sports, times to come."""
    k = F.col("c_custkey")
    base = t.customer.select(
        k.alias("school"), k.alias("ncaa_id"), F.col("c_name").alias("name"), F.lit("https://a.edu/").alias("athletics_url"), F.lit("https://n.org/").alias("source_url"),
        F.lit("2025-26").alias("academic_year"), F.col("c_nationkey").alias("conference"), F.lit("C").alias("conference_name"), F.array(F.lit("golf"), F.lit("rowing")).alias("sports"),
    )
    s = F.col("school")
    told = base.withColumn("name", F.when(s % 5 == 1, "x").otherwise(F.col("name"))).withColumn("conference", F.when(s % 6 == 2, -1).otherwise(F.col("conference")))
    told = told.withColumn("sports", F.when(s % 4 == 3, F.array(F.lit("golf"))).otherwise(F.array(F.lit("rowing"), F.lit("golf"))))
    told = told.withColumn("generated_at", F.when(s % 9 == 4, F.expr("TIMESTAMP '2024-01-31 00:06:00'")).otherwise(F.expr(NOW)))
    return audit.identity_violations(told, base.where(s % 7 != 0), F.expr(NOW))


@query(
    """WITH r AS (SELECT c_custkey || '/golf' AS key, c_custkey AS k FROM customer)
    SELECT key, 'code-differs' AS rule FROM r WHERE k % 5 = 1 AND k % 7 <> 0 UNION ALL SELECT key, 'gender-differs' FROM r WHERE k % 3 = 2 AND k % 7 <> 0 UNION ALL SELECT key, 'registered' FROM r WHERE k % 7 = 0""",
    "X7",
)
def snapshot_programs(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    base = t.customer.select(
        k.cast("string").alias("school"), F.lit("golf").alias("sport"), F.lit("MGO").alias("code"), F.lit("Golf").alias("name"), F.lit("men").alias("gender"),
        F.col("c_nationkey").alias("conference"), F.lit("C").alias("conference_name"),
    )
    n = F.col("school").cast("bigint")
    told = base.withColumn("code", F.when(n % 5 == 1, "x").otherwise(F.col("code"))).withColumn("gender", F.when(n % 3 == 2, "women").otherwise(F.col("gender")))
    return audit.program_violations(told, base.where(n % 7 != 0), ["school", "sport"])


@query(
    f"""WITH {_STATES}, v AS (SELECT program || '/' || source_url AS key, status, record_count AS n, last_success_at AS seen FROM states)
    SELECT key, 'ok-has-rows' AS rule FROM v WHERE status = 'ok' AND n = 0 UNION ALL SELECT key, 'success-before-attempt' FROM v WHERE seen > TIMESTAMP '2024-01-29 00:00:00'
    UNION ALL SELECT key, 'not-in-future' FROM v UNION ALL SELECT key, 'record-ids-unique' FROM v WHERE n % 2 = 1""",
    "X7 A23",
)
def snapshot_datasets(t: Tables) -> DataFrame:
    """Envelopes of a snapshot that says it is of tomorrow, with an odd record twice."""
    at = F.expr("TIMESTAMP_NTZ '2024-01-29 00:00:00'")
    rows = source_states(t).select(
        F.concat_ws("/", F.col("program").cast("string"), "source_url").alias("key"), "status", F.col("record_count").alias("n_records"), at.alias("last_attempt_at"),
        "last_success_at", "source_url", F.expr("TIMESTAMP '2024-02-01 00:00:00'").alias("generated_at"), (F.col("record_count") - F.col("record_count") % 2).alias("n_ids"),
    )
    return audit.dataset_violations(rows, F.expr(NOW))


@query(
    f"""WITH {_STATES}, {_ARTICLES}, n AS (SELECT program, source AS source_url, count(*) AS attributed FROM articles GROUP BY ALL),
    c AS (SELECT program, CASE WHEN program % 3 = 0 THEN 'ok' WHEN count(last_success_at) = 0 THEN 'unavailable' WHEN bool_or(status IN ('stale', 'unavailable')) THEN 'stale' ELSE 'ok' END AS c_status,
        CASE WHEN count(last_success_at) = 0 THEN 'unavailable' WHEN bool_or(status IN ('stale', 'unavailable')) THEN 'stale' ELSE 'ok' END AS want FROM states GROUP BY program),
    b AS (SELECT s.program, s.source_url, s.status, s.record_count, n.attributed, c.c_status FROM states s JOIN n USING (program, source_url) JOIN c USING (program))
    SELECT program || '/' || source_url AS key, 'provenance-successful' AS rule FROM b WHERE status NOT IN ('ok', 'stale')
    UNION ALL SELECT program || '/' || source_url, 'ok-source' FROM b WHERE status = 'ok' AND record_count <= 0
    UNION ALL SELECT program || '/' || source_url, 'provenance-count' FROM b WHERE record_count < attributed
    UNION ALL SELECT program || '/' || source_url, 'hidden-failure' FROM b WHERE c_status = 'ok' AND status IN ('stale', 'unavailable')
    UNION ALL SELECT CAST(program AS VARCHAR), 'derived-status' FROM c WHERE c_status <> want""",
    "X7 K9 A15 A16 A17",
)
def snapshot_sources(t: Tables) -> DataFrame:
    """Collections against their sources and articles; a third of them claim to be ok."""
    s = source_states(t).withColumn("last_attempt_at", F.expr("TIMESTAMP_NTZ '2024-03-01 00:00:00'")).withColumn("source_order", F.col("source_url"))
    n = articles(t).groupBy("program").agg(F.count("*").alias("n_records"))
    from tidewire.operators.state import collection_state

    c = collection_state(s, ["program"], "source_order", n).withColumn("last_attempt_at", F.expr("TIMESTAMP_NTZ '2024-03-01 00:00:00'"))
    c = c.withColumn("status", F.when(F.col("program") % 3 == 0, "ok").otherwise(F.col("status")))
    a = articles(t).select("program", F.col("source").alias("discovery_source_url"))
    return audit.source_violations(c, s, a, ["program"])


@query(
    """WITH r AS (SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey AS k FROM orders)
    SELECT key, 'date-precision' AS rule FROM r WHERE k % 3 = 0 AND k % 5 = 0 UNION ALL SELECT key, 'metadata-check' FROM r WHERE k % 7 = 1
    UNION ALL SELECT key, 'recruit-sport' FROM r WHERE k % 3 > 0 AND k % 11 = 2 UNION ALL SELECT key, 'recruit-season' FROM r WHERE k % 3 > 0 AND k % 4 = 3
    UNION ALL SELECT key, 'offer-status' FROM r WHERE k % 3 = 2 AND k % 2 = 0 UNION ALL SELECT key, 'recruit-updated' FROM r WHERE k % 3 > 0 AND k % 13 = 5""",
    "X7",
)
def snapshot_records(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    ts = lambda text: F.expr(f"TIMESTAMP '{text}'")
    rows = t.orders.select(
        k.alias("key"), pick(k, ["news", "recruitingBoard", "recruitingOffers"], "string").alias("collection"), ts("2026-01-02 00:00:00").alias("generated_at"),
        F.when(k % 7 == 1, ts("2026-01-03 00:00:00")).when(k % 7 == 2, ts("2026-01-01 00:00:00")).alias("metadata_checked_at"), F.when(k % 5 > 0, ts("2026-01-01 00:00:00")).alias("published_at"),
        F.when(k % 3 == 0, "day").alias("published_at_precision"), F.lit("s").alias("school"), F.lit("golf").alias("sport"), F.lit("s").alias("record_school"),
        F.when(k % 11 == 2, "polo").otherwise("golf").alias("record_sport"), F.lit(2026).alias("class_year"), F.when(k % 4 == 3, "2025").otherwise("2026").alias("season"),
        F.when(k % 2 == 0, "committed").otherwise("offered").alias("recruit_status"), F.when(k % 13 == 5, ts("2026-01-02 00:00:00")).otherwise(ts("2025-01-01 00:00:00")).alias("updated_at"),
        ts("2026-01-01 00:00:00").alias("last_success_at"),
    )
    return audit.record_violations(rows, "key")


# ---- reports


@query(
    f"""WITH {_HEALTH}, x AS (SELECT DISTINCT user_id AS program FROM events WHERE event_type <> 'none' UNION SELECT -1)
    SELECT 'report' AS key, unnest(['healthy-count', 'missing-programs-are-errors', 'passed', 'incomplete-cannot-pass', 'repair-count']) AS rule""",
    "A19 R28",
)
def report_contradictions(t: Tables) -> DataFrame:
    """A report that says it has passed and one program more is healthy than are, with a program missing."""
    p = program_reports(t)
    programs = p.select("program", (F.size("issues") == 0).alias("passed"), F.size("issues").alias("n_issues"), F.size("warnings").alias("n_warnings"))
    expected = p.select("program").unionByName(t.spark.createDataFrame([(-1,)], "program bigint"))
    n = programs.agg(
        (F.count("*") + 1).alias("expected_programs"), F.count("*").alias("checked_programs"), (F.count_if(F.col("passed")) + 1).alias("healthy_programs"),
        F.count_if(~F.col("passed")).alias("repair_programs"), F.count_if(F.col("n_warnings") > 0).alias("review_programs"),
    )
    report = n.withColumn("n_errors", F.lit(1)).withColumn("passed", F.lit(True))
    return audit.report_violations(report, programs, expected, "program")


@query(f"WITH {_HEALTH} SELECT program FROM h WHERE len(issues) > 0 OR len(warnings) > 0", "F15")
def programs_for_attention(t: Tables) -> DataFrame:
    return audit.attention(program_reports(t)).select("program")


@query(
    f"""WITH {_ARTICLES} SELECT program, count(*) AS stories, count(image_url) AS photos, count(image_url) > 0 AND coalesce((epoch_ms({NOW}) - epoch_ms(max(published_at))) / 3600000.0 BETWEEN -24 AND 336, FALSE) AS ok
    FROM articles GROUP BY program""",
    "R36",
)
def recent_coverage(t: Tables) -> DataFrame:
    return audit.recent_coverage(articles(t), ["program"], F.expr(NOW)).select("program", "stories", "photos", "ok")


@query(
    f"""SELECT event_id, ts BETWEEN {NOW} - INTERVAL 12 HOURS AND {NOW} + INTERVAL 5 MINUTES AS current, event_type <> 'error' AS messages FROM events""",
    "R28",
)
def current_observations(t: Tables) -> DataFrame:
    messages = F.array(F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")))
    return t.events.select("event_id", audit.current(F.col("ts"), F.expr(NOW)).alias("current"), audit.message_list(messages).alias("messages"))


# ---- registries and files


@query(
    """WITH r AS (SELECT c_custkey AS k FROM customer), s AS (SELECT k, k || '/' || CASE WHEN k % 5 = 2 THEN 'polo' ELSE 'golf' END AS key FROM r)
    SELECT key, 'known-school' AS rule FROM s WHERE k % 6 = 1 UNION ALL SELECT key, 'known-sport' FROM s WHERE k % 5 = 2 AND k % 6 <> 1 UNION ALL SELECT key, 'reviewed-destination' FROM s WHERE k % 4 = 3""",
    "X14 R37",
)
def registry_violations(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    url = F.when(k % 4 == 3, "https://else.org/").when(k % 4 == 2, F.lit(None)).otherwise(F.concat(F.lit("https://s"), k.cast("string"), F.lit(".edu/x")))
    sources = t.customer.select(k.alias("school"), F.when(k % 5 == 2, "polo").otherwise("golf").alias("sport"), url.alias("url"))
    programs = t.customer.where(k % 6 != 1).select(k.alias("school"), F.lit("golf").alias("sport"))
    hosts = t.customer.select(k.alias("school"), F.concat(F.lit("s"), k.cast("string"), F.lit(".edu")).alias("host"))
    return audit.registry_violations(sources, programs, hosts)


_PATHS = ["src/a.py", "node_modules/x.js", ".env", "conf/key.pem", "docs/output-1/x", "docs/outputs.md"]


@query(
    """WITH f AS (SELECT CAST(doc_id AS VARCHAR) || '/' || (['src/a.py', 'node_modules/x.js', '.env', 'conf/key.pem', 'docs/output-1/x', 'docs/outputs.md'])[CAST(doc_id % 6 AS INTEGER) + 1] AS key, doc_id AS k FROM documents)
    SELECT key, 'forbidden-file' AS rule FROM f WHERE k % 6 BETWEEN 1 AND 4 UNION ALL SELECT key, 'connection-credential' FROM f WHERE k % 5 = 0 UNION ALL SELECT key, 'public-values' FROM f WHERE k % 7 = 0""",
    "X13 R37",
)
def public_tree(t: Tables) -> DataFrame:
    k = F.col("doc_id")
    text = F.concat(F.when(k % 5 == 0, "postgres://u:p@host ").otherwise(""), F.when(k % 7 == 0, "see /home/someone/file").otherwise("fine"))
    return audit.file_violations(t.documents.select(F.concat(k.cast("string"), F.lit("/"), pick(k, _PATHS, "string")).alias("path"), text.alias("text")))


@query(
    "SELECT n_name AS path, CASE n_nationkey % 4 WHEN 1 THEN 'differs' WHEN 2 THEN 'missing' ELSE 'unexpected' END AS state FROM nation WHERE n_nationkey % 4 > 0",
    "X12 R38",
)
def generated_files(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    there = t.nation.where(k % 4 != 2).select(F.col("n_name").alias("path"), F.when(k % 4 == 1, "old").otherwise("text").alias("text"))
    derived = t.nation.where(k % 4 != 3).select(F.col("n_name").alias("path"), F.lit("text").alias("text"))
    return audit.differing_files(there, derived)


@query("SELECT DISTINCT s_nationkey FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey > 1)", "U7")
def outside_known_set(t: Tables) -> DataFrame:
    known = t.nation.where("n_regionkey > 1").select(F.col("n_nationkey").alias("s_nationkey"))
    return audit.subset_violations(t.supplier, known, ["s_nationkey"])


@query("SELECT r_name AS bundle, n_name AS path FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'index', 'v1/index.json'", "U8 X5")
def whole_bundles(t: Tables) -> DataFrame:
    """All bundles and the index, or nothing if anything is wrong."""
    files = t.nation.join(t.region, F.expr("n_regionkey = r_regionkey")).select(F.col("r_name").alias("bundle"), F.col("n_name").alias("path"))
    index = t.spark.createDataFrame([("v1/index.json",)], "path string")
    fine, broken = t.nation.where("n_nationkey < 0"), t.nation.where("n_nationkey = 3")
    return audit.whole_bundle(files, index, fine, "bundle").unionByName(audit.whole_bundle(files, index, broken, "bundle"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1", "A23")
def repeated_keys(t: Tables) -> DataFrame:
    return health.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


# ---- projections


@query(
    """SELECT c_custkey, c_name AS name, c_custkey % 3 AS record_count, CASE WHEN c_custkey % 2 = 0 THEN 'x' END AS profile_url, 'n' || c_nationkey AS conference FROM customer""",
    "J1 J3 J4 J5",
)
def published_projections(t: Tables) -> DataFrame:
    """Envelopes without records, recruits with their optional fields, conferences narrowed; nothing that is for routing only."""
    from tidewire.operators.recruiting import with_defaults

    k = F.col("c_custkey")
    rows = t.customer.select("c_custkey", F.col("c_name").alias("name"), F.lit("for routing").alias("description"), F.lit("2026").alias("season"), F.array_repeat(F.lit("r"), (k % 3).cast("int")).alias("records"),
                             F.struct(F.lit("1").alias("id"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("slug"), F.lit("N").alias("name")).alias("conference"))
    some = rows.where(k % 2 == 0).withColumn("profile_url", F.lit("x"))
    filled = with_defaults(some).unionByName(with_defaults(rows.where(k % 2 == 1)), allowMissingColumns=True)
    out = health.health_projection(discovery.without_routing(filled)).withColumn("conference", discovery.narrowed(F.col("conference")))
    return out.select("c_custkey", "name", F.col("record_count").cast("bigint").alias("record_count"), "profile_url", F.col("conference.slug").alias("conference"))


@query("SELECT c_custkey, c_custkey // 2 AS discovery_source FROM customer", "J2")
def provenance_renamed(t: Tables) -> DataFrame:
    """Records of a page that was followed, as of the page that was asked for."""
    k = F.col("c_custkey")
    rows = t.customer.select("c_custkey", F.floor(k / 2).cast("bigint").alias("asked"), k.alias("discovery_source"))
    return enrich.as_asked(rows, "asked", "discovery_source")


@query(
    """SELECT conv_id, turn, last_value(CASE role WHEN 'user' THEN 'mens' WHEN 'system' THEN 'womens' END IGNORE NULLS) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gender FROM conversations""",
    "W8 W7",
)
def column_genders(t: Tables) -> DataFrame:
    """The gender that the last heading of each column says."""
    rows = t.conversations.select("conv_id", "turn", (F.col("turn") % 2).alias("column"), F.expr("CASE role WHEN 'user' THEN 'mens' WHEN 'system' THEN 'womens' END").alias("said"))
    return windows.carry_forward(rows, ["conv_id", "column"], "turn", "said", "gender").select("conv_id", "turn", "gender")


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'old-' || c_custkey WHEN c_custkey % 4 = 1 THEN 'fixed-' || c_custkey ELSE regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g') END AS slug FROM customer""",
    "R22 T10 O5",
)
def imported_slugs(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    schools = t.customer.select("c_custkey", k.alias("ncaa_id"), F.col("c_name").alias("name"))
    told = lambda word, rows: rows.select(k.alias("ncaa_id"), F.concat(F.lit(word), k.cast("string")).alias("slug"))
    return discovery.imported_slugs(schools, told("old-", t.customer.where(k % 4 == 0)), told("fixed-", t.customer.where(k % 4 < 2))).select("c_custkey", "slug")


@query(
    """SELECT c_custkey, unnest(['MBB', 'WGO']) AS code, unnest(['basketball', 'womens-golf']) AS slug, unnest(['ivy-league', 'big-east']) AS conference, unnest([1, 0]) AS repeated, unnest([FALSE, FALSE]) AS conflict FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT c_custkey, 'MBB', 'basketball', 'big-east', 0, TRUE FROM customer WHERE c_custkey % 2 = 1""",
    "P29 A8",
)
def sponsored_sports(t: Tables) -> DataFrame:
    """Rows of a directory's table: repeated ones count once, differing ones conflict."""
    from tidewire.sources import parsers

    row = lambda *cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    head = "<table><tr><th>Sport</th><th>Coach</th><th>Division</th><th>Conference</th></tr>"
    mbb, other = row("Men's Basketball", "A", "I", "The Ivy League"), row("Men's Basketball", "B", "I", "Big East Conference")
    even, odd = head + mbb + mbb.replace(">A<", ">C<") + row("Women's Golf", "B", "I", "Big East Conference") + "</table>", head + mbb + other + "</table>"
    pages = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, even).otherwise(odd).alias("text"))
    cells = parsers.parse(pages, parsers.table_rows, parsers.TABLE_ROW, ["c_custkey"])
    codes = F.create_map(*map(F.lit, ("Men's Basketball", "MBB", "Women's Golf", "WGO")))
    rows = cells.withColumn("code", codes[F.col("cells")[0]]).where("code is not null")
    return discovery.sponsored_sports(rows, ["c_custkey"]).select("c_custkey", "code", "slug", "conference", "repeated", "conflict")


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 5 = 1 THEN 'override-identity-mismatch' WHEN c_custkey % 5 = 2 THEN 'override-host-mismatch' END AS error_code,
        CASE WHEN c_custkey % 5 < 4 THEN 4 ELSE 2 END AS n_hosts FROM customer""",
    "T25 U4",
)
def source_policies(t: Tables) -> DataFrame:
    """Hosts of schools with reviewed overrides, some of another school or host."""
    k = F.col("c_custkey")
    schools = t.customer.select(k.alias("school"), k.alias("ncaa_id"), F.lit("https://a.edu/").alias("athletics_url"))
    overrides = t.customer.where(k % 5 < 4).select(
        k.alias("school"), F.when(k % 5 == 1, -1).otherwise(k).alias("ncaa_id"), F.lit("https://a.edu/").alias("original_url"), F.lit("https://b.edu/").alias("athletics_url"),
        F.lit("https://n.org/e").alias("evidence_url"), F.when(k % 5 == 2, "https://c.org/n").when(k % 5 == 3, "https://b.edu/n").alias("news_url"),
    )
    return discovery.source_policy(schools, overrides).select(F.col("school").alias("c_custkey"), "error_code", F.size("hosts").alias("n_hosts"))


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'outgoing-reclassification' WHEN c_custkey % 4 = 1 THEN 'no-url-and-no-sports' END AS reason FROM customer""",
    "F16 R22",
)
def split_members(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    members = t.customer.select(
        "c_custkey", F.when(k % 4 == 0, "outgoing").when(k % 4 == 3, "incoming").alias("reclassifying"), F.when(k % 4 != 1, "https://a.edu/").alias("athleticsUrl"),
        F.when(k % 4 == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("golf"))).alias("sports"),
    )
    kept, out = discovery.split_members(members)
    return kept.select("c_custkey", F.lit(None).cast("string").alias("reason")).unionByName(out.select("c_custkey", "reason"))


@query(
    """SELECT c_custkey AS school, CASE c_custkey % 4 WHEN 0 THEN 'not-fetched' WHEN 1 THEN 'http-404' WHEN 2 THEN 'no-sources-found' ELSE 'ok' END AS status FROM customer WHERE c_custkey % 5 <> 0""",
    "R21 X11",
)
def discovery_status(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    pages = t.customer.where(k % 4 != 0).select(k.alias("school"), F.when(k % 4 == 1, "http-404").alias("error_code"), F.when(k % 4 == 2, 0).otherwise(3).alias("n_sources"))
    done = t.customer.where(k % 5 < 2).select(k.alias("school"), F.when(k % 5 == 0, 3).otherwise(2).alias("version"))
    return discovery.discovery_status(t.customer.select(k.alias("school")), pages, done)


@query(
    """WITH d AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value > 60, value > 40, event_id) AS r FROM events WHERE value <= 40 OR event_type = 'error')
    SELECT user_id, event_id FROM d WHERE r <= 5""",
    "R7 W3 F13 O9",
)
def enrichment_requests(t: Tables) -> DataFrame:
    """The articles whose pages are asked for, five per program: never checked first, then those without image."""
    e = t.events
    rows = e.select(
        "user_id", "event_id", F.concat(F.lit("https://x.org/"), F.col("event_id").cast("string")).alias("url"), F.when(F.col("value") > 40, "i").alias("image_url"),
        F.when(F.col("event_type") != "error", "a").alias("author"), F.when(F.col("value") > 60, F.expr("TIMESTAMP_NTZ '2023-01-01 00:00:00'")).alias("metadata_checked_at"), F.col("event_id").alias("pos"),
    )
    return enrich.candidates(rows, ["user_id"], F.expr(NOW)).select("user_id", "event_id")


@query(
    """SELECT event_id, coalesce(CASE WHEN value > 40 THEN 'https://x.org/own.jpg' END, CASE WHEN event_id % 2 = 0 AND event_id % 3 <> 0 THEN 'https://x.org/new.jpg' END) AS image_url,
        coalesce(CASE WHEN event_type <> 'error' THEN 'own' END, CASE WHEN event_id % 2 = 0 AND event_id % 3 <> 0 THEN 'new' END) AS author, event_id % 2 = 0 AS checked FROM events""",
    "R7",
)
def enriched_articles(t: Tables) -> DataFrame:
    """What is known stays, what was found is added, and every article asked for counts as checked."""
    k = F.col("event_id")
    url = F.concat(F.lit("https://x.org/"), k.cast("string"))
    rows = t.events.select(
        "event_id", "user_id", url.alias("url"), F.when(F.col("value") > 40, "https://x.org/own.jpg").alias("image_url"), F.lit(None).cast("string").alias("image_alt"),
        F.when(F.col("event_type") != "error", "own").alias("author"), F.lit(None).cast("timestamp").alias("metadata_checked_at"),
    )
    asked = rows.where(k % 2 == 0)
    found = asked.select("url", F.when(k % 3 == 0, "timeout").alias("error_code"), F.lit("https://x.org/new.jpg").alias("found_image"), F.lit("alt").alias("found_alt"), F.lit("new").alias("found_author"))
    out = enrich.apply_metadata(rows, asked, found, ["user_id"], F.expr(NOW).cast("timestamp"))
    return out.select("event_id", "image_url", "author", F.col("metadata_checked_at").isNotNull().alias("checked"))


@query("SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey", "K2")
def with_previous(t: Tables) -> DataFrame:
    prior = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    return joins.with_previous(t.customer.select("c_custkey"), prior, ["c_custkey"], {"n_orders": F.lit(0)})
