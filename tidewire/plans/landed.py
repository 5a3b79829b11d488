"""Scans, landed responses, publication: what is written and read again, within bounds, and checked."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire import publish
from tidewire.functions import text
from tidewire.operators import joins, packing, state
from tidewire.plans.registry import Tables, pick, pick_sql, query
from tidewire.scratch import shared_root
from tidewire.sources import catalog, documents, parsers, snapshot_files


def _folder(t: Tables, name: str) -> str:
    return f"{shared_root(t.spark)}/{name}-{uuid.uuid4().hex}"


def _slug(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-")


def _schools(t: Tables) -> DataFrame:
    """Customers as catalog records, some of them broken, written as JSON and read as the catalog is."""
    k = F.col("c_custkey")
    conference = F.struct(F.lit("1").alias("id"), F.concat(F.lit("c"), F.col("c_nationkey").cast("string")).alias("slug"), F.lit("C").alias("name"))
    sport = lambda s: F.struct(F.lit(s).alias("slug"), F.lit(s).alias("code"), F.lit(s).alias("name"), F.lit("men").alias("gender"), conference.alias("conference"))
    listed = F.when(k % 7 == 3, F.array(sport("golf"), sport("golf"))).otherwise(F.array(sport("golf"), sport("rowing")))
    rows = t.customer.select(
        F.when(k % 13 == 4, "Bad Slug").otherwise(_slug(F.col("c_name"))).alias("slug"), F.floor(k / F.when(k % 50 == 1, 2).otherwise(1)).cast("bigint").alias("ncaaId"), F.col("c_name").alias("name"),
        F.when(k % 17 == 6, "http://a.edu/").otherwise("https://a.edu/").alias("athleticsUrl"), conference.alias("conference"), listed.alias("sports"),
    )
    path = _folder(t, "catalog")
    rows.write.json(path)
    return catalog.schools(t.spark, path, lines=True)


@query(
    """WITH k AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 13 = 4 THEN 'Bad Slug' ELSE regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g') END AS slug,
        CAST(c_custkey // CASE WHEN c_custkey % 50 = 1 THEN 2 ELSE 1 END AS BIGINT) AS n FROM customer)
    SELECT slug AS key, 'slug' AS rule FROM k WHERE k % 13 = 4 UNION ALL SELECT slug, 'athletics-url' FROM k WHERE k % 17 = 6 UNION ALL SELECT slug, 'sport-slugs-unique' FROM k WHERE k % 7 = 3
    UNION ALL SELECT slug, 'slug-unique' FROM k GROUP BY slug HAVING count(*) > 1 UNION ALL SELECT CAST(n AS VARCHAR), 'ncaaId-unique' FROM k GROUP BY n HAVING count(*) > 1
    UNION ALL SELECT CAST(count(*) AS VARCHAR), 'school-count' FROM k HAVING count(*) NOT BETWEEN 300 AND 500""",
    "S1 A23",
)
def catalog_violations(t: Tables) -> DataFrame:
    return catalog.catalog_violations(_schools(t))


@query("SELECT DISTINCT 'c' || c_nationkey AS slug, 'C' AS name FROM customer", "R19 S1 O4")
def conference_list(t: Tables) -> DataFrame:
    return catalog.conference_list(_schools(t))


@query("SELECT n_nationkey AS school, n_name AS name, 2 AS version FROM nation", "S2")
def absent_sources(t: Tables) -> DataFrame:
    """A registry that is not there is empty; one that is there is read."""
    schema = T.StructType([T.StructField("school", T.IntegerType()), T.StructField("name", T.StringType())])
    path = _folder(t, "sources")
    none = catalog.read_optional(t.spark, path + "-none", schema)
    t.nation.select(F.col("n_nationkey").alias("school"), F.col("n_name").alias("name")).write.json(path)
    return none.withColumn("version", F.lit(1)).unionByName(catalog.read_optional(t.spark, path, schema, lines=True).withColumn("version", F.lit(2)))


@query("SELECT n_name AS school, 'football' AS sport, 'team-' || n_nationkey AS team FROM nation", "S3 S4 S5")
def registries(t: Tables) -> DataFrame:
    """A registry of version 1, read with its schema; another version is refused."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("school", "sport", "team")])
    rows = t.nation.select(F.col("n_name").alias("school"), F.lit("football").alias("sport"), F.concat(F.lit("team-"), F.col("n_nationkey").cast("string")).alias("team"))
    good, bad = _folder(t, "registry"), _folder(t, "registry")
    rows.withColumn("schemaVersion", F.lit(1)).write.json(good)
    rows.withColumn("schemaVersion", F.lit(2)).write.json(bad)
    try:
        return catalog.registry(t.spark, bad, schema, lines=True)
    except ValueError:
        return catalog.registry(t.spark, good, schema, lines=True)


@query(
    """SELECT lower(n_name) AS school, 'golf' AS sport, CAST(row_number() OVER (PARTITION BY n_nationkey ORDER BY c_custkey) - 1 AS INTEGER) AS pos, c_name || ' story' AS title
    FROM nation JOIN customer ON n_nationkey = c_nationkey WHERE c_acctbal > 0""",
    "S6 X1 X2 K1",
)
def previous_snapshots(t: Tables) -> DataFrame:
    """A snapshot per nation, written as a file of its own and read as those of the run before: stories of its customers."""
    rows = _snapshots(t)
    root = _folder(t, "snapshots")
    snapshot_files.register(t.spark)
    rows.write.format(snapshot_files.FORMAT).mode("append").save(root)
    return catalog.snapshot_articles(catalog.snapshots(t.spark, root)).select("school", "sport", "pos", "title")


def _snapshots(t: Tables) -> DataFrame:
    """conference, school, body: a snapshot per nation, of its region."""
    story = F.struct(F.col("c_custkey").alias("k"), F.struct(F.col("c_custkey").cast("string").alias("id"), F.concat("c_name", F.lit(" story")).alias("title")).alias("r"))
    stories = t.customer.where("c_acctbal > 0").groupBy("c_nationkey").agg(F.transform(F.array_sort(F.collect_list(story)), lambda x: x["r"]).alias("records"))
    program = F.struct(F.struct("records").alias("news"))
    snapshot = F.struct(F.lit(1).alias("schemaVersion"), F.struct(F.lower("n_name").alias("slug")).alias("school"), F.create_map(F.lit("golf"), program).alias("sports"))
    rows = t.nation.join(stories, F.expr("n_nationkey = c_nationkey"))
    return rows.select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("conference"), _slug(F.col("n_name")).alias("school"), F.to_json(snapshot).alias("body"))


@query(
    """WITH s AS (SELECT n_regionkey, lower(n_name) AS slug,
            '{"schemaVersion":1,"school":{"slug":"' || lower(n_name) || '"},"sports":{"golf":{"news":{"records":['
            || string_agg('{"id":"' || c_custkey || '","title":"' || c_name || ' story"}', ',' ORDER BY c_custkey) || ']}}}}' AS body
        FROM nation JOIN customer ON n_nationkey = c_nationkey WHERE c_acctbal > 0 GROUP BY n_nationkey, n_regionkey, n_name)
    SELECT 'r' || n_regionkey AS conference, regexp_replace(slug, '[^a-z0-9]+', '-', 'g') AS slug, 'schools/' || regexp_replace(slug, '[^a-z0-9]+', '-', 'g') || '.json' AS path,
        sha256(body) AS sha256, strlen(body) AS bytes FROM s""",
    "X2 X3",
)
def written_manifests(t: Tables) -> DataFrame:
    """The manifests of written snapshots, whose digests are those of the files at their paths."""
    root = _folder(t, "snapshots")
    snapshot_files.register(t.spark)
    _snapshots(t).write.format(snapshot_files.FORMAT).mode("append").save(root)
    told = t.spark.read.option("multiLine", True).schema("conference struct<slug: string>, schools array<struct<slug: string, path: string, sha256: string, bytes: bigint>>")
    listed = told.json(f"{root}/v1/conferences/*/manifest.json").select(F.col("conference.slug").alias("conference"), F.inline("schools"))
    files = t.spark.read.format("binaryFile").load(f"{root}/v1/conferences/*/schools/*.json")
    place = F.regexp_extract("path", "/conferences/([^/]+)/", 1), F.regexp_extract("path", "(schools/[^/]+)$", 1)
    there = files.select(place[0].alias("conference"), place[1].alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    return listed.join(there, ["conference", "path", "sha256", "bytes"]).select("conference", "slug", "path", "sha256", "bytes")


# ---- responses


@query(
    """SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'timeout' WHEN 1 THEN 'http-404' WHEN 2 THEN 'invalid-content-type'
            ELSE CASE WHEN strlen(html) > 3000 THEN 'response-too-large' WHEN coalesce(html, '') = '' AND page_id % 6 = 3 THEN 'empty-response' END END AS error_code,
        CASE WHEN page_id % 6 > 3 AND coalesce(html, '') = '' THEN '' WHEN page_id % 6 > 2 AND strlen(html) BETWEEN 1 AND 3000 THEN html END AS text FROM pages""",
    "S7 S9 S14",
)
def landed_responses(t: Tables) -> DataFrame:
    """Landed pages: errors of the exchange, states, types, bodies plain or compressed, and sizes."""
    k = F.col("page_id")
    pages = t.pages
    encoding = F.when(k % 6 == 4, "gzip").when(k % 6 == 5, "br")
    rows = pages.select(
        "page_id", F.when(k % 6 == 0, "timeout").alias("error"), F.when(k % 6 == 1, 404).otherwise(200).alias("status"),
        F.when(k % 6 == 2, "image/png").otherwise("text/html; charset=utf-8").alias("content_type"), encoding.alias("encoding"), documents.encoded_body(F.col("html"), encoding).alias("body"),
    )
    return documents.accepted(rows, 3000).select("page_id", "error_code", "text")


@query(
    """WITH a AS (SELECT user_id AS url, event_id AS attempt, CASE event_type WHEN 'error' THEN 'timeout' WHEN 'view' THEN 'http-503' WHEN 'click' THEN 'http-404' END AS code FROM events)
    SELECT url, CASE WHEN count(*) FILTER (coalesce(code, '') NOT IN ('timeout', 'http-503')) > 0 THEN arg_min(attempt, attempt) FILTER (coalesce(code, '') NOT IN ('timeout', 'http-503')) ELSE max(attempt) END AS attempt
    FROM a GROUP BY url""",
    "S8",
)
def best_attempts(t: Tables) -> DataFrame:
    code = F.expr("CASE event_type WHEN 'error' THEN 'timeout' WHEN 'view' THEN 'http-503' WHEN 'click' THEN 'http-404' END")
    rows = t.events.select(F.col("user_id").alias("url"), F.col("event_id").alias("attempt"), code.alias("error_code"))
    return documents.best_attempt(rows).select("url", "attempt")


@query(
    """WITH f AS (SELECT user_id, props, min(event_id) AS first FROM events GROUP BY ALL), p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY first, props) > 5 AS over FROM f)
    SELECT event_id, CASE WHEN over THEN 'school-request-budget-exhausted' END AS error_code FROM events JOIN p USING (user_id, props)""",
    "S10",
)
def request_budget(t: Tables) -> DataFrame:
    return documents.within_budget(t.events, "user_id", "props", "event_id", 5).select("event_id", "error_code")


@query(
    """WITH p AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page FROM events), d AS (SELECT *, CAST(user_id % 7 AS INTEGER) AS total FROM p)
    SELECT user_id, count(*) AS found, max(total) AS declared, count(*) = max(total) AS complete FROM d WHERE page <= 10 AND page - 1 < total GROUP BY user_id""",
    "S11",
)
def paged_listings(t: Tables) -> DataFrame:
    """Pages of one row each until the declared total is reached."""
    from pyspark.sql import Window

    page = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = t.events.select("user_id", page.alias("page"), F.array("event_id").alias("rows"), (F.col("user_id") % 7).cast("int").alias("total_count"))
    return documents.pages_complete(documents.listed_pages(rows, ["user_id"]), ["user_id"])


@query(
    """WITH a AS (SELECT user_id AS url, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS attempt, event_type, CAST(event_id % 50 AS INTEGER) AS ra FROM events),
    s AS (SELECT *, CASE event_type WHEN 'error' THEN 503 WHEN 'view' THEN 429 WHEN 'click' THEN 404 ELSE 200 END AS status FROM a WHERE attempt <= 3),
    g AS (SELECT url, min(attempt) FILTER (status NOT IN (503, 429)) AS good, max(attempt) AS last FROM s GROUP BY url)
    SELECT url, coalesce(good, last) AS attempt, (SELECT CAST(coalesce(sum(CASE WHEN ra > 0 THEN least(ra, 30) ELSE x.attempt * 2 END), 0) AS BIGINT) FROM s x WHERE x.url = g.url AND x.attempt < coalesce(good, last)) AS waited,
        (SELECT CASE WHEN status <> 200 THEN 'http-' || status END FROM s x WHERE x.url = g.url AND x.attempt = coalesce(good, last)) AS error_code FROM g""",
    "S15",
)
def directory_responses(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    attempt = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    status = F.expr("CASE event_type WHEN 'error' THEN 503 WHEN 'view' THEN 429 WHEN 'click' THEN 404 ELSE 200 END")
    rows = t.events.select(F.col("user_id").alias("url"), attempt.cast("bigint").alias("attempt"), status.alias("status"), (F.col("event_id") % 50).cast("int").alias("retry_after"), F.lit(10).alias("n_bytes"))
    return documents.directory_response(rows)


@query(
    "SELECT c_custkey, 'https://a.edu/sports/golf/' || CASE WHEN c_custkey % 2 = 0 THEN 'schedule' ELSE 'roster' END AS url FROM customer WHERE c_custkey % 3 <> 0",
    "S16",
)
def sitemap_pages(t: Tables) -> DataFrame:
    """The first page of a sitemap that is a sport's schedule or roster, for sites whose robots file names one."""
    k = F.col("c_custkey")
    robots = F.when(k % 3 == 0, "User-agent: *").otherwise("User-agent: *\nSitemap: https://a.edu/s.xml\n")
    named = parsers.parse(t.customer.select("c_custkey", robots.alias("text")), parsers.robots_sitemap, parsers.LOC_ROW, ["c_custkey"]).where("pos = 0").select("c_custkey")
    kind = F.when(k % 2 == 0, "schedule").otherwise("roster")
    xml = F.concat(F.lit("<urlset xmlns='u'><url><loc>https://a.edu/about</loc></url><url><loc> https://a.edu/sports/golf/"), kind, F.lit(" </loc></url><url><loc>https://a.edu/sports/x/roster</loc></url></urlset>"))
    maps = t.customer.select("c_custkey", xml.alias("text")).join(named, "c_custkey")
    from tidewire.operators.discovery import sitemap_page

    return sitemap_page(parsers.parse(maps, parsers.sitemap, parsers.LOC_ROW, ["c_custkey"]), ["c_custkey"])


@query(
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 4 IN (0, 3) THEN 'verified' ELSE 'unavailable' END AS status, CASE c_custkey % 4 WHEN 0 THEN 1 WHEN 3 THEN 0 END AS item_count,
        CASE c_custkey % 4 WHEN 1 THEN 'source-format-changed' WHEN 2 THEN 'timeout' END AS reason, c_custkey % 4 IN (0, 3) AS has_digest FROM customer""",
    "A21 R25 P1",
)
def feed_checks(t: Tables) -> DataFrame:
    """The state of registered feeds: sound, another feed's title, not fetched, without items."""
    k = F.col("c_custkey")
    item = F.when(k % 4 == 3, "").otherwise("<item><title>T</title><link>https://x.org/1</link></item>")
    rss = F.concat(F.lit('<rss version="2.0"><channel><title>'), F.when(k % 4 == 1, "Else").otherwise("Feed"), F.lit("</title>"), item, F.lit("</channel></rss>"))
    feeds = t.customer.select(k.alias("id"), F.when(k % 4 != 2, rss).alias("text"), F.when(k % 4 == 2, "timeout").alias("error_code"), F.lit("Feed").alias("feed_title"))
    parsed = parsers.parse(feeds, parsers.feed, parsers.FEED_ROW, ["id", "feed_title"])
    counted = parsed.groupBy("id").agg(F.count_if(F.col("pos") >= 0).alias("n_items"), F.max("error_code").alias("error_code"))
    out = documents.feed_checks(feeds, counted)
    return out.select("id", "status", "item_count", "reason", F.col("sha256").isNotNull().alias("has_digest"))


# ---- publication


@query(
    """SELECT c_custkey, c_acctbal, 'first' AS version FROM customer
    UNION ALL SELECT c_custkey, CASE WHEN n_regionkey = 2 THEN c_acctbal + 1 ELSE c_acctbal END, 'current' FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 3""",
    "S12 X5 R33",
)
def pinned_versions(t: Tables) -> DataFrame:
    """The pinned first version, and the current one, in which one conference is published anew and another is taken out.

    All others stay as they were; a publisher with an old parent has failed in between.
    """
    root = _folder(t, "published")
    rows = t.customer.join(t.nation, F.expr("c_nationkey = n_nationkey")).select("c_custkey", "c_acctbal", F.col("n_regionkey").alias("conference"))
    first = publish.publish(t.spark, root, {"schools": rows}, None)
    changed = rows.where("conference = 2").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    publish.publish(t.spark, root, {"schools": changed}, first, without={"schools": [3]})
    try:
        publish.publish(t.spark, root, {"schools": rows.limit(0)}, first)
    except publish.Conflict:
        pass
    told = publish.read_version(t.spark, root, "schools", first).withColumn("version", F.lit("first"))
    now = publish.read_version(t.spark, root, "schools").withColumn("version", F.lit("current"))
    return told.unionByName(now).select("c_custkey", "c_acctbal", "version")


@query(
    """SELECT n_regionkey AS conference, version, n_regionkey = 1 AND version = 2 AS written_anew, count(*) AS schools
    FROM nation, (VALUES (1), (2)) v(version) GROUP BY ALL""",
    "X5",
)
def version_parts(t: Tables) -> DataFrame:
    """Which parts of a second version it has written itself: those of the only conference whose rows are others."""
    root = _folder(t, "published")
    rows = t.nation.select("n_nationkey", "n_name", F.col("n_regionkey").alias("conference"))
    first = publish.publish(t.spark, root, {"schools": rows}, None)
    second = publish.publish(t.spark, root, {"schools": rows.withColumn("n_name", F.when(F.col("conference") == 1, F.lower("n_name")).otherwise(F.col("n_name")))}, first)
    parts = publish.parts_of(publish.Store(t.spark, root), second)["schools"]
    own = [int(p["value"]) for p in parts.values() if second in p["path"]]
    told = [publish.read_version(t.spark, root, "schools", v).withColumn("version", F.lit(i)) for i, v in ((1, first), (2, second))]
    counts = told[0].unionByName(told[1]).groupBy("conference", "version").agg(F.count("*").alias("schools"))
    return counts.withColumn("written_anew", F.col("conference").isin(own) & (F.col("version") == 2))


@query(
    """WITH RECURSIVE f AS (
        SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i, CASE WHEN strlen(coalesce(text, '')) > 16000 THEN 0 ELSE strlen(coalesce(text, '')) END AS size,
               strlen(coalesce(text, '')) > 16000 AS alone FROM documents
    ), p AS (SELECT *, sum(size) OVER (ORDER BY i) AS total FROM f), start AS (
        SELECT i, total - size AS base, 0 AS chunk FROM p WHERE i = 1
        UNION ALL
        SELECT p.i, p.total - p.size, chunk + 1 FROM start s JOIN p ON p.i = (SELECT min(q.i) FROM p q WHERE q.i > s.i AND (q.alone OR q.total > s.base + 16000))
    )
    SELECT doc_id, (SELECT max(chunk) FROM start s WHERE s.i <= p.i) AS chunk FROM p""",
    "W11",
)
def upload_chunks(t: Tables) -> DataFrame:
    """Texts packed in their order into requests of 16,000 bytes; a larger one is sent by itself."""
    rows = t.documents.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("size"))
    return packing.greedy_chunks(rows, ["doc_id"], "size", 16_000).select("doc_id", "chunk")


@query(
    "SELECT o_orderkey, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) OVER (ORDER BY o_orderkey) AS BIGINT) AS running, sum(CAST(floor(o_totalprice) AS BIGINT)) OVER (ORDER BY o_orderkey) <= 134217728 AS fits FROM orders",
    "A20",
)
def bundle_sizes(t: Tables) -> DataFrame:
    """Bytes up to each file of a bundle, and whether it still fits."""
    return publish.running_size(t.orders.select("o_orderkey", F.floor("o_totalprice").alias("bytes")), "o_orderkey").drop("bytes")


@query(
    """SELECT 'v1/conferences/' || lower(r_name) || '/schools/' || lower(n_name) || '.json' AS key, unnest(CASE WHEN n_nationkey % 3 = 0 THEN ['digest', 'length'] ELSE ['digest'] END) AS rule
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 3 < 2 UNION ALL SELECT 'extra', unnest(['listed', 'digest-form', 'digest', 'length', 'file-size'])""",
    "X3 X6 K10 O4",
)
def bundle_violations(t: Tables) -> DataFrame:
    """A manifest against the bytes that are there: changed, longer, unlisted."""
    files = t.nation.join(t.region, F.expr("n_regionkey = r_regionkey")).select(F.lower("r_name").alias("conference"), F.lower("n_name").alias("slug"), F.concat(F.lit("{}"), F.col("n_name")).alias("body"), "n_nationkey")
    rows = publish.manifest(files, "conference", "slug", "body")
    k = F.col("n_nationkey")
    body = F.when(k % 3 == 0, F.concat(F.col("body"), F.lit("+"))).when(k % 3 == 1, F.replace(F.col("body"), F.lit("{}"), F.lit("[]"))).otherwise(F.col("body"))
    there = files.select(F.concat(F.lit("v1/conferences/"), F.col("conference"), F.lit("/schools/"), F.col("slug"), F.lit(".json")).alias("path"), body.alias("body"))
    more = t.spark.createDataFrame([("extra", "x")], "path string, body string")
    return publish.manifest_violations(rows, there.unionByName(more))


@query("SELECT n_nationkey, n_nationkey % 3 = 0 AS agrees FROM nation", "K10 T37")
def unchanged_files(t: Tables) -> DataFrame:
    there = t.nation.where("n_nationkey % 3 < 2").select("n_nationkey", F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name")).otherwise("x").alias("body"))
    manifest = t.nation.select("n_nationkey", text.digest(F.col("n_name")).alias("sha256"), F.octet_length("n_name").alias("bytes"))
    return joins.unchanged_files(there, manifest, ["n_nationkey"])


_MANIFESTS = ["2024-01-30T12:00:00.000Z", "2024-01-29T12:00:00.000Z", "2024-02-01T00:00:00.000Z", "2024-01-30T12:00:00Z"]


@query(
    f"""WITH m AS (SELECT r_name AS key, r_regionkey AS k, {pick_sql("r_regionkey", _MANIFESTS)} AS at FROM region)
    SELECT key, 'not-old' AS rule FROM m WHERE k % 4 = 1 UNION ALL SELECT key, 'not-in-future' FROM m WHERE k % 4 = 2 UNION ALL SELECT key, 'canonical-time' FROM m WHERE k % 4 = 3
    UNION ALL SELECT key, unnest(['not-in-future', 'not-old']) FROM m WHERE k % 4 = 3 UNION ALL SELECT key, 'exact-schools' FROM m WHERE k = 2""",
    "X9",
)
def manifest_documents(t: Tables) -> DataFrame:
    n = t.nation.groupBy("n_regionkey").agg(F.collect_set("n_name").alias("schools"))
    rows = t.region.join(n, F.expr("r_regionkey = n_regionkey"))
    k = F.col("r_regionkey")
    manifests = rows.select(
        F.col("r_name").alias("conference"), F.lit(1).alias("version"), pick(k, _MANIFESTS, "string").alias("generated_at"),
        F.when(k == 2, F.slice("schools", 2, 100)).otherwise(F.col("schools")).alias("schools"),
    )
    return publish.manifest_document_violations(manifests, rows.select(F.col("r_name").alias("conference"), "schools"), F.expr("TIMESTAMP '2024-01-31 00:00:00'"))


@query(
    """WITH c AS (SELECT n_name, count(*) AS n, count(*) FILTER (c_acctbal < 0) AS below FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name),
    l AS (SELECT row_number() OVER (ORDER BY n_name) + 1 AS line, '| ' || n_name || ' | ' || n || ' | ' || CASE WHEN below > 0 THEN below || ' \\| below' ELSE '' END || ' |' AS text FROM c)
    SELECT CAST(line AS INTEGER) AS line, text FROM l UNION ALL VALUES (0, '| School | n | note |'), (1, '|---|---|---|')""",
    "X10 T44",
)
def markdown_report(t: Tables) -> DataFrame:
    """A report of nations as its lines, with cells that must be escaped."""
    below = F.count_if(F.col("c_acctbal") < 0)
    rows = t.nation.join(t.customer, F.expr("n_nationkey = c_nationkey")).groupBy(F.col("n_name").alias("School")).agg(
        F.count("*").alias("n"), F.when(below > 0, F.concat(below.cast("string"), F.lit(" | below"))).alias("note")
    )
    return publish.markdown_lines(rows, ["School", "n", "note"], ["School"])


@query("SELECT n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'", "C6 R34 F1 F2")
def run_scope(t: Tables) -> DataFrame:
    """The schools of the conference that a manual run asks for."""
    known = [r[0] for r in t.region.select(F.lower("r_name")).collect()]
    chosen, _ = publish.resolve_scope("workflow_dispatch", "asia", known)
    rows = t.nation.join(t.region, F.expr("n_regionkey = r_regionkey")).withColumn("conference", F.lower("r_name"))
    return rows.where(publish.scope(conference=chosen[0])).select("n_nationkey", "n_name")


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'stale' ELSE 'unavailable' END AS status, CASE WHEN c_custkey % 2 = 0 THEN 'refresh-disabled-news-only' ELSE 'disabled-news-only' END AS reason FROM customer""",
    "R3 C10",
)
def disabled_collections(t: Tables) -> DataFrame:
    status, reason = state.disabled_refresh(F.col("seen"))
    rows = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.expr("TIMESTAMP '2024-01-01 00:00:00'")).alias("seen"))
    return rows.select("c_custkey", status.alias("status"), reason.alias("reason"))


@query("SELECT n_nationkey, 'unavailable' AS status, 'no-source' AS reason, 0 AS n_records FROM nation", "R3")
def empty_datasets(t: Tables) -> DataFrame:
    e = state.empty_dataset(F.expr("TIMESTAMP '2024-01-01 00:00:00'"), F.lit("unavailable"), F.lit("no-source"), F.lit(None).cast("string"))
    return t.nation.select("n_nationkey", e.alias("e")).select("n_nationkey", "e.status", "e.reason", F.size("e.records").alias("n_records"))
