"""Rules on single values, over values that the tables have; their SQL computes each result from the same columns by itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import dates, providers, sports, text, urls
from tidewire.operators import classify, discovery, enrich, official, windows
from tidewire.plans.registry import Tables, query, spread
from tidewire.sources import documents


def _s(name: str) -> Column:
    return F.col(name).cast("string")


def _form(at: Column, pattern: str) -> Column:
    return F.date_format(at, pattern)


# ---- dates

@query(
    """WITH e AS (SELECT event_id, event_type AS kind, date_trunc('second', ts) AS s FROM events)
    SELECT event_id, CASE kind WHEN 'purchase' THEN NULL WHEN 'error' THEN strftime(s - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.000Z') ELSE strftime(s, '%Y-%m-%dT%H:%M:%S.000Z') END AS iso,
        CASE kind WHEN 'error' THEN s - INTERVAL 2 HOUR WHEN 'click' THEN s WHEN 'view' THEN s END AS published,
        CASE WHEN kind IN ('error', 'click', 'view') THEN 'instant' ELSE 'unknown' END AS precision,
        CASE kind WHEN 'purchase' THEN date_trunc('day', s) END AS day FROM e""",
    "T5 T26 T27",
)
def instants_of_events(t: Tables) -> DataFrame:
    """Instants of events as feeds and sites write them: in mails, with a zone, without one, or a day only."""
    at, kind = F.date_trunc("second", "ts"), F.col("event_type")
    v = (
        F.when(kind == "click", F.concat(_form(at, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT"))).when(kind == "view", F.concat(_form(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(kind == "error", F.concat(_form(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).when(kind == "purchase", _form(at, "M/d/yyyy")).otherwise(_form(at, "yyyy-MM-dd HH:mm:ss"))
    )
    rows = t.events.select("event_id", v.alias("v"))
    published = dates.publication_date(F.col("v"))
    ntz = lambda c: c.cast("timestamp_ntz")
    return rows.select("event_id", dates.iso_date(F.col("v")).alias("iso"), ntz(published["at"]).alias("published"), published["precision"].alias("precision"), ntz(dates.day_value(F.col("v"))).alias("day"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS day,
        CASE WHEN o_orderpriority = '1-URGENT' AND year(o_orderdate) >= 2000 THEN o_orderdate END AS conference_day,
        CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderdate END AS static_day,
        CASE WHEN o_orderstatus = 'O' AND year(o_orderdate) >= 2000 THEN year(o_orderdate) || '-' || lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') END AS season FROM orders""",
    "T27 T28 T29 T30",
)
def days_of_orders(t: Tables) -> DataFrame:
    """Days of orders in the forms of sites, on game cards, and as seasons in headings."""
    at, priority, status = F.col("o_orderdate"), F.col("o_orderpriority"), F.col("o_orderstatus")
    v = (
        F.when(priority == "1-URGENT", _form(at, "M/d/yyyy")).when(priority == "2-HIGH", _form(at, "MMMM d, yyyy")).when(priority == "3-MEDIUM", _form(at, "yyyy-MM-dd"))
        .when(priority == "4-NOT SPECIFIED", _form(at, "MMM d, yyyy")).otherwise(_form(at, "d.M.yyyy"))
    )
    toggle = F.when(status == "F", F.concat(F.lit("Hide/Show Additional Information For Else - "), _form(at, "MMMM d, yyyy")))
    label = F.when(status == "O", F.concat(F.lit("Box score of Else on "), _form(at, "MMM d yyyy"), F.lit(" at home"))).otherwise(_form(at, "'on' M/d"))
    heading = F.concat(_s("y"), F.lit("-"), F.lpad(((F.col("y") + 1) % 100).cast("string"), 2, "0"), F.when(status == "O", " Golf Roster").otherwise(" Golf Schedule"))
    rows = t.orders.withColumn("y", F.year(at))
    ntz = lambda c, name: c.cast("timestamp_ntz").alias(name)
    return rows.select(
        "o_orderkey", ntz(dates.day_value(v), "day"), ntz(dates.conference_day(v), "conference_day"),
        ntz(dates.static_day(F.lit(None).cast("string"), toggle, label), "static_day"), dates.season_of(heading, "roster").alias("season"),
    )


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%MZ') AS label,
        CASE WHEN ts >= date_trunc('day', ts) + INTERVAL 859 MINUTE THEN date_trunc('day', ts) + INTERVAL 859 MINUTE
             WHEN ts >= date_trunc('day', ts) + INTERVAL 139 MINUTE THEN date_trunc('day', ts) + INTERVAL 139 MINUTE
             ELSE date_trunc('day', ts) - INTERVAL 1 DAY + INTERVAL 859 MINUTE END AS slot,
        year(ts) + CASE WHEN month(ts) >= 3 THEN 1 ELSE 0 END AS cycle FROM events""",
    "T45 W6 K22 T31",
)
def slots_of_events(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", dates.slot_label(F.col("ts")).alias("label"), windows.latest_slot(F.col("ts").cast("timestamp"), [139, 859]).cast("timestamp_ntz").alias("slot"),
        dates.recruiting_cycle(F.col("ts")).alias("cycle"),
    )


# ---- texts and names

_WORDS = "trim(regexp_replace(replace(lower(strip_accents(coalesce(text, ''))), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"
_PHRASE = "CASE lang WHEN 'en' THEN 'and the' WHEN 'de' THEN 'die' WHEN 'fr' THEN 'des' ELSE 'la' END"


@query(
    f"""WITH w AS (SELECT doc_id, lang, text, {_WORDS} AS words FROM documents)
    SELECT doc_id, md5(words) AS literal, md5(trim(regexp_replace(regexp_replace(words, '\\b(university|college|the|of)\\b', ' ', 'g'), ' +', ' ', 'g'))) AS key,
        md5(trim(regexp_replace(replace(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[''’"]', '', 'g'), '&', ' and '), '[^a-z0-9]+', '-', 'g'), '-')) AS slug,
        contains(' ' || words || ' ', ' ' || {_PHRASE} || ' ') AS has_phrase FROM w""",
    "T10 T14 T15 T16",
)
def keys_of_texts(t: Tables) -> DataFrame:
    """Whole texts as words, as names without their common words, as slugs, and whether they have their language's phrase."""
    folded = text.fold(F.coalesce("text", F.lit("")))
    rows = t.documents.select("doc_id", "lang", folded.alias("v"))
    words = text.ascii_words(F.col("v"))
    return rows.select(
        "doc_id", F.md5(words.cast("binary")).alias("literal"), F.md5(text.school_name_key(F.col("v")).cast("binary")).alias("key"),
        F.md5(text.slugify_ascii(F.col("v")).cast("binary")).alias("slug"), text.has_phrase(words, F.expr(_PHRASE)).alias("has_phrase"),
    )


@query(
    r"""WITH n AS (SELECT c_custkey, lower(replace(c_name, '#', '-')) AS word, c_mktsegment AS m, c_custkey % 3 AS r FROM customer)
    SELECT c_custkey, regexp_replace(word, '[^a-z0-9]+', ' ', 'g') || CASE m WHEN 'BUILDING' THEN ' wins 3 2' ELSE '' END AS identity,
        CASE m WHEN 'BUILDING' THEN 'basketball' WHEN 'MACHINERY' THEN 'coed-' || word WHEN 'FURNITURE' THEN 'mens-' || word || '-and-diving' ELSE word END AS sport,
        CASE m WHEN 'HOUSEHOLD' THEN NULL ELSE word END AS conference FROM n""",
    "T9 T11 T12",
)
def slugs_of_names(t: Tables) -> DataFrame:
    """Names of customers as titles, sports and conferences, decorated by their segment."""
    name, m = F.col("c_name"), F.col("c_mktsegment")
    title = F.when(m == "BUILDING", F.concat(F.lit("<b> "), F.upper(name), F.lit("</b>  Wins, 3—2!"))).otherwise(F.concat(F.lit("“"), name, F.lit("”")))
    sport = F.when(m == "MACHINERY", F.concat(F.lit("Mixed "), name)).when(m == "FURNITURE", F.concat(F.lit("Men's "), name, F.lit(" & Diving"))).otherwise(name)
    code = F.when(m == "BUILDING", "MBB").otherwise("XXX")
    conference = F.when(m == "BUILDING", F.concat(F.lit("The "), name)).when(m == "MACHINERY", F.concat(F.lit("the "), name, F.lit("  Conference"))).when(m == "HOUSEHOLD", "  ").otherwise(name)
    return t.customer.select(
        "c_custkey", enrich.title_identity(title).alias("identity"), discovery.sport_key(sport, code).alias("sport"), discovery.conference_key(conference).alias("conference")
    )




@query(
    """WITH o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place,
            CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS name FROM orders),
    u AS (SELECT o_custkey, name, min(place) AS place FROM o WHERE place <= 8 AND name IS NOT NULL GROUP BY ALL),
    j AS (SELECT o_custkey, string_agg(name, ', ' ORDER BY place) AS authors FROM u GROUP BY 1)
    SELECT DISTINCT o.o_custkey, authors FROM o LEFT JOIN j USING (o_custkey)""",
    "T35 O9",
)
def authors_of_customers(t: Tables) -> DataFrame:
    """Bylines: the priorities of a customer's first eight orders, each once, without those that say nothing."""
    name = F.when(F.col("o_orderpriority") == "5-LOW", "null").when(F.col("o_orderstatus") == "F", F.concat(F.lit(" By: "), "o_orderpriority")).otherwise(F.col("o_orderpriority"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", name.alias("n")))), lambda x: x["n"])
    return t.orders.groupBy("o_custkey").agg(text.authors(listed).alias("authors"))


@query("SELECT s_suppkey, s_name || CASE WHEN s_acctbal < 0 THEN ' at ' ELSE ' vs ' END || n_name AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey", "J7")
def names_of_games(t: Tables) -> DataFrame:
    rows = t.supplier.join(t.nation, F.expr("s_nationkey = n_nationkey"))
    where = F.when(F.col("s_acctbal") < 0, "away").when(F.col("s_acctbal") < 5000, "home")
    return rows.select("s_suppkey", official.game_name(F.concat(F.lit(" <i>"), "s_name", F.lit("</i>  ")), F.col("n_name"), where).alias("name"))


# ---- sports

_KIND = "CASE WHEN p_size < 12 THEN 'mens' WHEN p_size < 24 THEN 'womens' WHEN p_size < 30 THEN 'mens' WHEN p_size < 36 THEN 'womens' END"


@query(
    f"""WITH p AS (SELECT p_partkey, p_name, {_KIND} AS said, CASE WHEN p_type < 'M' THEN 'mens' ELSE 'womens' END AS expected, p_type FROM part)
    SELECT p_partkey, CASE WHEN said IS NULL THEN p_name ELSE said || ' ' || p_name END AS label, coalesce(CASE WHEN p_type = 'PROMO' THEN 'coed' END, said) AS gender, p_name AS base,
        coalesce(said <> expected, FALSE) AS conflict, coalesce(said = 'mens', FALSE) AS hit, NOT (p_type = 'PROMO') OR expected = 'coed' AS on_roster FROM p""",
    "T17 T18 T19 F8 F10 R12 T46",
)
def sports_of_parts(t: Tables) -> DataFrame:
    """Names of parts as sports, with their gender said in several ways."""
    size, name = F.col("p_size"), F.col("p_name")
    label = (
        F.when(size < 12, F.concat(F.lit("Men’s "), name)).when(size < 24, F.concat(F.upper(name), F.lit(" - Women's"))).when(size < 30, F.concat(name, F.lit(" (M)")))
        .when(size < 36, F.concat(F.lit("Female  "), name)).otherwise(F.initcap(name))
    )
    rows = spread(t.part, "p_partkey").select("p_partkey", "p_name", "p_type", label.alias("l"), F.when(F.col("p_type") < "M", "mens").otherwise("womens").alias("expected"))
    declared, l = F.when(F.col("p_type") == "PROMO", "X"), F.col("l")  # noqa: E741
    return rows.select(
        "p_partkey", sports.normal_label(l).alias("label"), sports.sport_gender(declared, l, F.lit(None).cast("string")).alias("gender"),
        sports.sport_family(sports.base_sport(l, F.lit("x"))).alias("base"), official.label_conflicts(F.array(l), F.col("expected"), F.lit("mens-golf")).alias("conflict"),
        official.labels_match(F.array(F.lit("Tickets"), F.concat(F.lit("All; "), l)), F.array(F.concat(F.lit("mens "), "p_name"))).alias("hit"),
        official.roster_gender_matches(declared, F.col("expected")).alias("on_roster"),
    )


@query(
    """SELECT DISTINCT replace(p_name, ' ', '-') AS slug, CASE WHEN p_size < 20 THEN 'men' ELSE 'women' END AS gender, p_name AS term FROM part""",
    "R6",
)
def terms_of_parts(t: Tables) -> DataFrame:
    """Terms by which headlines name sports; parts stand for programs."""
    gender = F.when(F.col("p_size") < 20, "men").otherwise("women")
    name = F.concat(F.when(F.col("p_size") < 10, "Men's ").when(F.col("p_size") < 20, "").otherwise("Women's "), F.initcap("p_name"))
    return classify.sport_terms(t.part.select(F.replace("p_name", F.lit(" "), F.lit("-")).alias("slug"), gender.alias("gender"), name.alias("name")))


# ---- addresses

@query(
    r"""WITH p AS (SELECT page_id, html, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, regexp_replace(url, '^https?://[^/?#]*', '') AS rest, url FROM pages),
    q AS (SELECT *, regexp_replace(rest, '#.*$', '') AS bare FROM p)
    SELECT page_id, 'https://' || host || CASE WHEN bare LIKE '/%' THEN bare ELSE '/' || bare END AS athletics_url,
        CASE WHEN url LIKE 'https://%' THEN array_to_string(list_sort([host, CASE WHEN host LIKE 'www.%' THEN host[5:] ELSE 'www.' || host END]), ',') ELSE '' END AS hosts,
        CASE WHEN url LIKE 'https://%' AND strlen(html) > 2500 AND NOT regexp_matches(regexp_replace(bare, '\?.*$', ''), '(?i)\.(pdf|jpg|png|gif|mp4|zip)$')
             THEN 'https://' || host || CASE WHEN bare LIKE '/%' THEN bare ELSE '/' || bare END END AS official_link,
        CASE WHEN strlen(html) <= 2500 THEN NULL WHEN regexp_matches(bare, '^/en/[0-9]+(\?|$)') THEN TRUE ELSE FALSE END AS in_scope FROM q WHERE html IS NOT NULL""",
    "T13 T25 U4 F14 R20 P3",
)
def addresses_of_pages(t: Tables) -> DataFrame:
    """Addresses of pages as athletics sites, with their hosts; which are links of their own site, if it is a large page's."""
    rows = t.pages.where("html is not null").select("page_id", "url", F.octet_length("html").alias("n"))
    host = F.regexp_extract("url", "^https?://([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "#.*$", "")
    written = F.when(F.col("n") % 2 == 0, F.concat(F.lit(" "), bare, F.lit("#x"))).otherwise(F.regexp_replace("url", "^https:", "HTTPS:"))
    own = F.when(F.col("n") > 2500, F.array(host)).otherwise(F.array(F.lit("other.org")))
    scoped = urls.in_article_scope(F.concat(F.lit("https://"), bare), F.when(F.col("n") > 0, "/en/"), F.lit("https://x.org/rss.xml"))
    whole = F.regexp_replace(bare, "^[^/?]*", "").rlike(r"^/en/[0-9]+(\?|$)")
    return rows.select(
        "page_id", urls.athletics_url(written).alias("athletics_url"), F.array_join(F.array_sort(urls.official_hosts(F.col("url"))), ",").alias("hosts"),
        urls.official_link(F.col("url"), own).alias("official_link"), F.when(F.col("n") > 2500, scoped & whole).alias("in_scope"),
    )




@query(
    """WITH a AS (SELECT c_custkey, c_acctbal, c_custkey * 37 % 256 AS a, c_custkey * 11 % 256 AS b, c_custkey % 256 AS c FROM customer)
    SELECT c_custkey, NOT (a IN (0, 10, 127) OR a >= 224 OR (a = 100 AND b BETWEEN 64 AND 127) OR (a = 169 AND b = 254) OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168)
            OR (a = 192 AND b = 0 AND c IN (0, 2)) OR (a = 198 AND b IN (18, 19)) OR (a = 198 AND b = 51 AND c = 100) OR (a = 203 AND b = 0 AND c = 113)) AS public,
        c_acctbal >= 0 AS allowed FROM a""",
    "F20 T2",
)
def addresses_of_customers(t: Tables) -> DataFrame:
    """Which IPv4 addresses made of keys are public, and which addresses a run may ask for."""
    address = F.concat_ws(".", *(F.expr(x) for x in ("c_custkey * 37 % 256", "c_custkey * 11 % 256", "c_custkey % 256", "c_nationkey")))
    url = F.concat(F.when(F.col("c_acctbal") < -500, "http://www.a.edu/").when(F.col("c_acctbal") < 0, "https://b.edu/").otherwise("https://WWW.a.edu/"), _s("c_custkey"))
    return t.customer.select("c_custkey", documents.is_public_address(address).alias("public"), F.coalesce(documents.allowed(url, F.array(F.lit("www.A.edu"))), F.lit(False)).alias("allowed"))


@query(
    """SELECT page_id, CASE WHEN strlen(html) % 2 = 0 THEN sha1(html) END AS commit, sha256(html) AS digest FROM pages WHERE html IS NOT NULL""",
    "T37 T38",
)
def commits_of_pages(t: Tables) -> DataFrame:
    """Digests of pages as commits: those in lower case and of the right length."""
    sha, n = F.sha1(F.col("html").cast("binary")), F.octet_length("html")
    v = F.when(n % 2 == 0, sha).when(n % 3 == 0, F.upper(sha)).otherwise(F.substring(F.sha2(F.col("html").cast("binary"), 256), 1, 41))
    return t.pages.where("html is not null").select("page_id", text.commit_id(v).alias("commit"), text.digest(F.col("html")).alias("digest"))


@query(
    """SELECT o_orderkey, CASE WHEN n_regionkey < 3 AND year(o_orderdate) >= 2000 AND o_orderstatus <> 'P'
            THEN 'https://247sports.com/college/customer-' || o_custkey || '/season/' || year(o_orderdate) || '-' || (['football', 'basketball', 'womens-basketball'])[n_regionkey + 1]
                 || CASE o_orderstatus WHEN 'F' THEN '/commits/' ELSE '/offers/' END END AS list,
        CASE WHEN o_orderkey < 1000 AND o_orderpriority <> '1-URGENT' THEN
            'https://247sports.com/college/x/season/2026-football/offers/?ViewPath=~%2FViews%2FSkyNet%2FRecruitInterest%2F_SimpleDetailedSetForSeason.ascx&Position=' || o_orderkey END AS next,
        CASE WHEN o_totalprice > 200000 THEN 'https://site.api.espn.com/apis/site/v2/sports/' || (['football/college-football', 'soccer/usa.ncaa.m.1', NULL, 'hockey/mens-college-hockey', NULL])[n_regionkey + 1]
            || '/teams/' || o_custkey || '/roster' END AS team
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "T39 T40",
)
def provider_addresses(t: Tables) -> DataFrame:
    """Addresses of providers made of orders: lists of a school's year, their continuations, rosters of teams."""
    rows = t.orders.join(t.customer, F.expr("o_custkey = c_custkey")).join(t.nation, F.expr("c_nationkey = n_nationkey"))
    of_region = lambda *x: F.get(F.array(*map(F.lit, x)), F.col("n_regionkey").cast("int"))
    kind = F.when(F.col("o_orderstatus") == "F", "commits").when(F.col("o_orderstatus") == "O", "offers").otherwise("visits")
    slug = F.concat(F.lit("customer-"), _s("o_custkey"))
    base = "https://247sports.com/college/x/season/2026-football/offers/"
    more = F.concat(F.lit(f"{base}?Position="), _s("o_orderkey"), F.when(F.col("o_orderpriority") == "1-URGENT", "&ViewPath=~/Views/Other.ascx").otherwise(f"&ViewPath={providers.VIEW_PATH}"))
    path = providers.league_path(of_region("football", "mens-soccer", "rifle", "mens-ice-hockey", "golf"))
    team = providers.team_url(path, F.when(F.col("o_totalprice") > 200000, _s("o_custkey")).otherwise("x"), F.lit("roster"), F.lit(None).cast("string"))
    year = F.year("o_orderdate")
    return rows.select(
        "o_orderkey", providers.recruiting_url(slug, of_region("football", "basketball", "womens-basketball", "golf", "rifle"), year, kind).alias("list"),
        providers.continuation_url(more, F.lit(base)).alias("next"), team.alias("team"),
    )


# ---- documents of services

@query(
    """SELECT event_id, event_type NOT IN ('view', 'error') AS exact, CASE WHEN event_type = 'error' THEN 'malformed-public-json' END AS error,
        CASE WHEN length(props) <= 9 OR props IS NULL THEN coalesce(props, '') END AS field FROM events""",
    "T42 P31 R15",
)
def documents_of_events(t: Tables) -> DataFrame:
    """Properties of events as documents: some with a further key, some cut off."""
    kind, props = F.col("event_type"), F.col("props")
    v = F.when(kind == "view", F.regexp_replace(props, r"\}$", ', "more": 1}')).when(kind == "error", F.regexp_replace(props, r"\}$", "")).otherwise(props)
    return t.events.select("event_id", text.exact_keys(v, ["k"]).alias("exact"), text.public_json(v)["error"].alias("error"), official.bounded_field(props, 9)["value"].alias("field"))


@query(
    """WITH n AS (SELECT c_custkey, c_name, c_mktsegment AS m, c_acctbal, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer)
    SELECT c_custkey, CASE WHEN m = 'BUILDING' THEN 'canonical-scope-mismatch' WHEN m IN ('MACHINERY', 'FURNITURE') THEN 'heading-scope-mismatch' WHEN n * 100 > 1000 THEN 'record-count-exceeds-budget' END AS error,
        CASE WHEN n > 12 OR c_acctbal < 0 THEN 'invalid-service-response' WHEN n > 10 THEN 'invalid-service-record' END AS answer,
        CASE WHEN c_acctbal > 9000 THEN 'access-challenge' END AS challenge FROM n""",
    "P19 R15 R17",
)
def lists_of_customers(t: Tables) -> DataFrame:
    """Recruiting lists and service answers with as many records as a customer has orders."""
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    rows = t.customer.join(n, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    m, count = F.col("c_mktsegment"), F.col("n")
    expected = "https://247sports.com/college/x/season/2026-football/offers/"
    heading = F.concat(
        F.when(m == "MACHINERY", "Other").otherwise(F.col("c_name")), F.when(m == "FURNITURE", " 2025").otherwise(" 2026"), F.lit(" Football Offers ("), (count * 100).cast("string"), F.lit(")")
    )
    canonical = F.when(m == "BUILDING", F.array(F.lit(expected), F.lit(expected))).otherwise(F.array(F.lit(expected)))
    error = providers.page_context(heading, canonical, F.lit(expected), F.col("c_name"), F.lit(2026), F.lit("football"), F.lit("offers"), F.lit(expected))
    data = F.array_join(F.transform(F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<bigint>")), lambda i: F.when((count > 10) & (i == count), F.lit("7")).otherwise(F.concat(F.lit('{"i":'), i.cast("string"), F.lit("}")))), ",")
    answer = F.concat(F.lit('{"error":'), F.when(F.col("c_acctbal") < 0, '"down"').otherwise("false"), F.lit(',"data":['), data, F.lit("]}"))
    page = F.concat(F.when(F.col("c_acctbal") > 9000, "<title>Attention Required! | Gate</title>").otherwise("<title>x</title>"), heading)
    return rows.select("c_custkey", error.alias("error"), official.service_rows(answer, 12).alias("answer"), providers.page_challenge(page).alias("challenge"))


@query(
    """SELECT o_orderkey, o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' AND year(o_orderdate) >= 2000 AS article,
        CASE WHEN o_totalprice < 10000 THEN CAST(floor(o_totalprice) AS INTEGER) END AS score, CASE WHEN o_totalprice <= 50000 THEN o_totalprice END AS number FROM orders""",
    "F12 T32",
)
def articles_of_orders(t: Tables) -> DataFrame:
    """Addresses of conference stories by the day of orders, and prices as scores."""
    at, status = F.col("o_orderdate"), F.col("o_orderstatus")
    host = F.when(status == "F", "d.org").otherwise("c.org")
    url = F.concat(F.lit("https://"), host, F.when(status == "P", "/sports/").otherwise("/news/"), _form(at, "yyyy/M/d"), F.lit("/story-"), _s("o_orderkey"), F.lit(".aspx"), F.when(F.col("o_orderpriority") == "5-LOW", "?path=x").otherwise(""))
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", F.coalesce(official.conference_article(url, F.lit("c.org")), F.lit(False)).alias("article"), dates.result_score(F.floor(price).cast("string")).alias("score"),
        dates.optional_number(F.concat(F.lit(" "), price.cast("string")), 50000).alias("number"),
    )
