"""Discovery of sources from a school's navigation, and the import of the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.sports import match_labels, normal_label, route_slugs
from tidewire.functions.text import slugify
from tidewire.functions.urls import has_segment, official_hosts, official_link, safe_url

# Labels that say what a link leads to.
KINDS = {"roster": "roster", "schedule": "schedule", "archives": "news", "news": "news"}


def link_kind(label: Column, url: Column) -> Column:
    """news, roster, schedule, or home."""
    text = normal_label(label)
    return (
        F.when(has_segment(url, "roster") | text.rlike(r"\broster\b"), "roster")
        .when(has_segment(url, "schedule") | text.rlike(r"\bschedule\b"), "schedule")
        .when(has_segment(url, "archives") | text.rlike(r"\b(?:news|archives?|stories)\b"), "news")
        .otherwise("home")
    )


def sport_links(links: DataFrame, programs: DataFrame, aliases: DataFrame) -> DataFrame:
    """Links of a school with the program they belong to.

    links: school, pos, label, section, url; programs: program_id, school, slug; aliases: program_id, alias.
    A link names its sport by its route, else by its label, else by its section; these are
    equi-joins on the alias, not a product of links and sports.
    """
    of_school = aliases.join(programs.select("program_id", "school", "slug"), "program_id")
    rows = links.withColumn("kind", link_kind(F.col("label"), F.col("url")))
    says = lambda alias, how: F.struct(normal_label(alias).alias("alias"), F.lit(how).alias("how"))
    routes = F.transform(route_slugs(F.col("url")), lambda slug: says(slug, 0))
    named = rows.select("*", F.inline(F.concat(routes, F.array(says(F.col("label"), 1), says(F.col("section"), 2)))))
    hits = named.where("alias <> ''").join(of_school, ["school", "alias"])
    best = F.min("how").over(Window.partitionBy("school", "pos", "url"))
    return hits.withColumn("best", best).where("how = best").select("school", "program_id", "slug", "pos", "kind", "url").distinct()


def program_sources(matched: DataFrame) -> DataFrame:
    """Per program the first link of each kind."""
    first = lambda kind: F.min_by(F.when(F.col("kind") == kind, F.col("url")), F.when(F.col("kind") == kind, F.col("pos")))
    return matched.groupBy("school", "program_id").agg(*(first(k).alias(f"{k}_url") for k in ("home", "news", "roster", "schedule")))


def enriched_sources(sources: DataFrame, deeper: DataFrame) -> DataFrame:
    """With links of the programs' own pages, of each kind the last one."""
    last = lambda kind: F.max_by(F.when(F.col("kind") == kind, F.col("url")), F.when(F.col("kind") == kind, F.col("pos")))
    found = deeper.groupBy("school", "program_id").agg(*(last(k).alias(f"deep_{k}") for k in ("news", "roster", "schedule")))
    out = sources.join(found, ["school", "program_id"], "left")
    for k in ("news", "roster", "schedule"):
        out = out.withColumn(f"{k}_url", F.coalesce(f"deep_{k}", f"{k}_url")).drop(f"deep_{k}")
    return out


def declared_archive(links: DataFrame, keys: list[str]) -> DataFrame:
    """The archive of a program if there is exactly one."""
    n = links.groupBy(*keys).agg(F.count_distinct("url").alias("n"), F.min("url").alias("archive_url"))
    return n.where("n = 1").drop("n")


def conference_key(name: Column) -> Column:
    """A conference's slug: without "The" before and "Conference" after; null for none."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(name), r"(?i)^the\s+", ""), r"(?i)\s+conference$", "")
    return F.when(F.trim(name) != "", slugify(bare))


def sport_key(name: Column, code: Column) -> Column:
    """A sport's slug; basketball is the men's."""
    return F.when(code == "MBB", "basketball").otherwise(slugify(F.regexp_replace(name, r"(?i)^mixed ", "Coed ")))


def split_members(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Schools to keep, and those left out with the reason (F16)."""
    reason = F.when(F.col("reclassifying") == "outgoing", "outgoing-reclassification").when(
        F.col("athleticsUrl").isNull() & (F.coalesce(F.size("sports"), F.lit(0)) <= 0), "no-url-and-no-sports"
    )
    told = members.withColumn("reason", reason)
    return told.where("reason is null").drop("reason"), told.where("reason is not null")


def import_evidence(programs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts of an imported catalog (A11, A12, A13, R22), for all of it or per keys."""
    return programs.groupBy(*(keys or [])).agg(
        F.count_distinct("school").alias("schools"), F.count("*").alias("programs"), F.count_distinct("sport").alias("sports"),
        F.count_distinct("primary_conference").alias("conferences"),
        F.count_if(~F.col("conference").eqNullSafe(F.col("primary_conference"))).alias("affiliates"),
    )


def count_by(rows: DataFrame, field: str) -> DataFrame:
    """A histogram."""
    return rows.groupBy(field).agg(F.count("*").alias("n"))


def affiliations(programs: DataFrame, conference: str, member: str) -> DataFrame:
    """The members of each conference, in order (A14).  A conference has hundreds at most."""
    return programs.groupBy(conference).agg(F.sort_array(F.collect_list(member)).alias("members"))


def imported_slugs(schools: DataFrame, previous: DataFrame, fixed: DataFrame) -> DataFrame:
    """A slug per school (R22): the one it has had, else a reviewed one, else its name's.  Each is joined by the school's number."""
    old = previous.select("ncaa_id", F.col("slug").alias("old_slug"))
    given = fixed.select("ncaa_id", F.col("slug").alias("given_slug"))
    out = schools.join(old, "ncaa_id", "left").join(given, "ncaa_id", "left")
    return out.withColumn("slug", F.coalesce("old_slug", "given_slug", slugify(F.col("name")))).drop("old_slug", "given_slug")


def sponsored_sports(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sponsored sports of a directory's table (P29): keys, code, name, slug, conference, repeated, conflict.

    rows: keys, cells (of one table row), code (of the label, null if unknown).  Identical rows are one sponsorship.
    """
    told = rows.where(F.size("cells") >= 4).select(
        *keys, "code", F.col("cells")[0].alias("name"), F.nullif(F.col("cells")[2], F.lit("")).alias("division"), conference_key(F.col("cells")[3]).alias("conference")
    )
    value = F.struct("name", "division", "conference")
    n = told.groupBy(*keys, "code").agg(
        F.min(value).alias("v"), (F.count("*") - F.count_distinct(F.to_json(value, {"ignoreNullFields": "false"}))).alias("repeated"),
        (F.count_distinct(F.to_json(value, {"ignoreNullFields": "false"})) > 1).alias("conflict"),
    )
    return n.select(*keys, "code", "v.name", sport_key(F.col("v.name"), F.col("code")).alias("slug"), "v.division", "v.conference", "repeated", "conflict")


def source_policy(schools: DataFrame, overrides: DataFrame) -> DataFrame:
    """Each school's site, hosts and the code of an override that is not its own.

    schools: school, ncaa_id, athletics_url; overrides: school, ncaa_id, original_url, athletics_url, evidence_url, news_url.
    """
    o = overrides.select("school", *(F.col(c).alias(f"o_{c}") for c in ("ncaa_id", "original_url", "athletics_url", "evidence_url", "news_url")), F.lit(True).alias("given"))
    rows = schools.join(o, "school", "left")
    own = (F.col("o_ncaa_id") == F.col("ncaa_id")) & (F.col("o_original_url") == F.col("athletics_url"))
    own &= safe_url(F.col("o_athletics_url")).isNotNull() & safe_url(F.col("o_evidence_url")).isNotNull()
    hosts = F.array_distinct(F.concat(official_hosts(F.col("athletics_url")), F.when(F.col("given").isNotNull(), official_hosts(F.col("o_athletics_url"))).otherwise(F.array().cast("array<string>"))))
    rows = rows.withColumn("hosts", hosts)
    fallback = F.col("o_news_url").isNull() | official_link(F.col("o_news_url"), F.col("hosts")).isNotNull()
    code = F.when(F.col("given").isNotNull() & ~F.coalesce(own, F.lit(False)), "override-identity-mismatch").when(
        F.col("given").isNotNull() & ~F.coalesce(fallback, F.lit(False)), "override-host-mismatch"
    )
    return rows.select("school", F.coalesce("o_athletics_url", "athletics_url").alias("athletics_url"), "hosts", F.col("o_news_url").alias("news_url"), code.alias("error_code"))


def sitemap_page(locs: DataFrame, keys: list[str]) -> DataFrame:
    """The first page of a sitemap that belongs to a sport's schedule or roster (S16): keys, url.  locs: keys, pos, loc."""
    page = F.col("loc").rlike(r"^https://[^/]*/sports?/[a-z][a-z0-9-]*/(?:schedule|roster)(?:/|$|[?#])")
    return locs.where(page).groupBy(*keys).agg(F.min_by("loc", "pos").alias("url"))


#: A robots file of more bytes is none.
MAX_ROBOTS = 100_000


def followed_sitemaps(sites: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """From a site's robots file along its sitemaps to a page of a sport (S16): keys, sitemap_url, child_url, page_url, page.

    sites: keys, robots (its text), hosts; landed: url, text, the documents that requests have brought.  The first sitemap that the robots
    file names on the site's own hosts is read; if it lists a sitemap of schedules or rosters, that one is read instead; the first
    schedule or roster in it is the page.  A site that is left on the way has null from there on.
    """
    from tidewire.sources import parsers

    documents = landed.select(F.col("url").alias("at"), F.col("text").alias("body"))
    lines = F.split("robots", r"\r?\n")
    named = F.transform(lines, lambda x: official_link(F.nullif(F.regexp_extract(x, r"(?i)^Sitemap:\s*(https://\S+)\s*$", 1), F.lit("")), F.col("hosts")))
    first = F.get(F.filter(named, lambda x: x.isNotNull()), F.lit(0))
    rows = sites.withColumn("sitemap_url", F.when(F.octet_length("robots") <= MAX_ROBOTS, first))
    path = F.regexp_replace("loc", r"\?.*$", "")

    def listed(of: str, most: int, wanted: Column, name: str) -> DataFrame:
        """The first address in the sitemaps at ``of`` that is wanted and the site's own."""
        texts = rows.where(F.col(of).isNotNull()).join(documents, F.col(of) == F.col("at")).select(*keys, "hosts", F.col("body").alias("text"), F.lit(most).alias("most"))
        locs = parsers.parse(texts, parsers.sitemap, parsers.LOC_ROW, [*keys, "hosts", "most"]).where("pos >= 0")
        own = locs.withColumn("loc", official_link(F.col("loc"), F.col("hosts"))).where(F.col("loc").isNotNull() & wanted)
        return own.groupBy(*keys).agg(F.min_by("loc", "pos").alias(name))

    rows = rows.join(listed("sitemap_url", parsers.MAX_LOCS, path.rlike(r"sitemap_(?:schedule|roster)_1\.xml$"), "child_url"), keys, "left")
    rows = rows.withColumn("read_url", F.coalesce("child_url", "sitemap_url"))
    page = F.regexp_replace(path, "^https://[^/]*", "").rlike(r"^/sports?/[a-z][a-z0-9-]*/(?:schedule|roster)(?:/|$)")
    rows = rows.join(listed("read_url", parsers.MAX_PAGES, page, "page_url"), keys, "left")
    rows = rows.join(documents, F.col("page_url") == F.col("at"), "left")
    return rows.select(*keys, "sitemap_url", "child_url", "page_url", F.col("body").alias("page"))


def navigation_label(text: Column) -> Column:
    """A link's label without what collection it leads to."""
    steps = (
        (r"(?i)^(?:roster|schedule|news|coaches|stats|statistics) for\s+", ""), (r"(?i)^(men['’]?s|women['’]?s) sports\s+", "$1 "),
        (r"(?i)^(.+?),\s*(men['’]?s|women['’]?s) sports$", "$2 $1"), (r"(?i)^w-\s*", "Women's "), (r"(?i)^m-\s*", "Men's "),
        (r"(?i)\s*:\s*(?:roster|schedule|news|coaches|stats|statistics|home|tickets).*$", ""),
    )
    for pattern, to in steps:
        text = F.regexp_replace(text, pattern, to)
    return F.trim(text)


def discovery_status(schools: DataFrame, pages: DataFrame, done: DataFrame, version: int = 3) -> DataFrame:
    """What is left to discover and what it came to (R21): school, status.

    Schools whose sources are of this version are left out; a failed page is a row with its code, not an error.
    schools: school; pages: school, error_code, n_sources; done: school, version.
    """
    due = schools.join(done.where(F.col("version") == version).select("school"), "school", "left_anti")
    status = F.when(F.col("n_sources").isNull() & F.col("error_code").isNull(), "not-fetched").when(F.col("error_code").isNotNull(), F.col("error_code")).when(
        F.col("n_sources") == 0, "no-sources-found"
    ).otherwise("ok")
    return due.join(pages, "school", "left").select("school", status.alias("status"))


# Families that are one program for several sponsored sports, and labels of joint track and cross-country pages.
COMBINED_FAMILIES = ("track and field", "cross country", "swimming and diving", "skiing", "fencing", "rifle", "sailing")
TRACK_AND_CROSS = (
    "track and field xc", "track and field cross country", "track cross country", "cross country track", "cross country and track",
    "cross country track and field", "cross country and track and field", "xc track", "xc track and field",
)
#: Forms of a family's name in menus.
_FAMILY_WORDS = (
    (r"^(?:mens and womens|womens and mens|m and w) ", ""),
    (r"^track(?: field)?$", "track and field"),
    (r"^(?:swimming diving|swim and dive|swimming)$", "swimming and diving"),
    (r"^combined cross country$", "cross country"),
    (r"^artistic swimming$", "synchronized swimming"),
    (r"^acrobatics tumbling$", "acrobatics and tumbling"),
)


def navigation_matches(labels: DataFrame, programs: DataFrame, aliases: DataFrame) -> DataFrame:
    """Programs that the labels of a school's navigation mean (T22): school, label, program_id.

    labels: school, label; programs: program_id, school, base, family, gender; aliases: program_id, alias.
    A label says which families or bases it may mean and for which genders; that is an equi-join,
    and the rules of sailing, track seasons and joint pages are rows of what it says.
    """
    n = labels.select("school", "label").distinct().withColumn("n", normal_label(F.col("label")))
    season = F.lower(F.coalesce(
        F.nullif(F.regexp_extract("label", r"(?i)^.+?\s*\((i|o|indoor|outdoor)\)\s*$", 1), F.lit("")),
        F.nullif(F.regexp_extract("label", r"(?i)^.+?\s*[-–—]\s*(indoor|outdoor)\s*$", 1), F.lit("")),
    ))
    stem = normal_label(F.regexp_replace("label", r"(?i)\s*(?:\((?:i|o|indoor|outdoor)\)|[-–—]\s*(?:indoor|outdoor))\s*$", ""))
    n = n.withColumn("season", F.when(season.startswith("i"), "indoor").when(season.startswith("o"), "outdoor")).withColumn("stem", stem)
    n = n.withColumn("words", F.regexp_replace("n", _FAMILY_WORDS[0][0], ""))
    gender = F.nullif(F.regexp_extract(F.when(F.col("season").isNotNull(), F.col("stem")).otherwise(F.col("words")), "^(mens|womens) ", 1), F.lit(""))
    plain = F.regexp_replace("words", "^(mens|womens) ", "")
    family = F.col("words")
    for pattern, to in _FAMILY_WORDS[1:]:
        family = F.regexp_replace(family, pattern, to)
    any_ = F.array().cast("array<string>")
    only = lambda g: F.when(g.isNotNull(), F.array(g)).otherwise(any_)
    says = lambda kind, value, genders, lone: F.struct(F.lit(kind).alias("kind"), value.alias("value"), genders.alias("genders"), F.lit(lone).alias("lone"))
    sailing = F.col("n").rlike("^sailing (?:open|coed)$")
    all_sailing = F.col("n").rlike("^(?:mens (?:and )?womens sailing|sailing open and womens)$")
    track = r"^(?:(?:mens|womens) )?track(?: and)? field$"
    in_front = F.regexp_extract(plain, "^(indoor|outdoor) track(?: and)? field$", 1)
    told = (
        F.when(sailing, F.array(says("family", F.lit("sailing"), F.array(F.lit("coed")), False)))
        .when(all_sailing, F.array(says("family", F.lit("sailing"), F.array(F.lit("coed"), F.lit("womens")), False)))
        .when(F.col("season").isNotNull() & F.col("stem").rlike(track), F.array(says("base", F.concat("season", F.lit(" track and field")), only(gender), False)))
        .when(F.col("season").isNotNull(), F.array(says("none", F.lit(""), any_, False)))
        .when(in_front != "", F.array(says("base", F.concat(in_front, F.lit(" track and field")), only(gender), False)))
        .when(plain.isin(*TRACK_AND_CROSS), F.array(says("family", F.lit("cross country"), only(gender), False), says("family", F.lit("track and field"), only(gender), False)))
        .otherwise(F.array(says("family", family, any_, True)))
    )
    said = n.select("school", "label", F.explode(told).alias("s")).select("school", "label", "s.*")
    size = programs.groupBy("school", "family").agg(F.count("*").alias("in_family"))
    rows = programs.join(size, ["school", "family"]).withColumn(
        "names", F.array(F.struct(F.lit("family").alias("kind"), F.col("family").alias("value")), F.struct(F.lit("base").alias("kind"), F.col("base").alias("value")))
    )
    keyed = rows.select("school", "program_id", "gender", "family", "in_family", F.inline("names"))
    hit = said.join(keyed, ["school", "kind", "value"])
    ok = (F.size("genders") == 0) | F.array_contains("genders", F.col("gender"))
    alone = ~F.col("lone") | F.col("family").isin(*COMBINED_FAMILIES) | (F.col("in_family") == 1)
    by_rule = hit.where(F.coalesce(ok, F.lit(False)) & alone).select("school", "label", "program_id")
    # labels of the special forms never fall back to aliases
    plain_labels = n.where(F.col("season").isNull() & ~sailing & ~all_sailing).select("school", "label")
    by_alias = match_labels(plain_labels, aliases.join(programs.select("program_id", F.col("school").alias("of")), "program_id"))
    by_alias = by_alias.where("school = of").select("school", "label", "program_id")
    return by_rule.unionByName(by_alias).distinct()


def without_routing(rows: DataFrame) -> DataFrame:
    """Without what is for routing only and never published."""
    return rows.drop("description")


def narrowed(conference: Column) -> Column:
    """A conference as a snapshot names it."""
    return F.struct(conference["slug"].alias("slug"), conference["name"].alias("name"))


def feed_sources(programs: DataFrame, feeds: DataFrame) -> DataFrame:
    """The verified feeds that each program reads, with the host that may be asked."""
    from tidewire.functions.urls import host_of
    from tidewire.operators.joins import wildcard_join

    found = wildcard_join(programs, feeds.where("status = 'verified'").drop("status"), ["school", "sport"])
    return found.drop("any_school", "any_sport").withColumn("host", host_of(F.col("url")))
