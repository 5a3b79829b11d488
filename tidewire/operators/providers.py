"""Providers' mappings: which of a provider's teams a program is, and that nobody asks for another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.providers import RECRUITING_HOST, league_path
from tidewire.functions.text import school_name_key
from tidewire.functions.urls import host_of, safe_url
from tidewire.operators.joins import unique_owner
from tidewire.scratch import shared_root

# Team entries that stand for no team yet.
PLACEHOLDERS = ("-1", "-2")


def mapping_status(known: Column, verified: Column) -> Column:
    """noProvider, verified or unverified (K3)."""
    return F.when(known.isNull(), "noProvider").when(verified, "verified").otherwise("unverified")


def resolved(programs: DataFrame, mappings: DataFrame, leagues: DataFrame) -> DataFrame:
    """Each program with its provider's identity, checked against the sport's league (K3, K4).

    programs: school, sport; mappings: school, sport, team_id, team_path, mapping_status, mapping_reason;
    leagues: sport, league_path, league_id.
    """
    rows = programs.join(mappings, ["school", "sport"], "left").join(leagues, "sport", "left")
    verified = F.coalesce(F.col("mapping_status") == "verified", F.lit(False))
    sound = F.col("team_id").rlike(r"^\d+$") & F.col("league_path").eqNullSafe(league_path(F.col("sport"))) & (F.col("team_path") == F.col("league_path"))
    status = F.when(~verified, "noProvider").when(~F.coalesce(sound, F.lit(False)), "invalid-identity").otherwise("verified")
    reason = F.when(~verified, F.coalesce("mapping_reason", F.lit("no-verified-league-inventory")))
    ok = status == "verified"
    return rows.select(
        *programs.columns, status.alias("status"), reason.alias("reason"), F.when(ok, F.col("team_id")).alias("team_id"),
        F.when(ok, F.col("team_path")).alias("team_path"), F.when(ok, F.col("league_id")).alias("league_id"),
    )


def required(requests: DataFrame, verified: DataFrame) -> DataFrame:
    """Requests whose identity is that of the verified mapping; forged ones have no row (K5).

    requests: school, sport, and team_id, team_path, either null for what the caller does not claim.
    """
    known = verified.where("status = 'verified'").select("school", "sport", F.col("team_id").alias("v_id"), F.col("team_path").alias("v_path"))
    rows = requests.join(known, ["school", "sport"])
    same = (F.col("team_id").isNull() | (F.col("team_id") == F.col("v_id"))) & (F.col("team_path").isNull() | (F.col("team_path") == F.col("v_path")))
    return rows.where(same).drop("v_id", "v_path")


def outside_catalog(requests: DataFrame, programs: DataFrame) -> DataFrame:
    """Requests whose school, number, name and sport are not a program of the catalog."""
    keys = ["school", "ncaa_id", "name", "sport"]
    return requests.join(programs.select(*keys).distinct(), keys, "left_anti")


def league_teams(teams: DataFrame, keys: list[str]) -> DataFrame:
    """A league's teams: placeholders dropped, repeated ones once, conflicting ones an error row.

    teams: keys, id, location, name.  Gives keys, id, location, name, error_code.
    """
    placeholder = F.col("id").isin(*PLACEHOLDERS) & (F.col("location") == "TBD") & (F.col("name") == "TBD TBD")
    rows = teams.where(~F.coalesce(placeholder, F.lit(False)))
    value = F.struct("location", "name")
    one = rows.groupBy(*keys, "id").agg(F.min(value).alias("v"), F.count_distinct(F.to_json(value)).alias("n"))
    code = F.when(~F.col("id").rlike(r"^\d+$"), "invalid-team-inventory").when(F.col("n") > 1, "conflicting-team-inventory")
    return one.select(*keys, "id", "v.location", "v.name", code.alias("error_code"))


def literal_name(value: Column) -> Column:
    """A name as folded words, boilerplate kept."""
    from tidewire.functions.text import ascii_words

    return ascii_words(value)


def match_schools(schools: DataFrame, names: DataFrame, teams: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Each school's team with how it was found, or why not (C9, K14): keys, school, team_id, status, how, reason.

    schools: keys, school, name; names: school, alias (reviewed ones); teams: keys, team_id, location.  With keys, such as the sport, a
    school is looked for among the teams of its own.  A team of a literally equal name comes first; else one of the same name without
    boilerplate, if that is one team's, and a reviewed alias or no other school's name.  Equi-joins on the two forms; no team is
    compared with every school.
    """
    keys = keys or []
    own = schools.select(*keys, "school", F.col("name").alias("said"), F.lit(False).alias("by_alias"))
    listed = schools.select(*keys, "school").join(names, "school")
    own = own.unionByName(listed.select(*keys, "school", F.col("alias").alias("said"), F.lit(True).alias("by_alias")))
    own = own.select(*keys, "school", "by_alias", literal_name(F.col("said")).alias("literal"), school_name_key(F.col("said")).alias("loose"))
    t = teams.select(*keys, "team_id", literal_name(F.col("location")).alias("literal"), school_name_key(F.col("location")).alias("loose"))
    # a name is of one team or of several: its least and greatest are enough, so a name that many share is a row and no product
    least = lambda by: t.groupBy(*keys, by).agg(F.min("team_id").alias("lo"), F.max("team_id").alias("hi"))
    literal = own.join(least("literal"), [*keys, "literal"]).groupBy(*keys, "school").agg(F.min("lo").alias("literal_team"), F.max("hi").alias("literal_last"))
    loose = own.join(least("loose"), [*keys, "loose"]).groupBy(*keys, "school").agg(
        F.min("lo").alias("loose_team"), F.max("hi").alias("loose_last"), F.bool_or("by_alias").alias("alias_hit"),
        F.bool_or(~F.col("by_alias")).alias("name_hit"),
    )
    same = schools.select("school", school_name_key(F.col("name")).alias("loose")).distinct()
    shared = same.join(same.groupBy("loose").agg(F.count("*").alias("n_same")), "loose").select("school", "n_same")
    rows = schools.join(literal, [*keys, "school"], "left").join(loose, [*keys, "school"], "left").join(shared, "school", "left")
    by_literal = F.col("literal_team").isNotNull()
    team, last = (F.when(by_literal, F.col(f"literal_{c}")).otherwise(F.col(f"loose_{c}")) for c in ("team", "last"))
    n = F.when(team.isNull(), 0).when(team == last, 1).otherwise(2)
    unsure = ~by_literal & ~F.coalesce("alias_hit", F.lit(False)) & (F.col("n_same") > 1)
    reason = F.when(n == 0, "no-exact-or-reviewed-alias-match").when(n > 1, "ambiguous-provider-school-name").when(unsure, "ambiguous-ncaa-school-name")
    ok = reason.isNull()
    how = F.when(F.coalesce("name_hit", F.lit(False)), "exact-normalized-name").otherwise("reviewed-name-alias")
    return rows.select(
        *keys, "school", F.when(ok, team).alias("team_id"), F.when(ok, "verified").otherwise("unmapped").alias("status"), F.when(ok, how).alias("how"), reason.alias("reason")
    )


MAX_TEAMS, MAX_ARTICLES = 1000, 200
_TEAM = "struct<team: struct<id: string, location: string, displayName: string>>"
_INVENTORY = f"struct<sports: array<struct<slug: string, leagues: array<struct<slug: string, id: string, name: string, teams: array<{_TEAM}>>>>>>"
_NEWS_INDEX = "struct<header: string, link: struct<href: string>, articles: array<string>>"


def import_providers(programs: DataFrame, names: DataFrame, inventories: DataFrame, news: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A provider's registry from the landed answers of its leagues (R23): leagues, and the mapping of every program.

    programs: school, name, sport; names: school, alias; inventories: sport, text, error_code (of a failed request); news: sport, text.
    A league's inventory may come in parts, a row each, so a part has ``MAX_TEAMS`` entries at most and a league as many as it has.

    leagues: sport, status (verified, empty-inventory, unavailable), reason, league_id, league_name, team_count, placeholders, duplicates,
    sha256, news_header, news_url.  An inventory with a part of another league or of too many entries, or with one unsound or conflicting team,
    is unavailable as a whole; ``sha256`` is of its text, of several parts of their digests in order.  mappings: school, sport, team_id, status, how, reason; a program without a sound inventory is unmapped for that reason.
    """
    from tidewire.functions.text import clean_text, digest

    path = league_path(F.col("sport"))
    told = F.from_json("text", _INVENTORY)
    root = F.get(told["sports"], F.lit(0))
    league = F.get(root["leagues"], F.lit(0))
    rows = inventories.select("sport", "text", "error_code", path.alias("path"), root["slug"].alias("root"), league.alias("league"))
    same = (F.col("root") == F.split_part("path", F.lit("/"), F.lit(1))) & (F.col("league.slug") == F.split_part("path", F.lit("/"), F.lit(2)))
    sound = same & F.col("league.id").rlike(r"^\d+$") & (F.size("league.teams") <= MAX_TEAMS) & F.col("league.teams").isNotNull()
    code = F.coalesce("error_code", F.when(~F.coalesce(sound, F.lit(False)), "inventory-identity-or-size-mismatch"))
    rows = rows.withColumn("code", code)
    entries = rows.where("code is null").select("sport", F.explode("league.teams.team").alias("team"))
    entries = entries.select("sport", "team.id", "team.location", F.col("team.displayName").alias("name"))
    placeholder = F.col("id").isin(*PLACEHOLDERS) & (F.col("location") == "TBD") & (F.col("name") == "TBD TBD")
    entries = entries.withColumn("placeholder", F.coalesce(placeholder, F.lit(False)))
    whole = F.col("id").isNotNull() & F.col("location").isNotNull() & (F.col("location") != "") & (F.char_length("location") <= 200) & F.col("name").isNotNull()
    counted = entries.groupBy("sport").agg(
        F.count_if("placeholder").alias("placeholders"), F.count_if(~F.col("placeholder")).alias("n"), F.bool_or(~F.col("placeholder") & ~whole).alias("unsound")
    )
    told = rows.select("sport", "code", F.col("league.id").alias("id"), F.col("league.name").alias("name"), digest(F.col("text")).alias("sha"))
    told = told.groupBy("sport").agg(
        F.max("code").alias("code"), F.min("id").alias("id"), F.max("id").alias("other_id"), F.min("name").alias("name"), F.sort_array(F.collect_list("sha")).alias("sha")
    )
    told = told.withColumn("code", F.coalesce("code", F.when(F.col("id") != F.col("other_id"), "inventory-identity-or-size-mismatch")))
    teams = league_teams(entries.select("sport", "id", "location", clean_text(F.col("name"), 200).alias("name")), ["sport"])
    checked = teams.groupBy("sport").agg(F.count("*").alias("team_count"), F.max("error_code").alias("team_code"))
    all_ = told.join(counted, "sport", "left").join(checked, "sport", "left")
    code = F.coalesce("code", F.when(F.col("unsound"), "invalid-team-inventory"), "team_code")
    index = F.from_json(F.col("news_text"), _NEWS_INDEX)
    link = safe_url(index["link"]["href"])
    indexed = index["header"].isNotNull() & (F.char_length(index["header"]) <= 200) & host_of(link).isin("espn.com") & (F.size(index["articles"]) <= MAX_ARTICLES) & index["articles"].isNotNull()
    all_ = all_.join(news.select("sport", F.col("text").alias("news_text")), "sport", "left").withColumn("reason", code)
    ok = F.col("reason").isNull()
    n = F.coalesce("team_count", F.lit(0))
    sha = F.when(F.size("sha") == 1, F.get("sha", F.lit(0))).otherwise(digest(F.array_join("sha", "")))
    leagues = all_.select(
        "sport", F.when(~ok, "unavailable").when(n == 0, "empty-inventory").otherwise("verified").alias("status"), "reason", F.when(ok, F.col("id")).alias("league_id"),
        F.when(ok, clean_text(F.col("name"), 200)).alias("league_name"), F.when(ok, n).alias("team_count"), F.when(ok, F.coalesce("placeholders", F.lit(0))).alias("placeholders"),
        F.when(ok, F.coalesce("n", F.lit(0)) - n).alias("duplicates"), F.when(ok, sha).alias("sha256"),
        F.when(ok & F.coalesce(indexed, F.lit(False)), index["header"]).alias("news_header"), F.when(ok & F.coalesce(indexed, F.lit(False)), link).alias("news_url"),
    )
    # a row per sport, asked three times below
    shared_root(programs.sparkSession)
    leagues = leagues.checkpoint()
    good = leagues.where("status <> 'unavailable'").select("sport")
    found = match_schools(
        programs.join(good, "sport", "left_semi").select("sport", "school", "name"), names,
        teams.join(good, "sport", "left_semi").select("sport", F.col("id").alias("team_id"), "location"), ["sport"],
    )
    rest = programs.join(good, "sport", "left_anti").select("school", "sport").join(leagues.select("sport", F.col("reason").alias("why")), "sport", "left")
    none = lambda n: F.lit(None).cast("string").alias(n)
    unmapped = rest.select("school", "sport", none("team_id"), F.lit("unmapped").alias("status"), none("how"), F.coalesce("why", F.lit("no-verified-league-inventory")).alias("reason"))
    return leagues, found.select("school", "sport", "team_id", "status", "how", "reason").unionByName(unmapped)


def recruiting_candidates(rows: DataFrame) -> DataFrame:
    """A provider's schools by slug, those with several names dropped (A22, R24): slug, name.  rows: slug, name, pos."""
    return unique_owner(rows.select("slug", "name"), "slug", "name")


def inventory_rows(links: DataFrame) -> DataFrame:
    """Ranking rows as candidates (P30): slug, name of links that are a school's list of the season and sport.

    links: url, label, year, sport.
    """
    form = rf"(?i)^https://{RECRUITING_HOST}/college/([a-z0-9-]+)/season/(\d{{4}})-(football|basketball|womens-basketball)/commits/$"
    part = lambda i: F.regexp_extract("url", form, i)
    rows = links.withColumn("name", F.trim("label")).where(F.col("url").rlike(form) & (F.col("name") != ""))
    rows = rows.where((part(2) == F.col("year").cast("string")) & (F.lower(part(3)) == F.col("sport")))
    return rows.select(*[c for c in links.columns if c not in ("url", "label")], F.lower(part(1)).alias("slug"), "name")


def schools_of_candidates(candidates: DataFrame, schools: DataFrame, names: DataFrame) -> DataFrame:
    """The one school that each candidate means (K15): slug, school.  Literal names first, then without boilerplate."""
    said = schools.select("school", F.col("name").alias("said")).unionByName(names.select("school", F.col("alias").alias("said")))
    said = said.select("school", literal_name(F.col("said")).alias("literal"), school_name_key(F.col("said")).alias("loose"))
    c = candidates.select("slug", literal_name(F.col("name")).alias("literal"), school_name_key(F.col("name")).alias("loose"))
    # the least and greatest school of a name say whether it is one's, so a name that many share is a row and no product
    schools_of = lambda by: said.groupBy(by).agg(F.min("school").alias("lo"), F.max("school").alias("hi"))
    one = lambda by: c.join(schools_of(by), by).groupBy("slug").agg(F.min("lo").alias("school"), F.max("hi").alias("last"))
    literal, loose = one("literal"), one("loose")
    found = literal.withColumn("how", F.lit(0)).unionByName(loose.withColumn("how", F.lit(1)))
    first = F.row_number().over(Window.partitionBy("slug").orderBy("how"))
    return found.withColumn("r", first).where("r = 1 and school = last").select("slug", "school")


def provider_articles(articles: DataFrame) -> DataFrame:
    """Articles of a league that carry its and the team's category and name the school.

    articles: as ``sources.parsers.provider_news`` gives them, with names (the school's and team's, array); rows with an error_code stay.
    """
    from tidewire.functions.text import ascii_words, clean_text

    said = F.concat(F.lit(" "), ascii_words(F.concat_ws(" ", clean_text(F.col("title")), clean_text(F.col("description"), 2000))), F.lit(" "))
    keys = F.filter(F.transform("names", ascii_words), lambda x: F.char_length(x) >= 3)
    names = F.exists(keys, lambda x: F.contains(said, F.concat(F.lit(" "), x, F.lit(" "))))
    return articles.where(F.col("error_code").isNotNull() | names if "error_code" in articles.columns else names)
