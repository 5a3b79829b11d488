"""Providers: mappings, inventories, and the JSON of league news, schedules and rosters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.operators import merge, providers, recruiting
from tidewire.plans.registry import Tables, pick, pick_sql, query, spread
from tidewire.sources import parsers

_SPORTS = ["football", "softball", "golf", "baseball"]
_PATHS = ["football/college-football", "baseball/college-softball", None, "wrong/path"]
_LEAGUES = [("football", "football/college-football", 1), ("softball", "baseball/college-softball", 2), ("baseball", "wrong/path", 3)]


def _mapped(t: Tables) -> DataFrame:
    """Customers as programs with their mappings checked: a sport, a team and a state each by their key."""
    k = F.col("c_custkey")
    programs = t.customer.select(k.alias("school"), pick(k, _SPORTS, "string").alias("sport"))
    mappings = t.customer.where(k % 5 != 0).select(
        k.alias("school"), pick(k, _SPORTS, "string").alias("sport"), F.when(k % 7 == 0, "x").otherwise(k.cast("string")).alias("team_id"),
        pick(k, _PATHS, "string").alias("team_path"), F.when(k % 3 == 0, "unmapped").otherwise("verified").alias("mapping_status"),
        F.when(k % 3 == 0, "ambiguous-provider-school-name").alias("mapping_reason"),
    )
    leagues = t.spark.createDataFrame(_LEAGUES, "sport string, league_path string, league_id int")
    return providers.resolved(programs, mappings, leagues)


_MAPPED = f"""m AS (SELECT c_custkey AS school, {pick_sql("c_custkey", _SPORTS)} AS sport,
    CASE WHEN c_custkey % 5 = 0 OR c_custkey % 3 = 0 THEN 'noProvider' WHEN c_custkey % 7 = 0 OR c_custkey % 4 > 1 THEN 'invalid-identity' ELSE 'verified' END AS status,
    CASE WHEN c_custkey % 5 = 0 THEN 'no-verified-league-inventory' WHEN c_custkey % 3 = 0 THEN 'ambiguous-provider-school-name' END AS reason FROM customer)"""


@query(f"WITH {_MAPPED} SELECT school, sport, status, reason, CASE WHEN status = 'verified' THEN CAST(school AS VARCHAR) END AS team_id FROM m", "K3 K4")
def resolved_providers(t: Tables) -> DataFrame:
    return _mapped(t).select("school", "sport", "status", "reason", "team_id")


@query(f"WITH {_MAPPED} SELECT school FROM m WHERE status = 'verified' AND school % 11 <> 1", "K5 R9")
def required_providers(t: Tables) -> DataFrame:
    """Requests that claim the verified identity or none; forged ones get nothing."""
    k = F.col("school")
    requests = _mapped(t).select("school", "sport", F.when(k % 11 == 1, "forged").when(k % 11 == 2, F.col("team_id")).alias("team_id"), F.lit(None).cast("string").alias("team_path"))
    return providers.required(requests, _mapped(t)).select("school")


@query("SELECT c_custkey AS school FROM customer WHERE c_custkey % 4 = 1 OR c_custkey % 6 = 5", "K25")
def requests_outside_catalog(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    programs = t.customer.select(k.alias("school"), k.alias("ncaa_id"), F.col("c_name").alias("name"), F.lit("golf").alias("sport"))
    requests = t.customer.select(k.alias("school"), F.when(k % 4 == 1, -1).otherwise(k).alias("ncaa_id"), F.col("c_name").alias("name"), F.when(k % 6 == 5, "polo").otherwise("golf").alias("sport"))
    return providers.outside_catalog(requests, programs).select("school")


@query(
    """SELECT l_suppkey AS league, CAST(l_partkey AS VARCHAR) AS id, CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'conflicting-team-inventory' END AS error_code
    FROM lineitem GROUP BY l_suppkey, l_partkey""",
    "F17 A8",
)
def league_inventory(t: Tables) -> DataFrame:
    """Teams of leagues, without placeholders; conflicting entries are errors."""
    teams = t.lineitem.select(F.col("l_suppkey").alias("league"), F.col("l_partkey").cast("string").alias("id"), F.lit("L").alias("location"), F.col("l_returnflag").alias("name"))
    tbd = t.supplier.select(F.col("s_suppkey").alias("league"), F.lit("-1").alias("id"), F.lit("TBD").alias("location"), F.lit("TBD TBD").alias("name"))
    return providers.league_teams(teams.unionByName(tbd), ["league"]).select("league", "id", "error_code")


@query(
    """SELECT c_custkey AS school, CASE WHEN c_custkey % 5 IN (0, 1, 4) THEN c_custkey END AS team_id, CASE WHEN c_custkey % 5 IN (0, 1, 4) THEN 'verified' ELSE 'unmapped' END AS status,
        CASE c_custkey % 5 WHEN 0 THEN 'exact-normalized-name' WHEN 1 THEN 'exact-normalized-name' WHEN 4 THEN 'reviewed-name-alias' END AS how,
        CASE c_custkey % 5 WHEN 2 THEN 'no-exact-or-reviewed-alias-match' WHEN 3 THEN 'ambiguous-provider-school-name' END AS reason FROM customer""",
    "C9 K14",
)
def matched_schools(t: Tables) -> DataFrame:
    """Schools by literal name, by name without boilerplate, not at all, ambiguously, by a reviewed alias."""
    k = F.col("c_custkey")
    schools = t.customer.select(k.alias("school"), F.concat(F.lit("The University of "), F.col("c_name")).alias("name"))
    names = t.customer.where(k % 5 == 4).select(k.alias("school"), F.concat(F.lit("Alias "), k.cast("string")).alias("alias"))
    kinds = {
        0: [F.concat(F.lit("The University of "), F.col("c_name"))], 1: [F.col("c_name")], 2: [F.concat(F.lit("Else "), k.cast("string"))],
        3: [F.col("c_name"), F.concat(F.col("c_name"), F.lit(" College"))], 4: [F.concat(F.lit("Alias "), k.cast("string"))],
    }
    teams = None
    for kind, told in kinds.items():
        for i, location in enumerate(told):
            part = t.customer.where(k % 5 == kind).select((k + i * 1_000_000_000).alias("team_id"), location.alias("location"))
            teams = part if teams is None else teams.unionByName(part)
    return providers.match_schools(schools, names, teams)


@query("SELECT p_name AS slug, min(p_brand) AS name FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) = 1", "A22 R24 K18")
def unambiguous_candidates(t: Tables) -> DataFrame:
    return providers.recruiting_candidates(t.part.select(F.col("p_name").alias("slug"), F.col("p_brand").alias("name"), F.col("p_partkey").alias("pos")))


@query("SELECT c_custkey, 'team-' || c_custkey AS slug, c_name AS name FROM customer WHERE c_custkey % 4 = 0", "P30 R24")
def recruiting_inventory(t: Tables) -> DataFrame:
    """Ranking links as candidates: another season, sport or host is none."""
    k = F.col("c_custkey")
    url = F.concat(
        F.when(k % 4 == 1, "https://other.com").otherwise("https://247sports.com"), F.lit("/college/Team-"), k.cast("string"), F.lit("/season/"), F.when(k % 4 == 2, "2025").otherwise("2026"),
        F.lit("-"), F.when(k % 4 == 3, "basketball").otherwise("football"), F.lit("/commits/"),
    )
    links = t.customer.select("c_custkey", url.alias("url"), F.concat(F.lit(" "), F.col("c_name")).alias("label"), F.lit(2026).alias("year"), F.lit("football").alias("sport"))
    return providers.inventory_rows(links).select("c_custkey", "slug", "name")


@query("SELECT 's' || c_custkey AS slug, c_custkey AS school FROM customer WHERE c_custkey % 3 <> 2", "K15")
def candidate_schools(t: Tables) -> DataFrame:
    """The school that each recruiting candidate means, by name or alias; names of two schools are none's."""
    k = F.col("c_custkey")
    schools = t.customer.select(k.alias("school"), F.concat(F.col("c_name"), F.lit(" University")).alias("name"))
    names = t.customer.where(k % 3 == 1).select(k.alias("school"), F.concat(F.lit("Alias "), k.cast("string")).alias("alias"))
    shared = t.customer.where(k % 3 == 2).select(k.alias("school"), F.lit("Everybody").alias("alias"))
    said = F.when(k % 3 == 0, F.concat(F.lit("The "), F.col("c_name"))).when(k % 3 == 1, F.concat(F.lit("alias "), k.cast("string"))).otherwise("everybody")
    candidates = t.customer.select(F.concat(F.lit("s"), k.cast("string")).alias("slug"), said.alias("name"))
    return providers.schools_of_candidates(candidates, schools, names.unionByName(shared))


# ---- JSON


@query(
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 1 THEN 'news-identity-mismatch' WHEN 2 THEN 'news-identity-mismatch' END AS error_code, CASE WHEN c_custkey % 4 IN (0, 3) THEN 'State ' || c_name END AS title
    FROM customer WHERE c_custkey % 4 <> 3""",
    "P14 R8 R10",
)
def provider_news(t: Tables) -> DataFrame:
    """League news: another header, too many articles, no mention of the school."""
    k = F.col("c_custkey")
    of = lambda kind, field, v: F.struct(F.lit(kind).alias("type"), F.lit(v if field == "teamId" else None).cast("bigint").alias("teamId"), F.lit(v if field == "leagueId" else None).cast("bigint").alias("leagueId"))
    article = lambda title, *c: F.struct(title.alias("headline"), F.lit("").alias("description"), F.array(*c).alias("categories"))
    ours = article(F.concat(F.when(k % 4 == 3, "Else ").otherwise("State "), F.col("c_name")), of("league", "leagueId", 1), of("team", "teamId", 2))
    other = article(F.lit("State but other team"), of("league", "leagueId", 1), of("team", "teamId", 3))
    articles = F.when(k % 4 == 2, F.array_repeat(other, 201)).otherwise(F.array(ours, other))
    told = F.struct(F.when(k % 4 == 1, "Other").otherwise("League").alias("header"), articles.alias("articles"))
    docs = spread(t.customer, "c_custkey").select("c_custkey", F.to_json(told).alias("text"), F.lit(1).alias("league_id"), F.lit(2).alias("team_id"), F.lit("League").alias("header"), F.array(F.lit("State")).alias("names"))
    rows = parsers.provider_news(docs, ["c_custkey", "league_id", "team_id", "header", "names"])
    return providers.provider_articles(rows).select("c_custkey", "error_code", "title")


_SIDE = "named_struct('id', '{id}', 'homeAway', '{where}', 'team', named_struct('displayName', {name}), 'score', named_struct('value', cast({score} as double)))"


@query(
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 1 THEN 'source-team-mismatch' WHEN 2 THEN 'invalid-event-scope' WHEN 3 THEN 'invalid-schedule' END AS error_code, CASE WHEN c_custkey % 4 = 0 THEN c_name END AS opponent,
        CASE WHEN c_custkey % 4 = 0 THEN 'home' END AS home_away, CASE WHEN c_custkey % 4 = 0 THEN 3.0::DOUBLE END AS team_score, CASE WHEN c_custkey % 4 = 0 THEN 'day' END AS date_precision FROM customer""",
    "P15 K24 A6 O3",
)
def provider_schedules(t: Tables) -> DataFrame:
    """A team's games: another team's document, a date without zone, too many games; a repeated id counts once."""
    sides = f"array({_SIDE.format(id=2, where='home', name=chr(39) + 'T' + chr(39), score=3)}, {_SIDE.format(id=3, where='away', name='c_name', score=1)})"
    date = "case when c_custkey % 4 = 2 then '2026-01-01T00:00' else '2026-01-01T00:00Z' end"
    event = f"named_struct('id', 'e', 'date', {date}, 'timeValid', false, 'competitions', array(named_struct('neutralSite', false, 'competitors', {sides})))"
    doc = f"to_json(named_struct('team', named_struct('id', case when c_custkey % 4 = 1 then '9' else '2' end), 'events', array_repeat({event}, case when c_custkey % 4 = 3 then 401 else 2 end)))"
    docs = spread(t.customer, "c_custkey").select("c_custkey", F.expr(doc).alias("text"), F.lit(2).alias("team_id"))
    return parsers.provider_schedule(docs, ["c_custkey", "team_id"]).select("c_custkey", "error_code", "opponent", "home_away", "team_score", "date_precision")


@query(
    """SELECT c_custkey, unnest(CASE c_custkey % 4 WHEN 0 THEN ['p', 'q'] ELSE [NULL] END) AS id, unnest(CASE c_custkey % 4 WHEN 0 THEN [c_name, 'Q'] ELSE [NULL] END) AS name,
        unnest(CASE c_custkey % 4 WHEN 0 THEN ['QB', 'WR'] ELSE [NULL] END) AS position, unnest(CASE c_custkey % 4 WHEN 0 THEN [NULL, NULL] WHEN 1 THEN ['source-team-mismatch'] WHEN 2 THEN ['invalid-athlete'] ELSE ['roster-too-large'] END) AS error_code
    FROM customer""",
    "P16 A6",
)
def provider_rosters(t: Tables) -> DataFrame:
    """Grouped and single players, the last of an id; another team, a player without name, too many."""
    player = lambda i, name, pos: f"'{{\"id\":\"{i}\",\"displayName\":\"', {name}, '\",\"position\":{{\"abbreviation\":\"{pos}\"}}}}'"
    group = f"concat('{{\"items\":[', {player('p', 'c_name', 'K')}, ',', {player('p', 'c_name', 'QB')}, ']}}')"
    more = f"case when c_custkey % 4 = 3 then repeat(concat(',', {player('r', 'c_name', 'K')}), 300) when c_custkey % 4 = 2 then ',{{\"id\":\"z\"}}' else '' end"
    doc = f"concat('{{\"team\":{{\"id\":\"', case when c_custkey % 4 = 1 then '9' else '2' end, '\"}},\"athletes\":[', {group}, ',', concat({player('q', chr(39) + 'Q' + chr(39), 'WR')}), {more}, ']}}')"
    docs = spread(t.customer, "c_custkey").select("c_custkey", F.expr(doc).alias("text"), F.lit(2).alias("team_id"))
    return parsers.provider_roster(docs, ["c_custkey", "team_id"]).select("c_custkey", "id", "name", "position", "error_code")


# ---- recruiting lists


@query(
    """SELECT c_custkey, unnest(['11', '12', '11', '13']) AS player_id, unnest(['committed', 'committed', 'enrolled', NULL]) AS status, unnest(['Hard Commits', 'Hard Commits', 'Enrollees', 'Transfers']) AS section
    FROM customer""",
    "P17 P18 W7 C4",
)
def recruiting_lists(t: Tables) -> DataFrame:
    """Rows of a list with the heading above them."""
    return _listed(t).select("c_custkey", "player_id", "status", "section")


def _listed(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    page = F.concat(
        F.lit("<h2>Hard Commits ("), F.when(k % 2 == 0, "2").otherwise("3"), F.lit(")</h2><ul><li><a href='/player/a-11'>"), F.col("c_name"),
        F.lit("</a></li><li><a href='/player/b-12'>B</a></li></ul><h2>Enrollees (1)</h2><ul><li><a href='/player/a-11'>"), F.when(k % 3 == 0, "Other").otherwise(F.col("c_name")),
        F.lit("</a></li></ul><h2>Transfers (1)</h2><ul><li><a href='/player/c-13'>C</a></li></ul>"),
    )
    rows = parsers.parse(spread(t.customer, "c_custkey").select("c_custkey", page.alias("text")), parsers.sections, parsers.SECTION_ROW, ["c_custkey"])
    return recruiting.listed(rows, ["c_custkey"])


@query(
    """SELECT c_custkey, c_custkey % 2 = 0 AS counts_agree, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END AS repeated, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS conflicts,
        c_custkey % 2 = 0 AND c_custkey % 3 <> 0 AS ok FROM customer""",
    "A9 A10 R16 P18",
)
def reconciled_lists(t: Tables) -> DataFrame:
    return recruiting.reconciled(_listed(t), ["c_custkey"]).select("c_custkey", "counts_agree", "repeated", "conflicts", "ok")


@query(
    "SELECT c_custkey, 5 AS national_rank, 2 AS position_rank, CASE WHEN c_custkey % 2 = 0 THEN 7 END AS state_rank, CASE WHEN c_custkey % 2 = 0 THEN 'TX' END AS ranking_state FROM customer",
    "P20",
)
def recruiting_ranks(t: Tables) -> DataFrame:
    line = F.when(F.col("c_custkey") % 2 == 0, "Natl. 5 QB #2 TX 7").otherwise("Natl. 5 QB #2")
    return t.customer.select("c_custkey", recruiting.ranks(line).alias("r")).select("c_custkey", "r.*")


@query(
    """SELECT c_custkey, unnest(['A', 'B', 'C']) AS section, unnest([2, 1, 1]) AS rows, unnest([c_custkey % 3 <> 1, TRUE, TRUE]) AS whole FROM customer""",
    "P18 A10",
)
def continued_offers(t: Tables) -> DataFrame:
    """Sections whose continuation takes the place of the rows shown first."""
    k = F.col("c_custkey")
    sections = t.customer.select("c_custkey", F.inline(F.array(*(F.struct(F.lit(s).alias("section"), F.lit(n).alias("declared")) for s, n in (("A", 2), ("B", 1), ("C", 1))))))
    row = lambda s, p: F.struct(F.lit(s).alias("section"), F.lit(p).alias("player_id"))
    shown = t.customer.select("c_custkey", F.inline(F.array(row("A", "1"), row("B", "3"), row("C", "4"))))
    more = t.customer.select("c_custkey", F.inline(F.when(k % 3 == 1, F.array(row("A", "2"), row("A", "5"))).otherwise(F.array(row("A", "1"), row("A", "2")))))
    return recruiting.continued(sections, shown, more, ["c_custkey"]).select("c_custkey", "section", "rows", "whole")


@query(
    """SELECT user_id, event_type, max(event_id) AS id, count(*) > 1 AS repeated FROM events GROUP BY ALL""",
    "R16 A6 O2 R4",
)
def latest_by_address(t: Tables) -> DataFrame:
    """The last record of each address, newest first (texts of dates; none sorts last)."""
    rows = t.events.select("user_id", "event_type", F.col("event_id").alias("id"), F.col("event_id").alias("pos"))
    last = merge.unique_by_id(rows, ["user_id", "event_type"])
    n = t.events.groupBy("user_id", "event_type").agg((F.count("*") > 1).alias("repeated"))
    out = last.join(n, ["user_id", "event_type"])
    return merge.by_date_text(out.withColumn("at", F.lit("x")), "at").select("user_id", "event_type", "id", "repeated")
