"""Providers' addresses and identities: fixed forms that are built, compared and rebuilt, never followed as they come."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.urls import safe_url

# The providers' hosts and paths, the sports of each league, the kinds of lists.
LEAGUE_PATHS = {
    "football": "football/college-football",
    "basketball": "basketball/mens-college-basketball",
    "womens-basketball": "basketball/womens-college-basketball",
    "baseball": "baseball/college-baseball",
    "softball": "baseball/college-softball",
    "mens-volleyball": "volleyball/mens-college-volleyball",
    "womens-volleyball": "volleyball/womens-college-volleyball",
    "mens-soccer": "soccer/usa.ncaa.m.1",
    "womens-soccer": "soccer/usa.ncaa.w.1",
    "mens-ice-hockey": "hockey/mens-college-hockey",
    "womens-ice-hockey": "hockey/womens-college-hockey",
    "mens-lacrosse": "lacrosse/mens-college-lacrosse",
    "womens-lacrosse": "lacrosse/womens-college-lacrosse",
    "field-hockey": "field-hockey/womens-college-field-hockey",
    "mens-water-polo": "water-polo/mens-college-water-polo",
    "womens-water-polo": "water-polo/womens-college-water-polo",
}
TEAM_API = "https://site.api.espn.com/apis/site/v2/sports/"
LINK_PREFIX = "https://www.espn.com/"
RECRUITING_HOST = "247sports.com"
RECRUITING_SPORTS = {"football": "Football", "basketball": "Basketball", "womens-basketball": "Women's Basketball"}
VIEW_PATH = "~/Views/SkyNet/RecruitInterest/_SimpleDetailedSetForSeason.ascx"
VIEW_PATH_ENCODED = "~%2FViews%2FSkyNet%2FRecruitInterest%2F_SimpleDetailedSetForSeason.ascx"
RATING_SYSTEMS = ("247Sports", "Composite")
CHALLENGE = r"(?i)Sorry, you have been blocked|Attention Required!|Just a moment\.\.\."
MAX_PAGE = 2_000_000


def league_path(sport: Column) -> Column:
    """The path of a sport's league; null if the provider has none."""
    return F.element_at(F.create_map(*(F.lit(x) for kv in LEAGUE_PATHS.items() for x in kv)), sport)


def team_url(path: Column, team_id: Column, collection: Column, news_url: Column) -> Column:
    """The address of a team's collection; null unless the identity is well formed."""
    fixed = F.concat(F.lit(TEAM_API), path, F.lit("/teams/"), team_id, F.lit("/"), collection)
    return F.when(collection == "news", news_url).when(collection.isin("roster", "schedule") & team_id.rlike(r"^\d+$"), fixed)


def recruiting_url(slug: Column, sport: Column, year: Column, kind: Column) -> Column:
    """The address of a school's recruiting list; null outside the scope."""
    ok = slug.rlike("^[a-z0-9-]+$") & sport.isin(*RECRUITING_SPORTS) & year.between(2000, 2100) & kind.isin("commits", "offers")
    told = F.concat(F.lit(f"https://{RECRUITING_HOST}/college/"), slug, F.lit("/season/"), year.cast("string"), F.lit("-"), sport, F.lit("/"), kind, F.lit("/"))
    return F.when(ok, told)


def exact_source(url: Column, expected: Column) -> Column:
    """Whether an address is the expected list itself, without query or fragment."""
    return F.coalesce(safe_url(url).isNotNull() & ~url.rlike("[?#]") & (F.lower(url) == expected), F.lit(False))


def continuation_url(url: Column, expected: Column) -> Column:
    """A list's continuation rebuilt from its one free part; null if it is anything else."""
    query = F.regexp_extract(url, r"\?([^#]*)$", 1)
    names = F.array_sort(F.transform(F.split(query, "&"), lambda p: F.regexp_extract(p, "^([^=]*)", 1)))
    view = F.regexp_extract(query, r"(?:^|&)ViewPath=([^&]*)", 1)
    position = F.regexp_extract(query, r"(?:^|&)Position=([^&]*)", 1)
    ok = (F.regexp_replace(url, r"\?.*$", "") == expected) & (names == F.array(F.lit("Position"), F.lit("ViewPath")))
    ok &= view.isin(VIEW_PATH, VIEW_PATH_ENCODED) & position.rlike(r"^\d{1,3}$") & ~F.contains(url, F.lit("#"))
    return F.when(ok, F.concat(expected, F.lit(f"?ViewPath={VIEW_PATH_ENCODED}&Position="), position))


def equivalent_continuation(url: Column, expected: Column) -> Column:
    """Whether an address is the given continuation, however it is written."""
    return F.coalesce(continuation_url(url, F.regexp_replace(expected, r"\?.*$", "")) == expected, F.lit(False))


def rating_mode(labels: Column) -> Column:
    """struct (mode, error): the rating system that a list's selector shows, if it is the one that is read."""
    shown = F.filter(labels, lambda x: x.isin(*RATING_SYSTEMS))
    bad = (F.size(shown) > 1) | ((F.size(shown) == 1) & (F.get(shown, F.lit(0)) != RATING_SYSTEMS[0]))
    return F.struct(F.when(~bad & (F.size(shown) == 1), "247sports").alias("mode"), F.when(bad, "unsupported-rating-system").alias("error"))


def external_link(links: Column) -> Column:
    """The first desktop link on the provider's own host (T43).  links: array of struct (rel array, href)."""
    fits = F.filter(links, lambda x: F.array_contains(x["rel"], "desktop") & x["href"].startswith(LINK_PREFIX))
    return safe_url(F.get(fits, F.lit(0))["href"])


def page_challenge(text: Column) -> Column:
    """The code of a recruiting page that is none."""
    return F.when(text.isNull() | (F.char_length(text) > MAX_PAGE), "invalid-response-size").when(text.rlike(CHALLENGE), "access-challenge")


def heading_scope(heading: Column) -> Column:
    """struct (name, year, sport, kind, declared) of a list's heading."""
    form = r"^(.*?) (\d{4}) (Football|Basketball|Women's Basketball) (Commits|Offers) \((\d+)\)(?: All-Time Commits)?$"
    part = lambda i: F.nullif(F.regexp_extract(heading, form, i), F.lit(""))
    return F.struct(
        part(1).alias("name"), part(2).try_cast("int").alias("year"), part(3).alias("sport"), F.lower(part(4)).alias("kind"),
        part(5).try_cast("int").alias("declared"),
    )


def page_context(heading: Column, canonicals: Column, source: Column, name: Column, year: Column, sport: Column, kind: Column, expected: Column) -> Column:
    """The code of a list that is not the one asked for, or null (P19): source, canonical links, heading, declared count."""
    told = heading_scope(heading)
    labels = F.element_at(F.create_map(*(F.lit(x) for kv in RECRUITING_SPORTS.items() for x in kv)), sport)
    same = (told["name"] == name) & (told["year"] == year) & (told["sport"] == labels) & (told["kind"] == kind)
    return (
        F.when(~exact_source(source, expected), "source-scope-mismatch")
        .when((F.size(canonicals) != 1) | ~exact_source(F.get(canonicals, F.lit(0)), expected), "canonical-scope-mismatch")
        .when(~F.coalesce(same, F.lit(False)), "heading-scope-mismatch")
        .when(told["declared"] > 1000, "record-count-exceeds-budget")
    )
