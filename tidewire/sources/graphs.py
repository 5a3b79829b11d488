"""Pages that carry their state as an index graph (P6): rosters (P12) and schedules (P13) of one sport.

The state is one list of nodes; an object's fields, and the entries of a list, are the numbers of the nodes that they mean.  Nothing is
revived: a field is looked up one step deep (K21), in the page's own row, so no node is copied for each of its references.

What counts is anchored at containers, objects that own both the list and the sport: a page of several sports gives only what is the
asked one's, and lists that stand elsewhere in the graph, as in a sidebar, give nothing.  Pages without such data fall back on the theme's
static cards, whose links must lead to the sport's own route.

Pages come with the program that they are asked for: ``url``, ``aliases`` (normal labels of the sport), ``gender`` (mens, womens, coed or
null), ``slugs`` (routes that are known to be the sport's) and ``hosts`` (of the school, without www.); the keys of pages must not have
the name of a record's field.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tidewire.functions.dates import result_score, season_of, static_day
from tidewire.functions.sports import route_slugs
from tidewire.functions.text import plain, tidy
from tidewire.functions.urls import host_of, resolve_url, safe_url, source_route
from tidewire.operators.merge import unique_by_id
from tidewire.operators.official import LABEL_FIELDS, labels_match, roster_gender_matches
from tidewire.sources.parsers import MAX_DOCUMENT, MAX_NODES, MAX_RECORDS, MAX_SCALAR

CHANGED, UNVERIFIED = "source-format-changed", "source-scope-unverified"
_STATE = r"""(?is)<script\b(?=[^>]*\bid=["']?__NUXT_DATA__\b)(?=[^>]*\btype=["']?application/json\b)[^>]*>(.*?)</script\s*>"""


def with_graph(pages: DataFrame) -> DataFrame:
    """Pages with the nodes of their state, each in the list of its kind and null in the others, and whether the state is ``sound``.

    ``texts`` has texts and numbers, ``objects`` maps from a field to a node's number, ``lists`` the numbers of lists, ``flags`` booleans.
    """
    scripts = F.regexp_extract_all("text", F.lit(_STATE), F.lit(1))
    nodes = F.try_variant_get(F.try_parse_json(F.get(scripts, F.lit(0))), "$", "array<variant>")
    sound = (F.size(scripts) == 0) | F.coalesce((F.size(scripts) == 1) & (F.size("nodes") <= MAX_NODES), F.lit(False))
    rows = pages.withColumn("nodes", nodes).withColumn("sound", sound)
    rows = rows.withColumn("nodes", F.when(F.size("nodes") <= MAX_NODES, F.transform("nodes", lambda n: F.struct(n.alias("n"), F.schema_of_variant(n).alias("kind")))))
    is_number = lambda kind: kind.rlike("^(?:BIGINT|DECIMAL|DOUBLE)")
    text = lambda x: F.when(x["kind"] == "STRING", F.try_variant_get(x["n"], "$", "string")).when(
        is_number(x["kind"]), F.regexp_replace(F.try_variant_get(x["n"], "$", "string"), r"\.0+$", "")
    )
    number = lambda v: F.when(F.schema_of_variant(v) == "BIGINT", F.try_variant_get(v, "$", "int"))
    fields = lambda x: F.when(x["kind"].startswith("OBJECT"), F.transform_values(F.try_variant_get(x["n"], "$", "map<string, variant>"), lambda _, v: number(v)))
    entries = lambda x: F.when(x["kind"].startswith("ARRAY"), F.transform(F.try_variant_get(x["n"], "$", "array<variant>"), number))
    flag = lambda x: F.when(x["kind"] == "BOOLEAN", F.try_variant_get(x["n"], "$", "boolean"))
    every = {"texts": text, "objects": fields, "lists": entries, "flags": flag}
    return rows.select("*", *(F.transform("nodes", f).alias(name) for name, f in every.items())).drop("nodes")


class Graph:
    """Looking up the nodes of a page: its row has the columns of ``with_graph``, and an object is a map of them."""

    @staticmethod
    def own(node: Column, *keys: str) -> Column:
        """Whether an object has all the fields."""
        return reduce(lambda a, b: a & b, (F.map_contains_key(node, k) for k in keys))

    @staticmethod
    def _of(name: str, node: Column, key: str) -> Column:
        return F.get(F.col(name), F.try_element_at(node, F.lit(key)))

    def field(self, node: Column, key: str) -> Column:
        """A text or number as text; null for anything else."""
        return self._of("texts", node, key)

    def flag(self, node: Column, key: str) -> Column:
        return self._of("flags", node, key)

    def said(self, node: Column, *keys: str) -> Column:
        """The first of the fields that says something."""
        return F.coalesce(*(F.nullif(self.field(node, k), F.lit("")) for k in keys))

    def object(self, node: Column, key: str) -> Column:
        return self._of("objects", node, key)

    def entries(self, node: Column, key: str) -> Column:
        """The numbers of a list; null if the field is no list."""
        return self._of("lists", node, key)

    def items(self, node: Column, key: str) -> Column:
        """The objects of a list."""
        return F.filter(F.transform(self.entries(node, key), lambda i: F.get(F.col("objects"), i)), lambda x: x.isNotNull())

    def labels(self, sport: Column) -> Column:
        """The labels that a sport object declares."""
        return F.filter(F.array(*(self.field(sport, k) for k in LABEL_FIELDS)), lambda x: x.isNotNull() & (x != ""))

    def containers(self, listed: str, other: str, aliases: Column) -> Column:
        """Objects that own the list, another field and the asked sport."""
        owners = F.filter("objects", lambda n: F.coalesce(self.own(n, listed, other, "sport"), F.lit(False)))
        return F.filter(owners, lambda n: labels_match(self.labels(self.object(n, "sport")), aliases))


def _opened(pages: DataFrame, kind: str, listed: str, other: str) -> DataFrame:
    """Pages with ``held`` (the lists of their containers), ``season``, ``empty`` (a container has none), and what is wrong so far."""
    g = Graph()
    rows = with_graph(pages)
    rows = rows.withColumn("found", F.coalesce(g.containers(listed, other, F.col("aliases")), F.array().cast("array<map<string, int>>")))
    held = F.transform("found", lambda c: F.struct(g.items(c, listed).alias("items"), F.size(g.entries(c, listed)).alias("n"), g.said(g.object(c, "season"), "title").alias("season")))
    rows = rows.withColumn("held", held)
    seasons = F.filter(F.transform("held", lambda x: x["season"]), lambda s: s.isNotNull())
    heading = plain(F.regexp_extract("text", r"(?is)<h1\b[^>]*>(.*?)</h1>", 1), 300)
    host = host_of(F.col("url"))
    code = (
        F.when(F.col("text").isNull(), "empty-response").when(F.octet_length("text") > MAX_DOCUMENT, "response-too-large")
        .when(safe_url(F.col("url")).isNull() | ~F.coalesce(F.array_contains("hosts", host), F.lit(False)) | ~source_route(F.col("url"), F.col("slugs"), kind), UNVERIFIED)
        .when(~F.col("sound") | F.exists("held", lambda x: x["items"].isNull() | (x["n"] > MAX_RECORDS)), CHANGED)
    )
    return rows.withColumn("season", F.coalesce(F.try_element_at(seasons, F.lit(-1)), season_of(heading, kind))).withColumn(
        "empty", F.exists("held", lambda x: x["n"] == 0)
    ).withColumn("error_code", code)


def _settled(rows: DataFrame, keys: list[str], cards: Column, fields: list[str]) -> DataFrame:
    """A row per record of the graph, else per static card; or one row (pos -1) of a page without any, with its code."""
    rows = rows.withColumn("cards", F.when(F.col("error_code").isNull() & (F.size("told") == 0) & ~F.col("empty"), cards))
    records = F.when(F.size("told") > 0, F.col("told")).otherwise(F.coalesce("cards", F.array().cast(rows.schema["told"].dataType)))
    long = F.exists("records", lambda r: F.greatest(*(F.coalesce(F.char_length(r[f]), F.lit(0)) for f in fields)) > MAX_SCALAR)
    rows = rows.withColumn("records", records)
    wrong = F.exists("cards", lambda c: ~F.coalesce(F.arrays_overlap(route_slugs(c["route"]), F.col("slugs")), F.lit(False)))
    code = (
        F.coalesce("error_code", F.when((F.size("records") > MAX_RECORDS) | long, CHANGED), F.when(F.coalesce(wrong, F.lit(False)), UNVERIFIED),
                   F.when((F.size("records") == 0) & ~F.col("empty"), CHANGED))
    )
    rows = rows.withColumn("error_code", code).withColumn("records", F.when(F.col("error_code").isNull(), F.col("records")))
    out = rows.select(*keys, "url", "hosts", "season", "error_code", F.posexplode_outer("records").alias("pos", "r"))
    link = resolve_url(F.col("r.path"), F.col("url"))
    return out.withColumn("pos", F.coalesce("pos", F.lit(-1))).withColumn("link", F.when(F.array_contains("hosts", host_of(link)), link))


def _whole(rows: DataFrame, keys: list[str], wrong: Column, columns: dict[str, Column]) -> DataFrame:
    """Records of sound pages, the last of each id; a page with one wrong record is one row with the code."""
    page = Window.partitionBy(*keys)
    rows = rows.withColumn("wrong", F.max(F.when(F.col("pos") >= 0, wrong).otherwise(F.lit(False))).over(page))
    rows = rows.where(~F.col("wrong") | (F.col("pos") == 0)).withColumn("error_code", F.when(F.col("wrong"), CHANGED).otherwise(F.col("error_code")))
    rows = rows.withColumn("pos", F.when(F.col("wrong"), -1).otherwise(F.col("pos")))
    good = F.col("pos") >= 0
    out = rows.select(*keys, "error_code", "pos", "season", *(F.when(good, c).alias(n) for n, c in columns.items()))
    return unique_by_id(out, [*keys, "error_code", "id"])


_PLAYER = ("id", "name", "path", "position", "jersey", "year", "image", "route")
_GAME = ("id", "date", "opponent", "status", "venue", "home_away", "team_score", "opponent_score", "path", "route")


def official_rosters(pages: DataFrame, keys: list[str]) -> DataFrame:
    """keys, error_code, pos, season, id, name, position, jersey, year, image_url, url: the players of the asked sport.

    A page that says so itself that it has no players is one row without an error_code.
    """
    rows = _opened(pages, "roster", "players", "displayTitle")
    g = Graph()
    hidden = lambda p: F.coalesce(g.flag(p, "hide"), F.lit(False))
    other = lambda p: g.object(p, "sport").isNotNull() & ~labels_match(g.labels(g.object(p, "sport")), F.col("aliases"))
    gender = lambda p: roster_gender_matches(F.nullif(g.field(p, "gender"), F.lit("")), F.col("gender"))
    players = F.filter(F.flatten(F.transform("held", lambda x: x["items"])), lambda p: ~hidden(p) & gender(p) & ~other(p))
    values = lambda p: {
        "id": g.said(p, "rosterPlayerId"), "name": F.concat_ws(" ", g.said(p, "firstName"), g.said(p, "lastName")), "path": g.said(p, "call_to_action"),
        "position": g.said(p, "positionShort", "positionLong"), "jersey": g.said(p, "jerseyNumber"), "year": g.said(p, "academicYearLong", "academicYearShort"),
        "image": g.said(g.object(p, "image"), "absoluteUrl", "url"), "route": F.lit(None).cast("string"),
    }
    told = F.transform(players, lambda p: F.struct(*(v.alias(k) for k, v in values(p).items())))
    rows = rows.withColumn("told", F.when(F.col("error_code").isNull(), told).otherwise(F.array().cast(f"array<struct<{', '.join(f'{f}: string' for f in _PLAYER)}>>")))
    text = F.when(F.col("error_code").isNull() & (F.size("told") == 0) & ~F.col("empty"), F.col("text"))
    rows = _settled(rows, keys, static_players(text), list(_PLAYER))
    name = tidy(F.col("r.name"), 160)
    wrong = name.isNull() | (F.col("r.path").isNotNull() & F.col("link").isNull())
    image = resolve_url(F.col("r.image"), F.col("url"))
    return _whole(rows, keys, wrong, {
        "id": F.coalesce("r.id", "link", name), "name": name, "position": tidy(F.col("r.position"), 80), "jersey": tidy(F.col("r.jersey"), 10),
        "year": tidy(F.col("r.year"), 40), "image_url": image, "url": F.col("link"),
    })


# How sites abbreviate where a game is and how it ended.
WHERE = {"H": "home", "A": "away", "N": "neutral"}
ENDED = {"W": "Final - Win", "L": "Final - Loss", "T": "Final - Tie"}


def official_schedules(pages: DataFrame, keys: list[str]) -> DataFrame:
    """keys, error_code, pos, season, id, date, opponent, status, venue, home_away, team_score, opponent_score, url: games of the asked sport.

    ``pos`` is the place on the page; by date and then ``pos`` is the published order (O3).
    """
    rows = _opened(pages, "schedule", "games", "season")
    g = Graph()
    of = lambda values, key: F.element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), key)
    values = lambda p: {
        "id": g.said(p, "id"), "date": F.regexp_extract(g.said(p, "date"), r"^(\d{4}-\d{2}-\d{2})(?:[T ]|$)", 1), "opponent": g.said(g.object(p, "opponent"), "title"),
        "status": F.coalesce(g.said(p, "noplay_text"), of(ENDED, g.field(g.object(p, "result"), "status")), g.said(p, "game_state_display")),
        "venue": F.coalesce(g.said(g.object(p, "facility"), "title"), g.said(p, "location")), "home_away": of(WHERE, g.field(p, "location_indicator")),
        "team_score": g.field(g.object(p, "result"), "team_score"), "opponent_score": g.field(g.object(p, "result"), "opponent_score"),
        "path": g.said(p, "game_center_link"), "route": F.lit(None).cast("string"),
    }
    games = F.flatten(F.transform("held", lambda x: x["items"]))
    told = F.transform(games, lambda p: F.struct(*(v.alias(k) for k, v in values(p).items())))
    rows = rows.withColumn("told", F.when(F.col("error_code").isNull(), told).otherwise(F.array().cast(f"array<struct<{', '.join(f'{f}: string' for f in _GAME)}>>")))
    text = F.when(F.col("error_code").isNull() & (F.size("told") == 0) & ~F.col("empty"), F.col("text"))
    # a static game needs no link; what anchors it is the route of the page
    cards = F.transform(static_games(text), lambda c: F.struct(
        c["id"].alias("id"), F.date_format(static_day(c["date"], c["toggle"], c["label"]), "yyyy-MM-dd").alias("date"),
        *(c[f].alias(f) for f in _GAME[2:-1]), F.concat(F.lit("/sports/"), F.get("slugs", F.lit(0))).alias("route"),
    ))
    rows = _settled(rows, keys, cards, list(_GAME))
    day, opponent = F.try_to_timestamp("r.date", F.lit("yyyy-MM-dd")), tidy(F.col("r.opponent"))
    identity = F.coalesce("r.id", F.concat_ws("|", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), opponent))
    return _whole(rows, keys, day.isNull() | opponent.isNull(), {
        "id": identity, "date": day, "opponent": opponent, "status": F.coalesce(tidy(F.col("r.status"), 80), F.lit("Scheduled")), "venue": tidy(F.col("r.venue")),
        "home_away": F.col("r.home_away"), "team_score": result_score(F.col("r.team_score")), "opponent_score": result_score(F.col("r.opponent_score")), "url": F.col("link"),
    })


# ---- static cards of a theme

# The theme's class names, and how its results write scores.
_PLACED = re.compile(r"sidearm-schedule-game-(home|away|neutral)\b|sidearm-schedule-(home|away|neutral)-game\b")
_SCORES = re.compile(r"(?:^|[, ])(\d+(?:\.\d+)?)[-–](\d+(?:\.\d+)?)(?:\b|$)")
_ON_DAY = re.compile(r"\bon [A-Za-z]+ \d{1,2},? \d{4}\b")


def _array(*fields: str) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in fields]))


def _cards(texts: pd.Series, name: str, read) -> pd.Series:
    from tidewire.sources.cards import tree_of

    return pd.Series([[read(c) for c in tree_of(t).all(name)] if t and name[1:] in t else None for t in texts])


def _says(card, *names: str) -> str | None:
    found = card.first(*names)
    return (found.text() or None) if found is not None else None


def _inside(card, outer: str, inner: str):
    return next((x for o in card.all(outer) for x in o.all(inner)), None)


@pandas_udf(_array("id", "name", "path", "position", "jersey", "year", "image", "route"))
def static_players(texts: pd.Series) -> pd.Series:
    """The theme's player cards; the way to a player's page is also the route that anchors it."""

    def read(card):
        link, image = _inside(card, ".sidearm-roster-player-name", "a"), _inside(card, ".sidearm-roster-player-image", "img")
        path = link.attrs.get("href") if link is not None else None
        span = _inside(card, ".sidearm-roster-player-position", "span")
        return {
            "id": None, "name": link.text() if link is not None else None, "path": path, "route": path,
            "position": _says(card, ".sidearm-roster-player-position-long-short") or (span.text() if span is not None else None),
            "jersey": _says(card, ".sidearm-roster-player-jersey-number"), "year": _says(card, ".sidearm-roster-player-academic-year"),
            "image": (image.attrs.get("data-src") or image.attrs.get("src")) if image is not None else None,
        }

    return _cards(texts, ".sidearm-roster-player", read)


@pandas_udf(_array("id", "date", "toggle", "label", *_GAME[2:-1]))
def static_games(texts: pd.Series) -> pd.Series:
    """The theme's game cards with all that may tell their day."""

    def read(card):
        time, result = card.first("time[datetime]"), _says(card, ".sidearm-schedule-game-result") or ""
        scores, placed = _SCORES.search(result), _PLACED.search(card.attrs.get("class") or "")
        link = _inside(card, ".sidearm-schedule-game-links-recap", "a") or _inside(card, ".sidearm-schedule-game-links-boxscore", "a")
        return {
            "id": None, "date": time.attrs["datetime"] if time is not None else None, "toggle": _says(card, ".sidearm-schedule-game-toggle"),
            "label": next((x.attrs["aria-label"] for x in card.all("[aria-label]") if _ON_DAY.search(x.attrs["aria-label"] or "")), None),
            "opponent": _says(card, ".sidearm-schedule-game-opponent-name"), "status": result or "Scheduled", "venue": _says(card, ".sidearm-schedule-game-location"),
            "home_away": (placed[1] or placed[2]) if placed else None, "team_score": scores[1] if scores else None, "opponent_score": scores[2] if scores else None,
            "path": link.attrs.get("href") if link is not None else None,
        }

    return _cards(texts, ".sidearm-schedule-game", read)
