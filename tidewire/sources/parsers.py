"""Parsers: a document becomes rows, or one error code.

A parser is a function of (text, context) that returns dicts or raises ``SourceError``; exceptions that a document
of another shape causes are a change of the source's format, all others are errors of the program and are raised.
``parse`` applies it to a table of documents, a few at a time, so a document that cannot be read costs a row with its
code and never the job.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds of documents and lists.
MAX_FEED, MAX_ITEMS = 2_000_000, 200
MAX_DOCUMENT, MAX_RECORDS, MAX_SCALAR = 8_000_000, 1000, 4096
MAX_NODES = 150_000
MAX_LOCS, MAX_PAGES, MAX_ANCHORS = 1000, 3000, 6000
MAX_GAMES, MAX_PLAYERS, MAX_GRAPH = 400, 300, 100
#: Documents that are held as Python objects at a time.
PORTION = 16
_MEDIA = "{http://search.yahoo.com/mrss/}"
_ATOM = "{http://www.w3.org/2005/Atom}"


class SourceError(Exception):
    """A failure with a code that is published as the reason."""

    def __init__(self, code: str):
        super().__init__(code)
        self.code = code


Parser = Callable[[str, dict], Iterator[dict] | list[dict]]


def parse(documents: DataFrame, parser: Parser, row: T.StructType, context: list[str], text: str = "text") -> DataFrame:
    """context..., error_code, and the fields of ``row``: the parser's rows of each document in order (``pos``), or a
    row with the code; a document that has no rows gives one row whose code is null and ``pos`` is -1."""
    kept = T.StructType([documents.schema[c] for c in context])
    schema = T.StructType([*kept, T.StructField("error_code", T.StringType()), T.StructField("pos", T.IntegerType()), *row])
    arrow = T.StructType([*row]).fieldNames()

    def run(batches):
        held = []
        for batch in batches:
            for doc in (d for first in range(0, batch.num_rows, PORTION) for d in batch.slice(first, PORTION).to_pylist()):
                rows = []
                told = {c: doc[c] for c in context}
                try:
                    if doc[text] is None:
                        raise SourceError(doc.get("error_code") or "empty-response")
                    found = list(parser(doc[text], told))
                    if not found:
                        rows.append(told | {"error_code": None, "pos": -1})
                    for i, r in enumerate(found):
                        rows.append(told | {"error_code": None, "pos": i} | {k: r.get(k) for k in arrow})
                except SourceError as e:
                    rows = [told | {"error_code": e.code, "pos": -1}]
                except (ValueError, LookupError, TypeError, AttributeError, ET.ParseError, RecursionError):
                    rows = [told | {"error_code": "source-format-changed", "pos": -1}]
                held += rows
                if len(held) >= 1000:
                    yield batch_of(held)
                    held = []
        if held:
            yield batch_of(held)

    def batch_of(rows):
        return pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in rows], target)

    from pyspark.sql.pandas.types import to_arrow_schema

    names, target = schema.fieldNames(), to_arrow_schema(schema)
    extra = ["error_code"] if "error_code" in documents.columns and "error_code" not in context else []
    return documents.select(*context, text, *extra).mapInArrow(run, schema)


# ---- feeds

FEED_ROW = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("title", "url", "description", "published", "image_url", "image_alt", "author")]
    + [T.StructField("categories", T.ArrayType(T.StringType()))]
)


def _all_text(node) -> str | None:
    return "".join(node.itertext()).strip() if node is not None else None


def _one(node, *names: str):
    """The only child of a name; two of them are a changed format."""
    found = [c for n in names for c in node.findall(n)]
    if len(found) > 1:
        raise ValueError("more than one " + names[0])
    return found[0] if found else None


class _Images(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found: list[tuple[str, str | None]] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "img" and a.get("src") and len(self.found) < 3:
            self.found.append((a["src"], a.get("alt")))


def item_images(item, fragments: list[str]) -> list[tuple[str, str | None]]:
    """Candidates in order: media, enclosures, then images of the fragments."""
    out = [(n.get("url"), None) for tag in ("thumbnail", "content") for n in item.iter(_MEDIA + tag) if n.get("url")]
    out += [(n.get("url"), None) for n in item.findall("enclosure") if (n.get("type") or "").startswith("image/") and n.get("url")]
    for fragment in fragments:
        images = _Images()
        images.feed(fragment or "")
        out += images.found
    return out


def _said(node) -> str:
    return " ".join((_all_text(node) or "").split())


def _only(node, *names: str):
    """The one child of a name; none and two of them are a changed format."""
    found = [c for n in names for c in node.findall(n)]
    if len(found) != 1:
        raise SourceError("source-format-changed")
    return found[0]


def feed(text: str, context: dict) -> Iterator[dict]:
    """RSS 2.0 or Atom items.

    context, each optional: feed_title (must be the channel's), article_hosts (hosts that articles may have) or article_host, article_path
    (what their paths begin with), feed_url (a feed of one sport takes only its articles), image_hosts, most (characters that the document
    may have, instead of ``MAX_FEED``), untitled (whether items whose title is empty are given too).  A document must have one
    channel and one title, an item one title and one link, in Atom one without relation or of relation alternate; else it is an error.
    Items without title or address, or out of scope, are left out.
    """
    if len(text) > (context.get("most") or MAX_FEED) or not text.strip() or re.search(r"<!(?:DOCTYPE|ENTITY)", text, re.I):
        raise SourceError("source-format-changed")
    root = ET.fromstring(text.lstrip("\ufeff \r\n\t"))
    rss = root.tag == "rss" and root.get("version") == "2.0"
    if not rss and root.tag != _ATOM + "feed":
        raise SourceError("source-format-changed")
    space = "" if rss else _ATOM
    channel = _only(root, "channel") if rss else root
    title = _said(_only(channel, space + "title"))
    items = channel.findall("item" if rss else _ATOM + "entry")
    if (context.get("feed_title") and title != " ".join(context["feed_title"].split())) or len(items) > MAX_ITEMS:
        raise SourceError("source-format-changed")
    articles = context.get("article_hosts") or ([context["article_host"]] if context.get("article_host") else None)
    images = context.get("image_hosts")
    for item in items:
        name = _all_text(_only(item, space + "title"))
        links = [n for n in item.findall(space + "link") if rss or n.get("rel") in (None, "", "alternate")]
        if len(links) != 1:
            raise SourceError("source-format-changed")
        url = (_all_text(links[0]) if rss else links[0].get("href") or "").strip()
        if not (name or context.get("untitled")) or not url or not _in_scope(url, articles, context.get("article_path"), context.get("feed_url")):
            continue
        details = [_all_text(n) for n in item if n.tag in (space + "description", space + "summary", space + "content", "{http://purl.org/rss/1.0/modules/content/}encoded")]
        described = next((_all_text(n) for n in item if n.tag in (space + "description", space + "summary")), None)
        image = next(((u, a) for u, a in item_images(item, details) if not images or urlsplit(u).hostname in images), (None, None))
        creator, writer = item.find("{http://purl.org/dc/elements/1.1/}creator"), item.find(space + "author")
        if creator is None and writer is not None:
            creator = writer.find(space + "name") if writer.find(space + "name") is not None else writer
        yield {
            "title": name, "url": url, "description": described, "published": _all_text(item.find("pubDate" if rss else _ATOM + "published")),
            "image_url": image[0], "image_alt": image[1], "author": _all_text(creator), "categories": [c for n in item.findall(space + "category") if (c := n.get("term") or _all_text(n))],
        }


# Addresses of feeds of one sport, where their articles name the sport, and the teams that share their announcements.
_SPORT_FEED = re.compile(r"https://www\.ncaa\.com/news/([^/]+)/(?:d[123]|nc|fbs|fcs)/rss\.xml")
_SPORT_ARTICLE = re.compile(r"/(?:news|video|live-updates)/([^/]+)/")
_TRACK = re.compile(r"trackfield-(?:indoor|outdoor)-(?:men|women)")


def _in_scope(url: str, hosts: list[str] | None, path: str | None, feed_url: str | None) -> bool:
    """Whether an article is the feed's (P3), as ``functions.urls.in_article_scope`` decides on columns."""
    parts = urlsplit(url)
    if (hosts and parts.hostname not in hosts) or (path and not parts.path.startswith(path)):
        return False
    sport = _SPORT_FEED.fullmatch(feed_url or "")
    if not sport:
        return True
    route = _SPORT_ARTICLE.match(parts.path)
    named = route[1] if route else ""
    return bool(_TRACK.fullmatch(named)) if _TRACK.fullmatch(sport[1]) else named == sport[1]


# ---- data that pages embed

STORY_ROW = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("extractor", "title", "path", "published", "image_url", "image_alt", "category", "sport")]
    + [T.StructField("excluded", T.BooleanType())]
)


def embedded_json(text: str, pattern: str) -> Iterator[object]:
    """JSON literals that follow a pattern in a script, found by their balanced end and never evaluated (P5)."""
    decoder = json.JSONDecoder()
    for m in re.finditer(pattern, text):
        try:
            yield decoder.raw_decode(text, m.end())[0]
        except json.JSONDecodeError:
            continue


def index_graph(text: str) -> list | None:
    """The node list of a page's serialised state (P6), or None."""
    m = re.search(r"""<script[^>]*\bid=["']?__NUXT_DATA__["']?[^>]*>(.*?)</script>""", text, re.S)
    if not m:
        return None
    nodes = json.loads(m[1])
    if not isinstance(nodes, list) or len(nodes) > MAX_NODES:
        raise SourceError("source-format-changed")
    return nodes


def looked_up(nodes: list, value) -> object:
    """The node that an index names, one step deep."""
    return nodes[value] if isinstance(value, int) and not isinstance(value, bool) and 0 <= value < len(nodes) else None


def graph_objects(nodes: list) -> Iterator[dict]:
    """All objects of the graph with their fields looked up."""
    for node in nodes:
        if isinstance(node, dict):
            yield {k: looked_up(nodes, v) for k, v in node.items()}


def _scalar(value) -> str | None:
    if isinstance(value, str) and len(value) > MAX_SCALAR:
        raise SourceError("source-format-changed")
    return str(value) if isinstance(value, (str, int, float)) and not isinstance(value, bool) and value != "" else None


def official_stories(text: str, context: dict) -> Iterator[dict]:
    """Stories of an official page: embedded lists (P5), then the three shapes of the index graph."""
    if len(text) > MAX_DOCUMENT:
        raise SourceError("response-too-large")
    n = 0

    def story(extractor, title, path, published=None, image=None, alt=None, category=None, sport=None, excluded=False):
        nonlocal n
        n += 1
        if n > MAX_RECORDS:
            raise SourceError("source-format-changed")
        return {
            "extractor": extractor, "title": _scalar(title), "path": _scalar(path), "published": _scalar(published), "image_url": _scalar(image),
            "image_alt": _scalar(alt), "category": _scalar(category), "sport": _scalar(sport), "excluded": excluded,
        }

    for told in embedded_json(text, r"\bvar\s+obj\s*=\s*(?=\{)"):
        if isinstance(told, dict) and told.get("type") == "stories" and isinstance(told.get("data"), list):
            for s in told["data"]:
                if isinstance(s, dict):
                    sport = s.get("sport")
                    yield story("classic", s.get("story_headline") or s.get("title"), s.get("story_path") or s.get("url"), s.get("story_postdate") or s.get("date"),
                                s.get("story_image") or s.get("image"), sport=sport.get("title") if isinstance(sport, dict) else sport)
    nodes = index_graph(text)
    for o in graph_objects(nodes or []):
        if "storyHeadline" in o and "storyPath" in o:
            yield story("graph-story", o["storyHeadline"], o["storyPath"], o.get("storyPostdate"))
        elif "published_at" in o and "permalink" in o:
            if o.get("visibility") == "public":
                yield story("graph-post", o.get("title"), o["permalink"], o["published_at"])
        elif "sub_headline" in o and "url" in o and "sport" in o:
            yield story("graph-card", o.get("headline") or o["sub_headline"], o["url"], o.get("date"), excluded=bool(o.get("app_exclusive")))


# ---- providers' JSON, read by Spark itself

PROVIDER_NEWS = (
    "struct<header: string, link: struct<href: string>, articles: array<struct<id: bigint, headline: string, description: string, published: string, byline: string,"
    " images: array<struct<url: string, alt: string>>, links: struct<web: struct<href: string>>,"
    " categories: array<struct<type: string, teamId: bigint, leagueId: bigint>>>>>"
)


def _rows_or_error(documents: DataFrame, context: list[str], code, items) -> DataFrame:
    """context, error_code, pos, x: the items of a sound document, or one row with the code and pos -1.

    Code and items are columns before they are used, so a document is read once however often they are asked for.
    """
    told = documents.select(*context, code.alias("error_code"), items.alias("__items"))
    found = told.select(*context, "error_code", F.posexplode_outer(F.when(F.col("error_code").isNull(), F.col("__items"))).alias("pos", "x"))
    return found.where("error_code is not null or pos is not null").withColumn("pos", F.coalesce("pos", F.lit(-1)))


def provider_news(documents: DataFrame, context: list[str]) -> DataFrame:
    """Articles of a provider's league news that carry the league's and the team's category.

    context includes league_id and team_id; with header and league_url, the document must be that league's.  A document of more
    than ``MAX_ITEMS`` articles, or another league's, is one row with its error_code and nothing else.
    """
    documents, told = documents.withColumn("__told", F.from_json("text", PROVIDER_NEWS)), F.col("__told")
    other = F.lit(False)
    if "header" in context:
        other = ~told["header"].eqNullSafe(F.col("header"))
    if "league_url" in context:
        other |= ~told["link"]["href"].eqNullSafe(F.col("league_url"))
    code = F.when(told["articles"].isNull() | other | (F.size(told["articles"]) > MAX_ITEMS), "news-identity-mismatch")
    rows = _rows_or_error(documents, context, code, told["articles"])
    has = lambda kind, field, wanted: F.exists("x.categories", lambda c: (c["type"] == kind) & (c[field] == F.col(wanted)))
    ours = has("league", "leagueId", "league_id") & has("team", "teamId", "team_id")
    return rows.where(F.col("error_code").isNotNull() | ours).select(
        *context, "error_code", "pos", F.col("x.headline").alias("title"), F.col("x.links.web.href").alias("url"), F.col("x.description").alias("description"),
        F.col("x.published").alias("published"), F.get("x.images", F.lit(0))["url"].alias("image_url"), F.col("x.byline").alias("author"),
    )


PROVIDER_SCHEDULE = (
    "struct<team: struct<id: string>, events: array<struct<id: string, date: string, name: string, timeValid: boolean,"
    " competitions: array<struct<neutralSite: boolean, venue: struct<fullName: string>, status: struct<type: struct<description: string>>,"
    " competitors: array<struct<id: string, homeAway: string, team: struct<displayName: string>, score: struct<value: double>>>>>>>>"
)


def provider_schedule(documents: DataFrame, context: list[str], most: int = MAX_GAMES) -> DataFrame:
    """Games of a team's schedule, own and other side told apart, the last of each id by date.

    context includes team_id.  A document of another team, of too many games, or with a game that lacks its own side, opponent,
    id or zoned date is one row with its error_code.
    """
    documents, told = documents.withColumn("__told", F.from_json("text", PROVIDER_SCHEDULE)), F.col("__told")
    team = F.col("team_id").cast("string")
    sides = lambda e, own: F.filter(F.get(e["competitions"], F.lit(0))["competitors"], lambda c: (c["id"] == team) == F.lit(own))
    whole = lambda e: (
        e["id"].isNotNull() & F.coalesce(e["date"].rlike(r"(?:Z|[+-]\d\d:?\d\d)$"), F.lit(False)) & (F.size(sides(e, True)) > 0)
        & F.get(sides(e, False), F.lit(0))["team"]["displayName"].isNotNull()
    )
    code = (
        F.when(~told["team"]["id"].eqNullSafe(team), "source-team-mismatch")
        .when(told["events"].isNull() | (F.size(told["events"]) > most), "invalid-schedule")
        .when(~F.coalesce(F.forall(told["events"], whole), F.lit(False)), "invalid-event-scope")
    )
    rows = _rows_or_error(documents, context, code, told["events"])
    match = F.get("x.competitions", F.lit(0))
    own, other = F.get(sides(F.col("x"), True), F.lit(0)), F.get(sides(F.col("x"), False), F.lit(0))
    games = rows.select(
        *context, "error_code", "pos", F.col("x.id").alias("id"), F.col("x.date").alias("date"), F.col("x.name").alias("name"),
        F.when(F.col("x.timeValid") == F.lit(False), "day").when(F.col("x").isNotNull(), "instant").alias("date_precision"),
        match["status"]["type"]["description"].alias("status"), match["venue"]["fullName"].alias("venue"),
        F.when(match["neutralSite"], "neutral").otherwise(own["homeAway"]).alias("home_away"),
        other["team"]["displayName"].alias("opponent"), own["score"]["value"].alias("team_score"), other["score"]["value"].alias("opponent_score"),
    )
    from tidewire.operators.merge import unique_by_id

    return unique_by_id(games, [*context, "error_code", "id"])


PROVIDER_PLAYER = "struct<id: string, displayName: string, jersey: string, position: struct<abbreviation: string>, experience: struct<displayValue: string>>"
PROVIDER_ROSTER = f"struct<team: struct<id: string>, athletes: array<struct<items: array<{PROVIDER_PLAYER}>, id: string, displayName: string, jersey: string, position: string>>>"


def provider_roster(documents: DataFrame, context: list[str], most: int = MAX_PLAYERS) -> DataFrame:
    """Players of a team's roster, whose list is grouped, flat or both, the last of each id.

    context includes team_id.  Another team's document, too many players, or one without id or name: one row with the error_code.
    """
    documents = documents.withColumn("__grouped", F.from_json("text", PROVIDER_ROSTER))
    documents = documents.withColumn("__flat", F.from_json("text", f"struct<athletes: array<{PROVIDER_PLAYER}>>")["athletes"])
    grouped = F.col("__grouped")
    # both readings of the list side by side: an entry never reads the document again
    flat = F.coalesce("__flat", F.array().cast(f"array<{PROVIDER_PLAYER}>"))
    documents = documents.withColumn("__players", F.flatten(F.zip_with(grouped["athletes"], flat, lambda g, p: F.coalesce(g["items"], F.array(p)))))
    players = F.col("__players")
    code = (
        F.when(~grouped["team"]["id"].eqNullSafe(F.col("team_id").cast("string")), "source-team-mismatch")
        .when(players.isNull(), "invalid-roster")
        .when(F.size(players) > most, "roster-too-large")
        .when(~F.coalesce(F.forall(players, lambda p: p["id"].isNotNull() & p["displayName"].isNotNull()), F.lit(False)), "invalid-athlete")
    )
    rows = _rows_or_error(documents, context, code, players)
    from tidewire.operators.merge import unique_by_id

    return unique_by_id(rows.select(
        *context, "error_code", "pos", F.col("x.id").alias("id"), F.col("x.displayName").alias("name"), F.col("x.jersey").alias("jersey"),
        F.col("x.position.abbreviation").alias("position"), F.col("x.experience.displayValue").alias("year"),
    ), [*context, "error_code", "id"])


# ---- links, sitemaps, metadata

LINK_ROW = T.StructType([T.StructField(n, T.StringType()) for n in ("label", "url", "section")])
DENIED_FILES = r"(?i)\.(?:pdf|jpe?g|png|gif|mp4|zip)$"


class _Links(HTMLParser):
    """Links with their labels, and the list item's own label above them."""

    def __init__(self, base: str):
        super().__init__()
        self.base, self.href, self.label, self.found, self.anchors, self.heads = base, None, [], [], 0, []

    def handle_starttag(self, tag, attrs):
        if tag == "ul":
            self.heads.append(" ".join("".join(self.label).split()) if self.href is None else "")
            self.label = []
        if tag == "a":
            self.href, self.label = dict(attrs).get("href"), []
            self.anchors += self.href is not None
        elif tag == "li":
            self.label = []

    def handle_endtag(self, tag):
        if tag == "a" and self.href is not None:
            label = " ".join("".join(self.label).split())
            section = next((h for h in reversed(self.heads) if h), None)
            self.found.append({"label": label, "url": urljoin(self.base, self.href), "section": section})
            self.href = None
        elif tag == "ul" and self.heads:
            self.heads.pop()

    def handle_data(self, data):
        self.label.append(data)


def links(text: str, context: dict) -> Iterator[dict]:
    """Links among the first ``MAX_ANCHORS`` anchors of a page, on its own host, without files and mere fragments.

    context: url.  Menus that a page declares as JSON are read by ``sources.navigation`` (P26).
    """
    parser = _Links(context["url"])
    parser.feed(text)
    host = (urlsplit(context["url"]).hostname or "").removeprefix("www.")
    for link in parser.found[:MAX_ANCHORS]:
        parts = urlsplit(link["url"])
        if parts.scheme == "https" and (parts.hostname or "").removeprefix("www.") == host and not re.search(DENIED_FILES, parts.path):
            if not (parts.fragment and link["url"].split("#")[0] == context["url"].split("#")[0]):
                yield link


# A splash page's most anchors, what its way in says, and where it leads.
MAX_SPLASH = 15
_WAY_IN = re.compile(r"(?:continue to (?:home|site)|enter (?:site|website))", re.I)
_HOME = ("", "/", "/index.aspx")


def entrance(text: str, context: dict) -> Iterator[dict]:
    """The first link by which a splash page lets visitors in (P28): to the home of its own site, by one of the known labels.

    A page with more than ``MAX_SPLASH`` anchors of whatever kind is no splash page.  context: url.
    """
    parser = _Links(context["url"])
    parser.feed(text)
    if parser.anchors > MAX_SPLASH:
        return
    for link in links(text, context):
        if _WAY_IN.fullmatch(link["label"][:80]) and urlsplit(link["url"]).path in _HOME:
            yield link | {"url": link["url"].split("#")[0]}
            return


LOC_ROW = T.StructType([T.StructField("loc", T.StringType())])


def robots_sitemap(text: str, context: dict) -> Iterator[dict]:
    """The sitemap lines of a robots file."""
    for m in re.finditer(r"(?im)^\s*sitemap\s*:\s*(\S+)", text):
        yield {"loc": m[1]}


def sitemap(text: str, context: dict) -> Iterator[dict]:
    """Addresses of a sitemap or of an index of sitemaps (S16).  context: perhaps most, how many are read."""
    root = ET.fromstring(text.strip())
    most = context.get("most") or (MAX_LOCS if root.tag.endswith("sitemapindex") else MAX_PAGES)
    for i, node in enumerate(n for n in root.iter() if n.tag.rpartition("}")[2] == "loc"):
        if i >= most:
            break
        yield {"loc": (node.text or "").strip()}


META_ROW = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("og_title", "og_type", "og_image", "og_image_alt", "author", "body_image", "body_alt", "byline")]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("declared", "headings", "structured")]
)
# Where themes put headings, the article's own image and its byline; how many scripts are looked at.
_HEADINGS = ("h1", ".sidearm-story-headline")
_BYLINES = (".story-head__author", ".story-page__content__byline", ".sidearm-story-byline", ".story-byline")
_BODY_IMAGES = (".sidearm-story-image", ".story-page__image", ".story-page__hero")
MAX_SCRIPTS = 30


def article_metadata(text: str, context: dict) -> Iterator[dict]:
    """What a page declares of its article (P24), as it stands there; identity and precedence are decided on columns (``operators.enrich``).

    ``declared`` are all its canonical addresses, ``structured`` the texts of its JSON-LD scripts, in order.
    """
    from tidewire.sources.cards import tree_of

    if len(text) > MAX_DOCUMENT:
        raise SourceError("response-too-large")
    nodes = list(tree_of(text).walk())
    meta: dict[str, str] = {}
    declared, structured = [], []
    for n in nodes:
        a = n.attrs
        if n.tag == "meta" and a.get("content"):
            for name in {a.get("property"), a.get("name")} - {None}:
                meta.setdefault(name, a["content"])
            if a.get("property") == "og:url":
                declared.append(a["content"])
        elif n.tag == "link" and a.get("rel") == "canonical" and a.get("href"):
            declared.append(a["href"])
        elif n.tag == "script" and a.get("type") == "application/ld+json" and len(structured) < MAX_SCRIPTS:
            structured.append("".join(c for c in n.children if isinstance(c, str)))
    # only nodes with a class can fit the themes' names
    classed = [n for n in nodes if n.classes]
    headings = [n.text() for n in nodes if (n.classes or n.tag == "h1") and any(n.fits(s) for s in _HEADINGS)]
    headings += [h.text() for n in classed if n.fits(".story-page__content__title-box") for h in n.all("h2")]
    image = next((i for n in classed if any(n.fits(s) for s in _BODY_IMAGES) for i in n.all("img")), None) or _first_figure(classed)
    byline = next((n.text() for n in nodes if (n.classes and any(n.fits(s) for s in _BYLINES)) or n.attrs.get("itemprop") == "author"), None)
    yield {
        "declared": declared, "headings": headings, "structured": structured, "og_title": meta.get("og:title"), "og_type": meta.get("og:type"), "og_image": meta.get("og:image"),
        "og_image_alt": meta.get("og:image:alt"), "author": meta.get("author"), "byline": byline,
        "body_image": (image.attrs.get("data-src") or image.attrs.get("src")) if image else None, "body_alt": image.attrs.get("alt") if image else None,
    }


def _first_figure(nodes: list):
    """The image of a figure that begins an article's text."""
    for n in nodes:
        if n.fits(".entry-content"):
            first = n.first("", deep=False)
            if first is not None and first.tag == "figure":
                return first.first("img")
    return None


# ---- recruiting lists and directories

SECTION_ROW = T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "text", "href", "declared")])


class _Rows(HTMLParser):
    """Headings and list rows of a page, in order."""

    def __init__(self):
        super().__init__()
        self.rows, self.kind, self.buffer, self.href = [], None, [], None

    def handle_starttag(self, tag, attrs):
        if tag in ("h1", "h2", "h3", "li", "tr"):
            self.flush()
            self.kind = "heading" if tag[0] == "h" else "row"
        elif tag == "a" and self.kind == "row" and self.href is None:
            self.href = dict(attrs).get("href")

    def handle_endtag(self, tag):
        if tag in ("h1", "h2", "h3", "li", "tr"):
            self.flush()

    def handle_data(self, data):
        if self.kind:
            self.buffer.append(data)

    def flush(self):
        text = " ".join("".join(self.buffer).split())
        if self.kind and text:
            self.rows.append((self.kind, text, self.href))
        self.kind, self.buffer, self.href = None, [], None


def sections(text: str, context: dict) -> Iterator[dict]:
    """Headings, with the count that they declare in parentheses, and rows below them (P17, P18).  The carry-forward of
    headings and the reconciling of counts are window and aggregate operators."""
    if len(text) > 2_000_000 or re.search(r"(?i)<title>[^<]*(?:just a moment|access denied|attention required)", text):
        raise SourceError("source-format-changed")
    page = _Rows()
    page.feed(text)
    page.flush()
    for kind, said, href in page.rows:
        count = re.search(r"\((\d{1,4})\)\s*$", said) if kind == "heading" else None
        yield {"kind": kind, "text": said, "href": href, "declared": count[1] if count else None}


TABLE_ROW = T.StructType([T.StructField("cells", T.ArrayType(T.StringType()))])


class _Cells(HTMLParser):
    def __init__(self):
        super().__init__()
        self.rows, self.cell = [], None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def table_rows(text: str, context: dict) -> Iterator[dict]:
    """Cells of a page's table rows."""
    page = _Cells()
    page.feed(text)
    for cells in page.rows:
        if cells:
            yield {"cells": cells}
