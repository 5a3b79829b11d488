"""Routing: feeds' items to programs, official pages' stories to programs, conference stories to schools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions import sports, text
from tidewire.operators import classify, discovery, joins, official
from tidewire.operators.classify import schools_mentioned
from tidewire.plans.parsed import ALIASES, _mentions_sql
from tidewire.plans.registry import Tables, cases, pick, pick_sql, query, spread
from tidewire.sources import cards, parsers

# ---- feeds

#: Names that count in a summary.
STRONG = ("with the", "for the", "and the")


@query(_mentions_sql(STRONG), "C2 K17 O6")
def strong_mentions(t: Tables) -> DataFrame:
    """Which whole names texts mention; other names take their words but do not count."""
    mentions = schools_mentioned(ALIASES, STRONG)(text.ascii_words(F.col("text")))
    return t.documents.select("doc_id", F.array_join(F.sort_array(mentions), ",").alias("owners"))


_F = "football"
_ITEMS = {
    "title": ("string", ["tigers win", "tigers win", "tigers win", "other team wins", "lsu betting odds", "lsu nfl star", "lsu wins", "lsu wins", "womens night", "lsu golf", "", "lsu nfl recruits", "prep star signs"]),
    "details": ("string", ["", "", "", "", "", "", "", "", "", "", "", "", "lsu"]),
    "fs": ("string", ["lsu", None, "lsu", "lsu", "lsu", "lsu", None, None, "lsu", "lsu", "lsu", "lsu", "lsu"]),
    "fp": ("string", [_F, _F, _F, _F, _F, _F, None, None, _F, _F, _F, _F, _F]),
    "ts": ("array<string>", [["lsu"], [], [], ["osu"], ["lsu"], ["lsu"], ["lsu"], ["lsu"], ["lsu"], ["lsu"], ["lsu"], ["lsu"], ["lsu"]]),
    "al": ("array<string>", [[], [], [], [], [], [], [], [], [], ["golf"], [], [], []]),
    "st": ("array<string>", [[], [], [], [], [], [], [_F], [_F, "golf"], [], [], [], [], []]),
}
cases(
    "feed_item_verdicts", "C1 F5", "documents", "doc_id", _ITEMS,
    {"accepted": ("BOOLEAN", [True, False, True, False, False, False, True, False, False, False, False, True, True])},
    lambda c: {"accepted": classify.accepts(
        c["title"], c["details"], F.lit("lsu"), F.lit(_F), F.lit("men"), c["fs"], c["fp"], F.lit(False), c["ts"], F.array().cast("array<string>"), c["al"], c["st"], c["st"]
    )},
)

_PROGRAMS = [("football", "men", "Football"), ("basketball", "men", "Men's Basketball"), ("womens-basketball", "women", "Women's Basketball"), ("mens-golf", "men", "Men's Golf"), ("softball", "women", "Softball")]
_PHRASES = ["the quarterback", "women hoops tonight", "mens hoops", "flag football for all", "golf and softball", "nothing here"]
_NAMED = ["football", "womens-basketball", "basketball", "", "mens-golf,softball", ""]


@query(
    """SELECT * FROM (VALUES ('football', 'football'), ('football', 'quarterback'), ('football', 'touchdown'), ('football', 'linebacker'), ('football', 'wide receiver'),
        ('football', 'running back'), ('mens-golf', 'golf'), ('softball', 'softball'), ('basketball', 'basketball'), ('basketball', 'hoops'), ('basketball', 'hardwood'),
        ('basketball', 'point guard'), ('basketball', 'shooting guard'), ('basketball', 'wbb'), ('basketball', 'mbb'), ('womens-basketball', 'basketball'),
        ('womens-basketball', 'hoops'), ('womens-basketball', 'hardwood'), ('womens-basketball', 'point guard'), ('womens-basketball', 'shooting guard'),
        ('womens-basketball', 'wbb'), ('womens-basketball', 'mbb')) v(slug, term)""",
    "R6",
)
def sport_terms(t: Tables) -> DataFrame:
    programs = t.spark.createDataFrame(_PROGRAMS, "slug string, gender string, name string")
    return classify.sport_terms(programs).select("slug", "term")


@query(f"SELECT doc_id, {pick_sql('doc_id', _NAMED)} AS sports FROM documents", "C3")
def explicit_sports(t: Tables) -> DataFrame:
    programs = t.spark.createDataFrame(_PROGRAMS, "slug string, gender string, name string")
    terms = [tuple(r) for r in classify.sport_terms(programs).collect()]
    # words of the corpus never are sports, so each text says what is put before it
    said = F.concat_ws(" ", pick(F.col("doc_id"), _PHRASES, "string"), F.regexp_replace(text.ascii_words(F.col("text")), r"\b(?:men|man|women|woman|prep)\b", ""))
    found = F.array_sort(classify.explicit_sports(said, terms))
    return t.documents.select("doc_id", F.array_join(found, ",").alias("sports"))


# ---- official pages


def _official_page(name, key):
    """A page with embedded stories and an index graph; ``name`` and ``key`` are columns of text."""
    graph = F.concat(
        F.lit('<script id="__NUXT_DATA__" type="application/json">[{"storyHeadline":1,"storyPath":2,"storyPostdate":3},"Head '), name, F.lit('","/news/'), key,
        F.lit('","2024-01-02T00:00:00Z",{"title":1,"published_at":3,"permalink":2,"visibility":5},"public",{"title":1,"published_at":3,"permalink":2,"visibility":1},'
              '{"sub_headline":1,"url":2,"sport":1,"app_exclusive":8},true]</script>'),
    )
    classic = F.concat(F.lit('<script>var obj = {"type":"stories","data":[{"title":"A } '), name, F.lit('","url":"/a/'), key, F.lit('","date":"1/2/2024","sport":{"title":"Golf"}}]};</script>'))
    return F.concat(classic, graph)


@query(
    """SELECT c_custkey, unnest(['classic', 'graph-story', 'graph-post', 'graph-card']) AS extractor, unnest(['A } ' || c_name, 'Head ' || c_name, 'Head ' || c_name, 'Head ' || c_name]) AS title,
        unnest(['/a/' || c_custkey, '/news/' || c_custkey, '/news/' || c_custkey, '/news/' || c_custkey]) AS path, unnest([FALSE, FALSE, FALSE, TRUE]) AS excluded FROM customer""",
    "P5 P6 P7 F7 K21",
)
def official_stories(t: Tables) -> DataFrame:
    pages = spread(t.customer, "c_custkey").select("c_custkey", _official_page(F.col("c_name"), F.col("c_custkey").cast("string")).alias("text"))
    return parsers.parse(pages, parsers.official_stories, parsers.STORY_ROW, ["c_custkey"]).select("c_custkey", "extractor", "title", "path", "excluded")


@query(
    """SELECT c_custkey, unnest(CASE WHEN c_custkey % 2 = 0 THEN ['feed'] ELSE ['presto', 'visual', 'wordpress'] END) AS extractor,
        unnest(CASE WHEN c_custkey % 2 = 0 THEN ['Item ' || c_name] ELSE ['Card ' || c_name, 'Two', 'Three'] END) AS title,
        unnest(CASE WHEN c_custkey % 2 = 0 THEN ['https://x.org/1'] ELSE ['/sports/golf/releases/1', '/news/2', '/n/3'] END) AS path,
        unnest(CASE WHEN c_custkey % 2 = 0 THEN ['Golf'] ELSE ['Golf', 'Soccer', 'Wrestling'] END) AS category FROM customer""",
    "P8 P9 P10 P11 U3",
)
def official_cards(t: Tables) -> DataFrame:
    """A feed, or a page with a card of each theme."""
    item = F.concat(F.lit('<rss version="2.0"><channel><title>F</title><item><title>Item '), F.col("c_name"), F.lit("</title><link>https://x.org/1</link><category>Golf</category></item></channel></rss>"))
    page = F.concat(
        F.lit('<div class="card"><img src="/i.png" alt="A"><h5 class="entry-title"><a href="/sports/golf/releases/1">Card '), F.col("c_name"),
        F.lit('</a></h5><span class="date">1/2/2026</span><span class="entry-category">Golf</span></div><li class="sidearm-news-list-item">'
              '<div class="sidearm-news-list-item-title"><a href="/news/2">Two</a></div><time datetime="2026-01-03">x</time><span data-sport="Soccer"></span></li>'
              '<section class="hero"><div class="hero-text"><div class="hero__top-info"><a>Wrestling</a><time>Jan 4, 2026</time></div><h1><a href="/n/3">Three</a></h1></div></section>'),
    )
    pages = spread(t.customer, "c_custkey").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, item).otherwise(page).alias("text"))
    return parsers.parse(pages, cards.official_page, parsers.STORY_ROW, ["c_custkey"]).select("c_custkey", "extractor", "title", "path", "category")


_CASES = {
    # title, url, labels, primary labels, excluded, what becomes of it
    "title": ["One", "One", "Two", "Three", "Four", None, "Six", "Seven"],
    "url": ["https://a.edu/news/1", "https://a.edu/news/1", "https://a.edu/sports/mens-golf/2", "https://b.org/3", "https://a.edu/news/4", "https://a.edu/news/5", "https://a.edu/news/6", "https://a.edu/"],
    "labels": [["Men's Golf"], ["Men's Golf"], [], ["Men's Golf"], ["Men's Golf"], ["Men's Golf"], ["Soccer"], ["Men's Golf"]],
    "primary": [[], [], [], [], ["Women's Golf"], [], [], []],
}


@query(
    """WITH k AS (SELECT p_partkey, p_partkey % 8 AS c FROM part WHERE p_partkey % 8 < 3), r AS (SELECT *, p_partkey // 8 AS page FROM k)
    SELECT page, CASE WHEN c < 2 THEN 'https://a.edu/news/1' ELSE 'https://a.edu/sports/mens-golf/2' END AS url, CASE WHEN max(c) < 2 THEN 'One' ELSE 'Two' END AS title,
        CASE WHEN bool_or(c = 0) AND max(c) < 2 THEN 'https://i.org/0.jpg' END AS image_url FROM r GROUP BY page, url""",
    "P4 A7 K20",
)
def official_records(t: Tables) -> DataFrame:
    """Stories of a page of eight for a golf program: scope by label or route, other hosts and exclusions out, merged by address."""
    k = F.col("p_partkey")
    stories = t.part.select(
        F.floor(k / 8).cast("bigint").alias("page"), k.alias("pos"), F.lit("graph-story").alias("extractor"), pick(k, _CASES["title"], "string").alias("title"),
        pick(k, _CASES["url"], "string").alias("url"), F.lit(None).cast("timestamp").alias("published_at"), F.lit("unknown").alias("published_at_precision"),
        F.when(k % 8 == 0, "https://i.org/0.jpg").alias("image_url"), F.lit(None).cast("string").alias("image_alt"), F.lit(None).cast("string").alias("author"),
        pick(k, _CASES["labels"], "array<string>").alias("labels"), pick(k, _CASES["primary"], "array<string>").alias("primary_labels"), F.lit(False).alias("excluded"),
    )
    programs = stories.select("page").distinct().select(
        "page", F.lit("https://a.edu/").alias("source_url"), F.array(F.lit("a.edu")).alias("hosts"), F.lit("mens").alias("expected"), F.lit("mens-golf").alias("slug"),
        F.array(F.lit("mens golf")).alias("aliases"), F.array(F.lit("mens-golf")).alias("routes"),
    )
    return official.official_records(stories, programs, ["page"]).select("page", "url", "title", "image_url")


@query(
    """SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN NULLIF(event_type, 'error') END, m.published) AS published, m.author
    FROM events LEFT JOIN (SELECT user_id, arg_max(event_type, event_id) AS title, arg_max('day ' || event_id, event_id) AS published, arg_max('by ' || event_id, event_id) AS author
        FROM events GROUP BY user_id) m ON events.user_id = m.user_id AND events.event_type = m.title""",
    "K19",
)
def cards_with_metadata(t: Tables) -> DataFrame:
    """Cards that say little, with what the story object of the same address and title says."""
    e = t.events
    none = F.lit(None).cast("string")
    told = F.when(F.col("event_id") % 3 == 0, F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")))
    rows = e.select("event_id", F.lit(1).alias("page"), F.col("user_id").alias("url"), F.col("event_type").alias("title"), told.alias("published"), none.alias("image_url"), none.alias("image_alt"), none.alias("author"))
    id_ = F.col("event_id").cast("string")
    metadata = e.select(
        F.lit(1).alias("page"), F.col("user_id").alias("url"), F.col("event_type").alias("title"), F.concat(F.lit("day "), id_).alias("published"), none.alias("image_url"),
        none.alias("image_alt"), F.concat(F.lit("by "), id_).alias("author"), F.col("event_id").alias("pos"),
    )
    return official.filled_from_metadata(rows, metadata, ["page"]).select("event_id", "published", "author")


@query("SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.event_type = e.event_type AND x.value > 150)", "K20 F7")
def records_without_excluded(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", F.col("event_type").alias("url"))
    excluded = t.events.where("value > 150").select("user_id", F.col("event_type").alias("url"))
    return official.without_excluded(rows, excluded, ["user_id", "url"]).select("event_id")


@query(
    """WITH n AS (SELECT user_id, count(*) AS c, count(DISTINCT event_type) AS n_records FROM events GROUP BY user_id)
    SELECT user_id, n_records, CASE WHEN c > 12 THEN 'record-budget-exceeded' END AS error_code FROM n
    UNION ALL SELECT -1 - c_custkey, 0, CASE WHEN c_custkey % 2 = 1 THEN 'source-format-changed' END FROM customer""",
    "F21 R14",
)
def record_budgets(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.col("event_type").alias("id"), F.lit(False).alias("empty_confirmed"))
    none = t.customer.select((-1 - F.col("c_custkey")).alias("user_id"), F.lit(None).cast("string").alias("id"), (F.col("c_custkey") % 2 == 0).alias("empty_confirmed"))
    return official.within_records(rows.unionByName(none), ["user_id"], 12)


_KINDS = [(1, "football", "Football", "men"), (2, "womens-flag-football", "Women's Flag Football", "women"), (3, "mens-lightweight-football", "Men's Lightweight Football", "men"), (4, "mens-golf", "Men's Golf", "men")]


def _dims(t: Tables) -> tuple[DataFrame, DataFrame]:
    schools = t.nation.select(F.col("n_nationkey").alias("school"))
    kinds = F.array(*(F.struct(F.lit(i).alias("program_id"), F.lit(s).alias("slug"), F.lit(n).alias("name"), F.lit(g).alias("gender")) for i, s, n, g in _KINDS))
    p = schools.select("school", F.inline(kinds)).withColumn("program_id", F.col("school") * 10 + F.col("program_id")).withColumn("code", F.col("slug"))
    aliases = sports.alias_rows(p)
    base = sports.base_sport(F.col("name"), F.col("slug"))
    told = p.select("program_id", "school", "slug", base.alias("base"), sports.sport_family(base).alias("family"), sports.sport_gender(F.col("gender"), F.col("name"), F.col("slug")).alias("gender"))
    return told, aliases


@query(
    """SELECT n_nationkey AS school, n_nationkey * 10 + p AS program_id, label FROM nation, (VALUES ('Football', 2), ('Football', 3), ('Women''s Flag Football', 1), ('Women''s Flag Football', 3)) v(label, p)""",
    "F8 T20 T21 T22",
)
def family_conflicts(t: Tables) -> DataFrame:
    """Primary labels that name another kind of football than the program's."""
    programs, aliases = _dims(t)
    labels = programs.select("school").distinct().select("school", F.explode(F.array(F.lit("Football"), F.lit("Women's Flag Football"), F.lit("Men's Golf"))).alias("label"))
    return official.primary_family_conflicts(labels, programs, aliases)


@query("SELECT n_nationkey AS school, n_nationkey * 10 + p AS program_id, label FROM nation, (VALUES ('MGOLF (Men''s Golf)', 4), ('FB', 1), ('Football', 1), ('Mens Golf', 4)) v(label, p)", "T20 T21 T22")
def label_programs(t: Tables) -> DataFrame:
    """Programs that labels of menus name."""
    programs, aliases = _dims(t)
    labels = programs.select("school").distinct().select("school", F.explode(F.array(*map(F.lit, ("MGOLF (Men's Golf)", "FB", "Football", "Mens Golf", "Tickets")))).alias("label"))
    found = sports.match_labels(labels, aliases.join(programs.select("program_id", F.col("school").alias("of")), "program_id"))
    return found.where("school = of").select("school", "program_id", "label")


_NAV = '<ul><li>Men<ul><li><a href="/sports/mens-golf">Golf</a></li><li><a href="/sports/mens-golf/roster">Roster</a></li></ul></li></ul><a href="/sports/football/archives">Football</a><a href="/map.pdf">Map</a><a href="https://y.org/">Off</a>'


@query(
    """SELECT n_nationkey AS school, n_nationkey * 10 + p AS program_id, home_url, news_url, roster_url FROM nation,
        (VALUES (4, 'https://a.edu/sports/mens-golf', NULL, 'https://a.edu/deeper'), (1, NULL, 'https://a.edu/sports/football/archives', NULL)) v(p, home_url, news_url, roster_url)""",
    "P25 P27 K16 W10 F14 R20",
)
def school_sources(t: Tables) -> DataFrame:
    """Navigation to the sources of each program, and the deeper page that overrides one."""
    programs, aliases = _dims(t)
    pages = t.nation.select(F.col("n_nationkey").alias("school"), F.lit("https://a.edu/").alias("url"), F.lit(_NAV).alias("text"))
    links = parsers.parse(pages.withColumnRenamed("url", "page"), _links_of_page, parsers.LINK_ROW, ["school", "page"]).where("pos >= 0")
    matched = discovery.sport_links(links.select("school", "pos", "label", "section", "url"), programs, aliases)
    deeper = programs.where("slug = 'mens-golf'").select("school", "program_id", F.lit(0).alias("pos"), F.lit("roster").alias("kind"), F.lit("https://a.edu/deeper").alias("url"))
    return discovery.enriched_sources(discovery.program_sources(matched), deeper).select("school", "program_id", "home_url", "news_url", "roster_url")


def _links_of_page(page: str, context: dict):
    return parsers.links(page, {"url": context["page"]})


@query("SELECT user_id, min(event_type) AS archive_url FROM events WHERE value > 180 GROUP BY user_id HAVING count(DISTINCT event_type) = 1", "P23")
def declared_archives(t: Tables) -> DataFrame:
    return discovery.declared_archive(t.events.where("value > 180").select("user_id", F.col("event_type").alias("url")), ["user_id"])


@query(
    """WITH s AS (SELECT user_id, event_type, count(*) FILTER (value > 30) AS n, min(event_id) AS first, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS step
        FROM events GROUP BY ALL), g AS (SELECT user_id, min(step) FILTER (n > 3 AND step <> 1) AS step FROM s GROUP BY user_id)
    SELECT g.user_id, coalesce(g.step, 0) AS step, CASE WHEN g.step IS NULL THEN 'source-format-changed' END AS error_code FROM g
    WHERE g.step IS NOT NULL OR EXISTS (SELECT 1 FROM s WHERE s.user_id = g.user_id)""",
    "P22 W10",
)
def followed_sources(t: Tables) -> DataFrame:
    """The first page of a fallback chain that has records."""
    step = F.expr("CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END")
    rows = t.events.groupBy("user_id", "event_type").agg(F.count_if(F.col("value") > 30).alias("n"))
    rows = rows.select("user_id", step.alias("step"), F.col("event_type").alias("url"), F.when(F.col("n") > 3, F.col("n")).otherwise(0).alias("n_records"), F.when(step == 1, "source-format-changed").alias("error_code"))
    return official.followed(rows, ["user_id"]).select("user_id", "step", "error_code")


_STORY = "'https://c.org/news/2026/1/2/s' || (event_id // 2) || '.aspx'"


@query(
    f"""WITH s AS (SELECT event_id // 2 AS story, bool_or(event_id % 2 = 1) AS filtered, min(event_id) FILTER (event_id % 2 = 0) AS e0, min(event_id) AS e1 FROM events GROUP BY 1),
    k AS (SELECT story, coalesce(e0, e1) AS e, filtered FROM s), d AS (SELECT k.*, user_id, value FROM k JOIN events ON event_id = e),
    c AS (SELECT *, story % 4 = 0 AS in_title, story % 4 = 1 AND (filtered OR story % 8 = 1) AS asked FROM d WHERE story % 5 <> 0),
    r AS (SELECT *, CASE WHEN asked THEN row_number() OVER (PARTITION BY user_id, asked ORDER BY story DESC) END AS place FROM c)
    SELECT user_id, 'https://c.org/news/2026/1/2/s' || story || '.aspx' AS url, CASE WHEN in_title THEN 'title' ELSE 'body' END AS confirmed_by
    FROM r WHERE in_title OR (place <= 3 AND story % 3 = 0)""",
    "P21 W5 O7 U2 F11 F12 R18",
)
def conference_news(t: Tables) -> DataFrame:
    """Stories of a conference's two lists that are the school's, by title or by one of the bodies that may be asked for."""
    e = t.events.withColumn("story", F.floor(F.col("event_id") / 2).cast("bigint"))
    s = F.col("story")
    first = e.groupBy("story").agg(F.min_by("user_id", F.struct(F.col("event_id") % 2, "event_id")).alias("u"))
    e = e.join(first, "story")
    stories = e.select(
        F.col("u").alias("user_id"), F.concat(F.lit("https://c.org/news/2026/1/2/s"), s.cast("string"), F.lit(".aspx")).alias("url"),
        F.when(s % 4 == 0, "Central wins").otherwise("Team wins").alias("title"), F.when(s % 5 == 0, "Golf").otherwise("Football, General").alias("categories"),
        F.when(s % 8 == 1, "of Central").otherwise("summary").alias("summary"), F.timestamp_seconds(s).alias("published_at"), (F.col("event_id") % 2 == 1).alias("filtered"),
        F.lit("Football").alias("expected"), F.lit("c.org").alias("host"), F.lit(r"(?i)\bCentral\b").alias("school_name"),
    )
    stories = stories.where((s % 4).isin(0, 1))
    bodies = stories.select("user_id", "url").distinct().withColumn("n", F.regexp_extract("url", r"/s(\d+)\.", 1).cast("bigint"))
    bodies = bodies.select("user_id", "url", F.when(F.col("n") % 3 == 0, "A day for Central.").otherwise("Nothing.").alias("text"))
    return official.confirmed_conference_news(stories, bodies, ["user_id"], 3).select("user_id", "url", "confirmed_by")


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN 'https://conf.org/' || c_nationkey ELSE 'https://a.edu/' || c_custkey END AS url, c_nationkey % 5 = 0 AS replaced FROM customer""",
    "K26",
)
def conference_replacements(t: Tables) -> DataFrame:
    """Official sources, those of reviewed conferences replaced."""
    rows = t.customer.select("c_custkey", F.col("c_nationkey").alias("conference"), F.concat(F.lit("https://a.edu/"), F.col("c_custkey").cast("string")).alias("url"))
    reviewed = t.nation.where("n_nationkey % 5 = 0").select(F.col("n_nationkey").alias("conference"), F.concat(F.lit("https://conf.org/"), F.col("n_nationkey").cast("string")).alias("url"))
    return joins.replaced(rows, reviewed, ["conference"], ["url"]).select("c_custkey", "url", "replaced")


@query("""SELECT c_custkey, 'Golf,mgolf' AS labels FROM customer WHERE c_custkey % 3 = 0""", "T46 R11")
def declared_news_sports(t: Tables) -> DataFrame:
    """Sport objects whose own route is the page's, with the labels that they declare."""
    sport = F.when(F.col("c_custkey") % 3 == 0, F.create_map(*map(F.lit, ("title", "Golf", "shortname", "mgolf", "other", "x")))).otherwise(F.create_map(*map(F.lit, ("title", "Tennis", "shortname", "mten"))))
    found = official.declared_aliases(t.customer.select("c_custkey", sport.alias("sport")), F.lit("mgolf"))
    return found.select("c_custkey", F.array_join("labels", ",").alias("labels"))
