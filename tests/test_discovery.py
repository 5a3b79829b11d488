import json

from pyspark.sql import functions as F

from tidewire.functions import sports
from tidewire.operators import discovery, providers
from tidewire.sources import cards

SPORTS = [
    (1, "mens-indoor-track", "Men's Indoor Track", "men"), (2, "mens-outdoor-track", "Men's Outdoor Track", "men"), (3, "womens-cross-country", "Women's Cross Country", "women"),
    (4, "coed-sailing", "Coed Sailing", "coed"), (5, "womens-sailing", "Women's Sailing", "women"), (6, "mens-soccer", "Men's Soccer", "men"),
    (7, "womens-soccer", "Women's Soccer", "women"), (8, "wrestling", "Wrestling", "men"), (9, "mens-swimming", "Men's Swimming", "men"), (10, "womens-swimming", "Women's Swimming", "women"),
]


def dims(spark):
    p = spark.createDataFrame([(i, "s", slug, name, slug, g) for i, slug, name, g in SPORTS], "program_id int, school string, slug string, name string, code string, gender string")
    aliases = sports.alias_rows(p).cache()
    base = sports.base_sport(F.col("name"), F.col("slug"))
    told = p.select("program_id", "school", "slug", base.alias("base"), sports.sport_family(base).alias("family"), sports.sport_gender(F.col("gender"), F.col("name"), F.col("slug")).alias("gender"))
    return told, aliases


def test_navigation_labels(spark):
    programs, aliases = dims(spark)
    want = {
        "Track & Field (I)": {1}, "Track and Field - Outdoor": {2}, "Women's Track & Field (I)": set(), "Golf (I)": set(), "Sailing Open": {4}, "Sailing (Coed)": {4},
        "Men's & Women's Sailing": {4, 5}, "Cross Country/Track": {1, 2, 3}, "Women's Cross Country/Track": {3}, "Track": {1, 2}, "Soccer": set(), "Men's Soccer": {6},
        "Wrestling": {8}, "Swim & Dive": {9, 10}, "Outdoor Track & Field": {2}, "M & W Swimming": {9, 10}, "Tickets": set(),
    }
    labels = spark.createDataFrame([("s", label) for label in want], "school string, label string")
    got = {label: set() for label in want}
    for r in discovery.navigation_matches(labels, programs, aliases).collect():
        got[r.label].add(r.program_id)
    assert got == want


def test_links_to_sources(spark):
    programs, aliases = dims(spark)
    links = spark.createDataFrame(
        [("s", 0, "Roster", "Men's Soccer", "https://x.org/sports/mens-soccer/roster"), ("s", 1, "Schedule", "Men's Soccer", "https://x.org/sports/mens-soccer/schedule"),
         ("s", 2, "Wrestling", None, "https://x.org/sports/wrestling"), ("s", 3, "News", "Wrestling", "https://x.org/w/news"), ("s", 4, "Tickets", None, "https://x.org/tickets")],
        "school string, pos int, label string, section string, url string")
    matched = discovery.sport_links(links, programs, aliases)
    got = {r.program_id: r for r in discovery.program_sources(matched).collect()}
    assert set(got) == {6, 8}
    assert (got[6].roster_url, got[6].schedule_url) == ("https://x.org/sports/mens-soccer/roster", "https://x.org/sports/mens-soccer/schedule")
    assert (got[8].home_url, got[8].news_url) == ("https://x.org/sports/wrestling", "https://x.org/w/news")
    deeper = spark.createDataFrame([("s", 8, 0, "roster", "https://x.org/r1"), ("s", 8, 1, "roster", "https://x.org/r2")], "school string, program_id int, pos int, kind string, url string")
    assert {r.program_id: r.roster_url for r in discovery.enriched_sources(discovery.program_sources(matched), deeper).collect()}[8] == "https://x.org/r2"


def test_import(spark):
    df = spark.createDataFrame([("The Big East Conference",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(discovery.conference_key(F.col("v"))).collect()] == ["big-east", None, None]
    df = spark.createDataFrame([("Men's Basketball", "MBB"), ("Mixed Skiing", "XSK")], "n string, c string")
    assert [r[0] for r in df.select(discovery.sport_key(F.col("n"), F.col("c"))).collect()] == ["basketball", "coed-skiing"]
    rows = spark.createDataFrame([("a", "outgoing", "u", ["x"]), ("b", None, None, []), ("c", None, None, ["x"])], "slug string, reclassifying string, athleticsUrl string, sports array<string>")
    kept, out = discovery.split_members(rows)
    assert [r.slug for r in kept.collect()] == ["c"] and {r.slug: r.reason for r in out.collect()} == {"a": "outgoing-reclassification", "b": "no-url-and-no-sports"}


def test_cards():
    presto = '<div class="card"><img src="/i.png" alt="A"><h5 class="entry-title"><a href="/sports/golf/releases/1">Golf  wins</a></h5><span class="date">1/2/2026</span><span class="entry-category">Golf</span></div>'
    visual = '<li class="sidearm-news-list-item"><div class="sidearm-news-list-item-title"><a href="/news/2">Two</a></div><time datetime="2026-01-03">x</time><span data-sport="Soccer"></span><img data-src="/l.png" src="/s.png"></li>'
    hero = '<section class="hero"><div class="hero__background" data-bg="/h.jpg"></div><div class="hero-text"><div class="hero__top-info"><a>Wrestling</a><time>Jan 4, 2026</time></div><h1><a href="/n/3">Three</a></h1></div></section>'
    other = '<div class="card"><h5 class="entry-title"><a href="/about">No route</a></h5></div><section class="hero"><div class="hero-text"><h1>no link</h1></div></section>'
    got = list(cards.story_cards(presto + visual + hero + other, {}))
    assert [(s["extractor"], s["title"], s["path"], s["published"], s["image_url"], s["category"]) for s in got] == [
        ("presto", "Golf wins", "/sports/golf/releases/1", "1/2/2026", "/i.png", "Golf"), ("visual", "Two", "/news/2", "2026-01-03", "/l.png", "Soccer"),
        ("wordpress", "Three", "/n/3", "Jan 4, 2026", "/h.jpg", "Wrestling"),
    ]
    assert [s["extractor"] for s in cards.official_page('<rss version="2.0"><channel><title>F</title><item><title>T</title><link>https://x.org/1</link></item></channel></rss>', {})] == ["feed"]


def league(path, league_id, *teams):
    sport, name = path.split("/")
    listed = [{"team": dict(zip(("id", "location", "displayName"), t, strict=True))} for t in teams]
    return json.dumps({"sports": [{"slug": sport, "leagues": [{"slug": name, "id": league_id, "name": "L", "teams": listed}]}]})


def test_import_of_a_provider(spark):
    football = "football/college-football"
    state, tbd = ("1", "State", "State U"), ("-2", "TBD", "TBD TBD")
    inventories = [
        ("football", league(football, "9", state, state, tbd, ("2", "College of Tech", "T")), None), ("baseball", league(football, "9", state), None),
        ("softball", league("baseball/college-softball", "x", state), None), ("field-hockey", league("field-hockey/womens-college-field-hockey", "1", ("a", "B", "C")), None),
        ("basketball", None, "http-503"), ("womens-soccer", league("soccer/usa.ncaa.w.1", "1"), None), ("mens-soccer", "{broken", None),
        ("womens-lacrosse", league("lacrosse/womens-college-lacrosse", "1", *[(str(i), f"L{i}", "D") for i in range(1001)]), None),
        ("mens-lacrosse", league("lacrosse/mens-college-lacrosse", "1", ("1", "", "D")), None),
    ]
    programs = [("s", "State University", "football"), ("t", "Tech", "football"), ("u", "Unknown", "football"), ("s", "State University", "baseball"), ("s", "State University", "rowing")]
    news = [("football", json.dumps({"header": "H", "link": {"href": "https://www.espn.com/x"}, "articles": []}))]
    leagues, mappings = providers.import_providers(
        spark.createDataFrame(programs, "school string, name string, sport string"), spark.createDataFrame([], "school string, alias string"),
        spark.createDataFrame(inventories, "sport string, text string, error_code string"), spark.createDataFrame(news, "sport string, text string"),
    )
    told = {r.sport: r for r in leagues.collect()}
    wrong = "inventory-identity-or-size-mismatch"
    assert {s: r.reason for s, r in told.items()} == {
        "football": None, "baseball": wrong, "softball": wrong, "field-hockey": "invalid-team-inventory", "basketball": "http-503", "womens-soccer": None, "mens-soccer": wrong,
        "womens-lacrosse": wrong, "mens-lacrosse": "invalid-team-inventory",
    }
    f = told["football"]
    assert (f.status, f.team_count, f.placeholders, f.duplicates, f.news_header, told["womens-soccer"].status) == ("verified", 2, 1, 1, "H", "empty-inventory")
    assert {(r.school, r.sport): (r.team_id, r.reason) for r in mappings.collect()} == {
        ("s", "football"): ("1", None), ("t", "football"): ("2", None), ("u", "football"): (None, "no-exact-or-reviewed-alias-match"), ("s", "baseball"): (None, wrong),
        ("s", "rowing"): (None, "no-verified-league-inventory"),
    }


def test_sitemaps_are_followed(spark):
    xml = lambda *locs: "<urlset>" + "".join(f"<url><loc>{u}</loc></url>" for u in locs) + "</urlset>"
    a = "https://a.edu"
    sites = [
        (1, f"Sitemap: https://b.org/s.xml\nSITEMAP: {a}/s.xml"), (2, f"Sitemap: {a}/index.xml"), (3, f"Sitemap: {a}/none.xml"), (4, "User-agent: *"), (5, None),
        (6, f"Sitemap: {a}/late.xml"), (7, "x" * 100_000 + f"\nSitemap: {a}/s.xml"), (8, f"Sitemap: {a}/broken.xml"),
    ]
    landed = [
        (f"{a}/s.xml", xml("https://b.org/sports/golf/roster", f"{a}/sports/Golf-1/roster.pdf", f"{a}/sport/golf/roster?x=1", f"{a}/sports/golf/schedule")),
        (f"{a}/index.xml", xml(f"{a}/sports/golf/roster", f"{a}/sitemap_roster_1.xml")), (f"{a}/sitemap_roster_1.xml", xml(f"{a}/sports/rowing/roster/2")),
        (f"{a}/sports/rowing/roster/2", "page"), (f"{a}/late.xml", xml(*[f"{a}/x{i}" for i in range(1000)], f"{a}/sitemap_roster_1.xml", f"{a}/sports/golf/roster")), (f"{a}/broken.xml", "<urlset"),
    ]
    df = spark.createDataFrame(sites, "k int, robots string").withColumn("hosts", F.array(F.lit("a.edu")))
    got = {r.k: (r.child_url, r.page_url, r.page) for r in discovery.followed_sitemaps(df, spark.createDataFrame(landed, "url string, text string"), ["k"]).collect()}
    assert got == {
        1: (None, f"{a}/sport/golf/roster?x=1", None), 2: (f"{a}/sitemap_roster_1.xml", f"{a}/sports/rowing/roster/2", "page"), 6: (None, f"{a}/sports/golf/roster", None),
        **{i: (None, None, None) for i in (3, 4, 5, 7, 8)},
    }
