import datetime as dt
import gzip
import json
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.operators import enrich
from tidewire.sources import catalog, documents, parsers

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:media="http://search.yahoo.com/mrss/"><channel><title>Feed</title>
<item><title>One &amp; only</title><link>https://x.org/a/1</link><pubDate>Wed, 16 Sep 2026 12:00:00 GMT</pubDate><category>Golf</category>
<media:content url="https://bad.org/i.jpg"/><description><![CDATA[<p>text <img src="https://img.org/j.jpg" alt="j"></p>]]></description></item>
<item><title>Other host</title><link>https://y.org/a/2</link></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>Feed</title><entry><title>Two</title><link rel="alternate" href="https://x.org/a/3"/>
<published>2026-09-16T12:00:00Z</published><author><name>W</name></author></entry></feed>"""


def feed(spark, *texts, **context):
    told = {"feed_title": "Feed", "article_host": "x.org", "article_path": "/a/", "image_hosts": ["img.org"], "article_hosts": None, "feed_url": None} | context
    schema = "id int, text string, feed_title string, article_host string, article_path string, image_hosts array<string>, article_hosts array<string>, feed_url string"
    df = spark.createDataFrame([(i, t, *told.values()) for i, t in enumerate(texts)], schema)
    return parsers.parse(df, parsers.feed, parsers.FEED_ROW, ["id", *told]).collect()


def test_feeds(spark):
    rss, atom, doctype, broken, none, other = feed(spark, RSS, ATOM, "<!DOCTYPE rss>" + RSS, "<rss", None, RSS.replace(">Feed<", ">Else<"))
    assert (rss.title, rss.url, rss.image_url, rss.image_alt, rss.categories) == ("One & only", "https://x.org/a/1", "https://img.org/j.jpg", "j", ["Golf"])
    assert (atom.url, atom.published, atom.author) == ("https://x.org/a/3", "2026-09-16T12:00:00Z", "W")
    assert [doctype.error_code, broken.error_code, other.error_code] == ["source-format-changed"] * 3
    assert (none.error_code, none.pos) == ("empty-response", -1)
    changed = [
        RSS.replace("<title>Other host</title>", ""), RSS.replace("<title>Other", "<title>a</title><title>Other"), RSS.replace("<link>https://y.org/a/2</link>", ""),
        RSS.replace("</channel>", "</channel><channel><title>Feed</title></channel>"), RSS.replace("<title>Feed</title>", ""), RSS.replace('"2.0"', '"0.9"'),
        ATOM.replace("<published>", '<link href="https://x.org/a/4"/><published>'), ATOM.replace('rel="alternate"', 'rel="self"'), ATOM.replace("/2005/Atom", "/2006/Atom"), " ",
        RSS.replace("<item>", "<item><title>t</title><link>https://x.org/a/9</link></item>" * 200 + "<item>", 1),
    ]
    assert [r.error_code for r in feed(spark, *changed)] == ["source-format-changed"] * len(changed)
    (updated,) = feed(spark, ATOM.replace("published>", "updated>"))
    assert updated.published is None
    both = feed(spark, RSS.replace("y.org/a/2", "y.org/news/golf/2").replace("x.org/a/1", "x.org/news/golf/1"), article_hosts=["x.org", "y.org"], article_path="/news/", feed_url="https://www.ncaa.com/news/golf/d1/rss.xml")
    assert [r.url for r in both] == ["https://x.org/news/golf/1", "https://y.org/news/golf/2"]
    (off,) = feed(spark, RSS.replace("/a/", "/news/tennis/"), article_path="/news/", feed_url="https://www.ncaa.com/news/golf/d1/rss.xml")
    assert (off.error_code, off.pos) == (None, -1)
    (empty,) = feed(spark, RSS, article_host="z.org")
    assert (empty.error_code, empty.pos) == (None, -1)


def graph(*nodes):
    return f'<script id="__NUXT_DATA__" type="application/json">{json.dumps(nodes)}</script>'


def page(parser, text, row=None):
    return list(parser(text, {"url": "https://x.org/"}))


def test_official_pages():
    classic = 'var obj = {"type":"stories","data":[{"title":"A } b","url":"/a","date":"1/2/2026","sport":{"title":"Golf"}}]};'
    (a,) = page(parsers.official_stories, f"<script>{classic}</script>")
    assert (a["extractor"], a["title"], a["path"], a["sport"]) == ("classic", "A } b", "/a", "Golf")
    text = graph({"storyHeadline": 1, "storyPath": 2}, "Head", "/p", {"title": 1, "published_at": 4, "permalink": 2, "visibility": 5}, "2026-01-01", "public",
                 {"title": 1, "published_at": 4, "permalink": 2, "visibility": 1}, {"sub_headline": 1, "url": 2, "sport": 1, "app_exclusive": 8}, True)
    assert [(s["extractor"], s["excluded"]) for s in page(parsers.official_stories, text)] == [("graph-story", False), ("graph-post", False), ("graph-card", True)]


def test_links_and_entrance():
    text = '<ul><li>Men<ul><li><a href="/sports/golf">Golf</a></li><li><a href="/x.pdf">File</a></li></ul></li></ul><a href="https://y.org/">Off</a><a href="#top">Top</a>'
    assert page(parsers.links, text) == [{"label": "Golf", "url": "https://x.org/sports/golf", "section": "Men"}]
    way_in = '<a href="/b">Other</a><a href="/index.aspx#top">Continue to Site</a>'
    assert [x["url"] for x in page(parsers.entrance, way_in)] == ["https://x.org/index.aspx"]
    assert page(parsers.entrance, way_in + '<a href="https://y.org/">y</a>' * 14) == []  # links of any kind count
    for label, path in (("Continue to the site", "/"), ("Enter", "/"), ("Enter Website now", "/"), ("enter site", "/main"), ("enter site", "https://y.org/")):
        assert page(parsers.entrance, f'<a href="{path}">{label}</a>') == []
    assert [x["url"] for x in page(parsers.entrance, '<a href="https://www.x.org">ENTER  website</a>')] == ["https://www.x.org"]
    assert [x["loc"] for x in page(parsers.robots_sitemap, "User-agent: *\nSitemap: https://x.org/s.xml\n")] == ["https://x.org/s.xml"]
    assert [x["loc"] for x in page(parsers.sitemap, "<urlset xmlns='u'><url><loc> https://x.org/1 </loc></url></urlset>")] == ["https://x.org/1"]
    assert [x["cells"] for x in page(parsers.table_rows, "<table><tr><th>A<th>B</th></tr><tr><td> 1 </td><td>2</td></tr></table>")][-1] == ["1", "2"]
    heads = page(parsers.sections, "<h2>Commits (2)</h2><ul><li><a href='/player/x-1'>X</a></li></ul>")
    assert [(h["kind"], h["text"], h["declared"]) for h in heads] == [("heading", "Commits (2)", "2"), ("row", "X", None)]


def ld(*nodes):
    return f'<script type="application/ld+json">{json.dumps(nodes[0] if len(nodes) == 1 else list(nodes))}</script>'


def confirmed(spark, *pages, title="The H", url="https://www.x.org/a/1?utm_source=z", hosts=("x.org",)):
    df = spark.createDataFrame([(i, p, url, title, list(hosts)) for i, p in enumerate(pages)], "k int, text string, url string, title string, hosts array<string>")
    told = parsers.parse(df, parsers.article_metadata, parsers.META_ROW, ["k", "url", "title", "hosts"])
    return [tuple(r)[2:] for r in enrich.confirmed_metadata(told, ["k"]).orderBy("k").collect()]


def test_article_metadata(spark):
    h1, mine = "<h1>the &ldquo;H&rdquo;</h1>", {"@type": "NewsArticle", "headline": "THE H", "url": "/a/1", "author": {"@type": "Person", "name": "By Ann"}, "image": ["/i.jpg"]}
    other = {"@type": "Article", "headline": "Another", "author": "Wrong", "image": "/wrong.jpg"}
    got = confirmed(
        spark, h1 + ld(other, mine), h1 + ld(mine | {"url": "https://x.org/a/2"}, {"@type": "BlogPosting", "author": [{"@type": "Person", "name": "B"}, "C", "B", {"@type": "Thing", "name": "T"}]}),
        h1 + ld({"@graph": [{"@type": "Thing", "author": "T"}, mine | {"author": None}, mine | {"author": "Late", "image": "/late.jpg"}]}),
        h1 + "<script type='application/ld+json'>{broken</script>" + ld(*[mine] * 101) + '<meta name="author" content="By: M"><div class="story-byline">By N</div>',
        h1 + '<div class="sidearm-story-image"><img src="/s.jpg" alt="shot"></div><div class="story-byline">By N</div>',
        h1 + '<article><div class="entry-content"><figure><img data-src="/f.jpg" src="/g.jpg"></figure></div></article>',
    )
    assert got == [
        (None, "https://www.x.org/i.jpg", None, "Ann"), (None, None, None, "B, C"), (None, "https://www.x.org/i.jpg", None, "Late"), (None, None, None, "M"),
        (None, "https://www.x.org/s.jpg", "shot", "N"), (None, "https://www.x.org/f.jpg", None, None),
    ]


def test_whose_page_it_is(spark):
    own, og = '<link rel="canonical" href="/a/1/">', '<meta property="og:url" content="https://x.org/a/1">'
    pages = [
        "<h1>The H</h1>" + own + og, "<h1>The H</h1>" + own + og.replace("/1", "/2"), "<h1>The H</h1>" + og.replace("/1", "/2"), "<h1>Else</h1>" + own,
        "<h1>Else</h1>" + own + '<meta property="og:type" content="article">', '<h1>Else</h1><meta property="og:type" content="article">', '<meta property="og:title" content="the h">',
        '<div class="story-page__content__title-box"><h2>The H</h2></div>', "<h2>The H</h2>", "",
    ]
    mismatch, open_ = "article-identity-mismatch", "article-identity-not-confirmed"
    assert [r[0] for r in confirmed(spark, *pages)] == [None, mismatch, mismatch, open_, None, open_, None, None, open_, open_]
    assert [r[0] for r in confirmed(spark, "<h1>The H</h1>", hosts=("y.org",))] == ["article-outside-scope"]
    assert [r[0] for r in confirmed(spark, "<h1>!</h1>", title="!")] == [open_]


def test_provider_json(spark):
    news = {"articles": [{"headline": "N", "categories": [{"type": "league", "leagueId": 1}, {"type": "team", "teamId": 2}]}, {"headline": "M", "categories": []}]}
    side = lambda i, where, score: {"id": str(i), "homeAway": where, "team": {"displayName": f"T{i}"}, "score": {"value": score}}
    games = {"team": {"id": "2"}, "events": [{"id": "e", "date": "2026-01-01T00:00Z", "timeValid": False, "competitions": [{"neutralSite": False, "competitors": [side(2, "home", 3), side(3, "away", 1)]}]}]}
    grouped = {"team": {"id": "2"}, "athletes": [{"items": [{"id": "p", "displayName": "P", "position": {"abbreviation": "QB"}}]}]}
    flat = {"team": {"id": "2"}, "athletes": [{"id": "q", "displayName": "Q", "position": {"abbreviation": "WR"}}]}
    df = lambda *x: spark.createDataFrame([(json.dumps(v), 2, 1) for v in x], "text string, team_id bigint, league_id bigint")
    assert [r.title for r in parsers.provider_news(df(news), ["team_id", "league_id"]).collect()] == ["N"]
    (g,) = parsers.provider_schedule(df(games), ["team_id"]).collect()
    assert (g.home_away, g.opponent, g.team_score, g.opponent_score, g.date_precision) == ("home", "T3", 3.0, 1.0, "day")
    assert sorted((r.id, r.position) for r in parsers.provider_roster(df(grouped, flat), ["team_id"]).collect()) == [("p", "QB"), ("q", "WR")]


def test_bodies(spark):
    rows = [
        (b"plain", None), (gzip.compress(b"zip"), "gzip"), (zlib.compress(b"defl"), "deflate"), (b"", None), (b"x" * 200, None), (gzip.compress(b"y" * 5000), "gzip"),
        (b"junk", "gzip"), (b"a", "zstd"), (b"\xff\xfe", None), (None, None),
    ]
    df = spark.createDataFrame(rows, "body binary, encoding string").select(documents.decode_body(F.col("body"), F.col("encoding"), 150).alias("d"))
    assert [tuple(r.d) for r in df.collect()] == [
        ("plain", None), ("zip", None), ("defl", None), (None, "empty-response"), (None, "response-too-large"), (None, "response-too-large"),
        (None, "invalid-compressed-response"), (None, "unexpected-encoding"), (None, "invalid-utf8"), (None, "empty-response"),
    ]


def test_responses(spark):
    rows = [
        ("a", 1, 200, "text/html; charset=utf-8", b"x", "timeout"), ("a", 2, 200, "text/html", b"ok", None), ("b", 1, 404, "text/html", b"x", None),
        ("c", 1, 200, "image/png", b"x", None), ("d", 1, 503, "text/html", b"x", None), ("d", 2, 503, "text/html", b"x", None),
    ]
    df = spark.createDataFrame(rows, "url string, attempt int, status int, content_type string, body binary, error string").withColumn("encoding", F.lit(None).cast("string"))
    got = {r.url: (r.text, r.error_code, r.attempt) for r in documents.best_attempt(documents.accepted(df)).collect()}
    assert got == {"a": ("ok", None, 2), "b": (None, "http-404", 1), "c": (None, "invalid-content-type", 1), "d": (None, "http-503", 2)}
    asked = spark.createDataFrame([("s", f"u{i % 4}", i) for i in range(8)], "school string, url string, pos int")
    over = documents.within_budget(asked, most=3).where("error_code is not null").collect()
    assert {r.url for r in over} == {"u3"} and len(over) == 2
    assert [r[0] for r in spark.createDataFrame([("8.8.8.8",), ("10.0.0.1",), ("::1",), ("x",)], "a string").select(documents.is_public_address("a")).collect()] == [True, False, False, False]


def test_catalog(spark, tmp_path):
    school = lambda slug, i, sports: {"slug": slug, "ncaaId": i, "name": slug, "athleticsUrl": "https://x.org/", "conference": {"slug": "c", "name": "C"},
                                      "sports": [{"slug": s, "code": s, "name": s, "gender": "men", "conference": {"slug": "c"}} for s in sports]}
    for i, s in enumerate((school("a", 1, ["x", "y"]), school("b-", 1, ["x", "x"]), school("c", 3, []))):
        (tmp_path / f"{i}.json").write_text(json.dumps(s))
    rows = catalog.schools(spark, f"file://{tmp_path}/*.json")
    assert {tuple(r) for r in catalog.catalog_violations(rows, 1, 9).collect()} == {
        ("b-", "slug"), ("b-", "sport-slugs-unique"), ("c", "sports-count"), ("1", "ncaaId-unique")
    }
    assert catalog.programs(rows).count() == 4 and [r.slug for r in catalog.conference_list(rows).collect()] == ["c"]
    none = catalog.read_optional(spark, f"file://{tmp_path}/none/*.json", T.StructType([T.StructField("a", T.StringType())]))
    assert none.count() == 0 and none.columns == ["a"]


def test_paged_listing(spark):
    df = spark.createDataFrame([("r", 1, ["a", "b"], 3), ("r", 2, ["c"], 3), ("s", 1, ["a"], 2)], "k string, page int, rows array<string>, total_count int")
    assert {r.k: r.complete for r in documents.pages_complete(df, ["k"]).collect()} == {"r": True, "s": False}
    assert dt.date.today() > dt.date(2026, 1, 1)
