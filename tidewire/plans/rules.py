"""Rules on single values, over whole tables whose rows take the cases in turn."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewire.functions import dates, providers, sports, text, urls
from tidewire.operators import discovery, enrich, official, windows
from tidewire.plans.registry import cases
from tidewire.sources import documents

S, A, B, I = "VARCHAR", "VARCHAR[]", "BOOLEAN", "INTEGER"  # noqa: E741
_utc = lambda *x: dt.datetime(*x)


def _at(c):
    return c.cast("timestamp_ntz")


cases(
    "iso_dates", "T5", "orders", "o_orderkey",
    {"v": ("string", ["2026-09-16T12:00:00Z", "Wed, 16 Sep 2026 12:00:00 GMT", "2026-09-16", "soon", None, "2026-09-16T12:00:00+02:00"])},
    {"at": (S, ["2026-09-16T12:00:00.000Z", "2026-09-16T12:00:00.000Z", "2026-09-16T00:00:00.000Z", None, None, "2026-09-16T10:00:00.000Z"])},
    lambda c: {"at": dates.iso_date(c["v"])},
)
cases(
    "title_identities", "T9", "orders", "o_orderkey",
    {"v": ("string", ["Ｂig  Win!", "<b>Café</b> opens", "ﬁnal—score 3:2", "", "Ünï 1"])},
    {"identity": (S, ["big win", "café opens", "final score 3 2", "", "ünï 1"])},
    lambda c: {"identity": enrich.title_identity(c["v"])},
)
cases(
    "sport_slugs", "T11", "part", "p_partkey",
    {"n": ("string", ["Men's Basketball", "Mixed Rifle", "Women's Swimming & Diving", "Fútbol"]), "k": ("string", ["MBB", "XRI", "WSW", "MFB"])},
    {"slug": (S, ["basketball", "coed-rifle", "womens-swimming-and-diving", "futbol"])},
    lambda c: {"slug": discovery.sport_key(c["n"], c["k"])},
)
cases(
    "conference_slugs", "T12", "part", "p_partkey",
    {"v": ("string", ["The Ivy League", "Big East Conference", "  ", None, "The American Conference", "Conference USA"])},
    {"slug": (S, ["ivy-league", "big-east", None, None, "american", "conference-usa"])},
    lambda c: {"slug": discovery.conference_key(c["v"])},
)
cases(
    "athletics_urls", "T13", "customer", "c_custkey",
    {"v": ("string", ["goteam.com", "http://www.GoTeam.com/x#top", " https://a.edu/ ", "", None, "https://u:p@a.edu/", "https://a.edu:81/", "https://10.0.0.1/", "ftp://a.edu/", "intranet", "https://x.local/"])},
    {"url": (S, ["https://goteam.com/", "https://www.goteam.com/x", "https://a.edu/", None, None, None, None, None, None, None, None])},
    lambda c: {"url": urls.athletics_url(c["v"])},
)
cases(
    "school_name_keys", "T14 T15", "customer", "c_custkey",
    {"v": ("string", ["The University of Texas", "Boston College", "San José State", "William & Mary", "College of the Holy Cross"])},
    {"key": (S, ["texas", "boston", "san jose state", "william and mary", "holy cross"]), "literal": (S, ["the university of texas", "boston college", "san jose state", "william and mary", "college of the holy cross"])},
    lambda c: {"key": text.school_name_key(text.fold(c["v"])), "literal": text.ascii_words(text.fold(c["v"]))},
)
cases(
    "phrases", "T16", "customer", "c_custkey",
    {"t": ("string", ["ohio state wins", "arizona statement", "at ohio", "", "new mexico state"]), "p": ("string", ["ohio state", "arizona state", "ohio", "ohio", "mexico state"])},
    {"found": (B, [True, False, True, False, True])},
    lambda c: {"found": text.has_phrase(c["t"], c["p"])},
)
cases(
    "sport_identities", "T18 T19", "part", "p_partkey",
    {"g": ("string", ["men", None, "Female", None, "X", "m"]), "n": ("string", ["Men's Indoor Track", "Women's Crew", "Swimming", "Wrestling", "Mixed Rifle", "Lightweight Crew"]),
     "s": ("string", ["mens-indoor-track", "womens-crew", "womens-swimming", "wrestling", "coed-rifle", "mens-lightweight-crew"])},
    {"gender": (S, ["mens", "womens", "womens", None, "coed", "mens"]), "base": (S, ["indoor track and field", "crew", "swimming and diving", "wrestling", "rifle", "lightweight crew"]),
     "family": (S, ["track and field", "rowing", "swimming and diving", "wrestling", "rifle", "lightweight rowing"])},
    lambda c: {"gender": sports.sport_gender(c["g"], c["n"], c["s"]), "base": sports.base_sport(c["n"], c["s"]), "family": sports.sport_family(sports.base_sport(c["n"], c["s"]))},
)
cases(
    "hosts_of_schools", "T25 U4", "customer", "c_custkey",
    {"v": ("string", ["https://goteam.com/", "https://www.goteam.com/x", "http://goteam.com/", None])},
    {"hosts": (S, ["goteam.com,www.goteam.com", "goteam.com,www.goteam.com", "", ""])},
    lambda c: {"hosts": F.array_join(F.array_sort(urls.official_hosts(c["v"])), ",")},
)
cases(
    "feed_dates", "T26", "orders", "o_orderkey",
    {"v": ("string", ["Wed, 16 Sep 2026 12:00:00 GMT", "16 Sep 2026 12:00:00 EDT", "2026-09-16T12:00:00Z", "2026-09-16T12:00:00", "16 Sep 2026", "x GMT"])},
    {"at": ("TIMESTAMP", [_utc(2026, 9, 16, 12), _utc(2026, 9, 16, 16), _utc(2026, 9, 16, 12), None, None, None]), "how": (S, ["instant", "instant", "instant", "unknown", "unknown", "unknown"])},
    lambda c: {"at": _at(dates.publication_date(c["v"])["at"]), "how": dates.publication_date(c["v"])["precision"]},
)
cases(
    "conference_days", "T28", "orders", "o_orderkey",
    {"v": ("string", ["9/6/2026", "02/30/2026", "9/6/1999", "2026-09-06", None, "12/31/2025"])},
    {"at": ("TIMESTAMP", [_utc(2026, 9, 6), None, None, None, None, _utc(2025, 12, 31)])},
    lambda c: {"at": _at(dates.conference_day(c["v"]))},
)
cases(
    "static_days", "T29", "orders", "o_orderkey",
    {"d": ("string", ["2026-09-06T19:00", None, None, "", "tbd"]), "g": ("string", [None, "Hide - September 6, 2026", None, None, "Hide - September 6, 2026"]),
     "l": ("string", [None, None, "Recap of X on Sep 7 2026", "no day", None])},
    {"at": ("TIMESTAMP", [_utc(2026, 9, 6), _utc(2026, 9, 6), _utc(2026, 9, 7), None, None])},
    lambda c: {"at": _at(dates.static_day(c["d"], c["g"], c["l"]))},
)
cases(
    "seasons_of_headings", "T30", "orders", "o_orderkey",
    {"v": ("string", ["2025-26 Golf Roster", "2026 Football Schedule", "Roster 2025–26", "Roster", None])},
    {"season": (S, ["2025-26", None, "2025–26", None, None])},
    lambda c: {"season": dates.season_of(c["v"], "roster")},
)
cases(
    "result_scores", "T32", "orders", "o_orderkey",
    {"v": ("string", ["21", "x", "12345", "0", None, "-3"]), "r": ("string", ["NR", "12", "0", "7.5", "200", None])},
    {"score": (I, [21, None, None, 0, None, None]), "rank": ("DOUBLE", [None, 12.0, None, 7.5, None, None])},
    lambda c: {"score": dates.result_score(c["v"]), "rank": dates.optional_number(c["r"], 100)},
)
cases(
    "article_images", "T34", "pages", "page_id",
    {"v": ("string", ["https://x.org/i/p.jpg", "https://x.org/images/logos/site/site.png", "https://x.org/", "https://x.org/story/1", "http://x.org/p.jpg",
                      "https://cdn.org/r?url=https%3A%2F%2Fx.org%2Fimages%2Flogos%2Fsite%2Fsite.png", "https://a.foxsports.com/static/orion/images/defaults/story-card.jpg", None])},
    {"image": (S, ["https://x.org/i/p.jpg", None, None, None, None, None, None, None])},
    lambda c: {"image": enrich.article_image(c["v"], F.lit("https://www.x.org/story/1/"))},
)
cases(
    "commit_ids", "T37 T38", "customer", "c_custkey",
    {"v": ("string", ["a" * 40, "A" * 40, "b" * 39, "", None])},
    {"commit": (S, ["a" * 40, None, None, None, None])},
    lambda c: {"commit": text.commit_id(c["v"])},
)
cases(
    "provider_urls", "T39", "customer", "c_custkey",
    {"s": ("string", ["football", "softball", "golf", "basketball"]), "k": ("string", ["roster", "schedule", "roster", "news"]), "i": ("string", ["12", "x", "3", "4"]),
     "n": ("string", [None, None, None, "https://n.org/feed"]), "y": ("int", [2026, 1999, 2026, 2027])},
    {"url": (S, ["https://site.api.espn.com/apis/site/v2/sports/football/college-football/teams/12/roster", None, None, "https://n.org/feed"]),
     "list": (S, ["https://247sports.com/college/x-y/season/2026-football/commits/", None, None, "https://247sports.com/college/x-y/season/2027-basketball/commits/"])},
    lambda c: {"url": providers.team_url(providers.league_path(c["s"]), c["i"], c["k"], c["n"]), "list": providers.recruiting_url(F.lit("x-y"), c["s"], c["y"], F.lit("commits"))},
)
_LIST = "https://247sports.com/college/x/season/2026-football/offers/"
_MORE = _LIST + "?ViewPath=~%2FViews%2FSkyNet%2FRecruitInterest%2F_SimpleDetailedSetForSeason.ascx&Position=7"
cases(
    "continuations", "T40", "customer", "c_custkey",
    {"v": ("string", [_LIST, _MORE, _LIST + "?Position=7&ViewPath=~/Views/SkyNet/RecruitInterest/_SimpleDetailedSetForSeason.ascx", _LIST + "?Position=7",
                      _MORE + "&x=1", _MORE.replace("247sports", "other"), _MORE + "#a", _LIST.upper().replace("HTTPS", "https")])},
    {"exact": (B, [True, False, False, False, False, False, False, True]), "next": (S, [None, _MORE, _MORE, None, None, None, None, None]), "same": (B, [False, True, True, False, False, False, False, False])},
    lambda c: {"exact": providers.exact_source(c["v"], F.lit(_LIST)), "next": providers.continuation_url(c["v"], F.lit(_LIST)), "same": providers.equivalent_continuation(c["v"], F.lit(_MORE))},
)
cases(
    "rating_modes", "T41", "customer", "c_custkey",
    {"v": ("array<string>", [["247Sports", "2026"], ["Composite"], [], ["247Sports", "Composite"]])},
    {"mode": (S, ["247sports", None, None, None]), "error": (S, [None, "unsupported-rating-system", None, "unsupported-rating-system"])},
    lambda c: {"mode": providers.rating_mode(c["v"])["mode"], "error": providers.rating_mode(c["v"])["error"]},
)
cases(
    "exact_documents", "T42 P31", "customer", "c_custkey",
    {"v": ("string", ['{"b":1,"a":2}', '{"a":1}', '{"a":1,"b":2,"c":3}', "[1]", "{x", None])},
    {"exact": (B, [True, False, False, False, False, False]), "error": (S, [None, None, None, None, "malformed-public-json", "malformed-public-json"]),
     "decoded": (S, ['{"b":1,"a":2}', '{"a":1}', '{"a":1,"b":2,"c":3}', "[1]", "{x", None])},
    lambda c: {"exact": text.exact_keys(c["v"], ["a", "b"]), "error": text.public_json(c["v"])["error"], "decoded": text.decoded_utf8(c["v"].cast("binary"))},
)
cases(
    "external_links", "T43", "customer", "c_custkey",
    {"r": ("array<string>", [["desktop"], ["mobile"], ["desktop", "event"], []]), "h": ("string", ["https://www.espn.com/a", "https://www.espn.com/b", "https://x.org/c", "https://www.espn.com/d"])},
    {"link": (S, ["https://www.espn.com/a", None, None, None])},
    lambda c: {"link": providers.external_link(F.array(F.struct(c["r"].alias("rel"), c["h"].alias("href"))))},
)
cases(
    "slot_labels", "T45", "orders", "o_orderkey",
    {"v": ("timestamp_ntz", [_utc(2026, 1, 2, 3, 4, 5), None])},
    {"label": (S, ["2026-01-02T03:04Z", None])},
    lambda c: {"label": dates.slot_label(c["v"])},
)
cases(
    "article_scopes", "P3", "pages", "page_id",
    {"u": ("string", ["https://x.org/a/1", "https://x.org/b/1", "https://www.ncaa.com/news/football/article/1", "https://www.ncaa.com/news/golf/article/1",
                      "https://www.ncaa.com/news/trackfield-indoor-men/a/1", "https://www.ncaa.com/video/football/1"]),
     "p": ("string", ["/a/", "/a/", None, None, None, "/news/"]),
     "f": ("string", ["https://x.org/f.xml", "https://x.org/f.xml", "https://www.ncaa.com/news/football/fbs/rss.xml", "https://www.ncaa.com/news/football/fbs/rss.xml",
                      "https://www.ncaa.com/news/trackfield-outdoor-women/d1/rss.xml", "https://www.ncaa.com/news/football/fbs/rss.xml"])},
    {"fits": (B, [True, False, True, False, True, False])},
    lambda c: {"fits": urls.in_article_scope(c["u"], c["p"], c["f"])},
)
cases(
    "label_conflicts", "F8", "part", "p_partkey",
    {"l": ("array<string>", [["Men's Golf"], ["Women's Golf"], ["Golf"], ["Men's and Women's Rifle"], ["Men's Rifle"], ["Lightweight Rowing"], ["Heavyweight Rowing"], []]),
     "g": ("string", ["mens", "mens", "mens", "coed", "coed", "mens", "mens", "womens"]),
     "s": ("string", ["mens-golf", "mens-golf", "mens-golf", "coed-rifle", "coed-rifle", "mens-crew", "mens-lightweight-crew", "womens-golf"])},
    {"conflict": (B, [False, True, False, False, True, True, True, False])},
    lambda c: {"conflict": official.label_conflicts(c["l"], c["g"], c["s"])},
)
_PROGRAM = {
    "l": ("array<string>", [["Golf", "mgolf"], ["Golf"], ["Soccer"], ["Rifle"], ["Rowing"], ["Track & Field"], ["Golf"]]),
    "t": ("array<string>", [["Men's Golf"], ["Golf"], ["Women's Soccer"], ["Rifle"], ["Rowing"], ["Track & Field"], ["Golf"]]),
    "g": ("string", ["f", "f", "f", "m", "g", "m", "m"]), "e": ("string", ["mens", "mens", "mens", "coed", "womens", "mens", "mens"]),
    "s": ("string", ["mens-golf", "mens-golf", "mens-soccer", "coed-rifle", "womens-rowing", "mens-indoor-track", "mens-golf"]),
    "f": ("string", ["golf", "golf", "soccer", "rifle", "rowing", "track and field", "golf"]),
    "a": ("array<string>", [["mens golf"], ["mens golf"], ["mens soccer"], ["coed rifle"], ["womens rowing"], ["mens indoor track"], ["mens golf"]]),
    "n": ("boolean", [False, False, False, False, False, True, False]), "r": ("boolean", [False, False, False, True, False, False, False]),
}
cases(
    "program_matches", "F9", "part", "p_partkey", _PROGRAM, {"matches": (B, [True, False, False, False, True, True, True])},
    lambda c: {"matches": official.program_matches(c["l"], c["t"], c["g"], c["e"], c["s"], c["f"], c["a"], c["n"], c["r"])},
)
cases(
    "roster_genders", "F10", "part", "p_partkey",
    {"g": ("string", [None, "", "m", "f", "Female", "x"]), "e": ("string", ["mens", "mens", "mens", "mens", "womens", None])},
    {"kept": (B, [True, True, True, False, True, True])},
    lambda c: {"kept": official.roster_gender_matches(c["g"], c["e"])},
)
cases(
    "conference_categories", "F11", "part", "p_partkey",
    {"v": ("string", ["Football", "Football, General", "Football, Golf", "General", "Men's Basketball, Women's Basketball", "Men's Basketball,Women's Basketball"]),
     "e": ("string", ["Football", "Football", "Football", "Football", "Men's Basketball", "Men's Basketball"]), "t": ("string", ["a", "a", "a", "a", "Basketball media day set", "Two teams win"])},
    {"fits": (B, [True, True, False, False, True, False])},
    lambda c: {"fits": official.categories_fit(c["v"], c["e"], c["t"])},
)
cases(
    "conference_articles", "F12", "pages", "page_id",
    {"v": ("string", ["https://c.org/news/2026/1/2/a-b.aspx", "https://c.org/news/2026/1/2/a.aspx?x=1", "https://d.org/news/2026/1/2/a.aspx", "https://c.org/news/26/1/2/a.aspx", "https://c.org/2026/1/2/a.aspx", None])},
    {"ok": (B, [True, False, False, False, False, False])},
    lambda c: {"ok": official.conference_article(c["v"], F.lit("c.org"))},
)
cases(
    "official_links", "F14 R20", "pages", "page_id",
    {"v": ("string", ["https://a.edu/sports/golf#top", "https://a.edu/x.PDF", "https://b.edu/sports", "https://www.a.edu/sports", "http://a.edu/", None])},
    {"link": (S, ["https://a.edu/sports/golf", None, None, "https://www.a.edu/sports", None, None])},
    lambda c: {"link": urls.official_link(c["v"], F.array(F.lit("a.edu"), F.lit("www.a.edu")))},
)
cases(
    "allowed_addresses", "F20", "pages", "page_id",
    {"a": ("string", ["8.8.8.8", "10.1.2.3", "::1", "2001:4860:4860::8888", "224.0.0.1", "x"]), "u": ("string", ["https://a.edu/x", "https://www.a.edu/", "https://b.edu/", "http://a.edu/", "https://a.edu/?token=1", None])},
    {"public": (B, [True, False, False, True, False, False]), "allowed": (B, [True, True, False, False, False, False])},
    lambda c: {"public": documents.is_public_address(c["a"]), "allowed": F.coalesce(documents.allowed(c["u"], F.array(F.lit("a.edu"))), F.lit(False))},
)
cases(
    "game_names", "J7", "supplier", "s_suppkey",
    {"s": ("string", ["State  <b>U</b>", "Tech"]), "o": ("string", ["Other", "Else"]), "w": ("string", ["away", "home", "neutral", None])},
    {"name": (S, ["State U at Other", "Tech vs Else", "State U vs Other", "Tech vs Else"])},
    lambda c: {"name": official.game_name(c["s"], c["o"], c["w"])},
)
cases(
    "label_lists", "R12 T46", "part", "p_partkey",
    {"l": ("array<string>", [["Golf, Tennis"], ["MGOLF (Men's Golf)"], ["Rowing; Men's Golf"], ["Golf team"], []])},
    {"hit": (B, [False, True, True, False, False])},
    lambda c: {"hit": official.labels_match(c["l"], F.array(F.lit("mens golf")))},
)
cases(
    "source_routes", "R13", "pages", "page_id",
    {"v": ("string", ["https://a.edu/sports/mens-golf/roster", "https://a.edu/sports/mens-golf/schedule", "https://a.edu/sports/golf/roster", "https://a.edu/roster", None])},
    {"ok": (B, [True, False, False, False, False])},
    lambda c: {"ok": urls.source_route(c["v"], F.array(F.lit("mens-golf")), "roster")},
)
cases(
    "service_answers", "R15", "customer", "c_custkey",
    {"v": ("string", ['{"data":[{"a":1},{"b":2}]}', '{"error":"x","data":[]}', '{"data":{}}', '{"data":[1]}', '{"data":[{},{},{}]}', "x", None]), "f": ("string", ["ok", "x" * 41, None])},
    {"error": (S, [None, "invalid-service-response", "invalid-service-response", "invalid-service-record", "invalid-service-response", "invalid-service-response", "invalid-service-response"]),
     "field": (S, ["ok", None, ""]), "field_error": (S, [None, "field-exceeds-budget", None])},
    lambda c: {"error": official.service_rows(c["v"], 2), "field": official.bounded_field(c["f"], 40)["value"], "field_error": official.bounded_field(c["f"], 40)["error"]},
)
cases(
    "page_challenges", "R17", "customer", "c_custkey",
    {"v": ("string", ["<h1>List</h1>", "<title>Just a moment...</title>", "Sorry, you have been blocked", None])},
    {"error": (S, [None, "access-challenge", "access-challenge", "invalid-response-size"])},
    lambda c: {"error": providers.page_challenge(c["v"])},
)
cases(
    "page_contexts", "P19", "customer", "c_custkey",
    {"h": ("string", ["State U 2026 Football Offers (12)", "State U 2025 Football Offers (12)", "State U 2026 Football Offers (12)", "State U 2026 Football Offers (1200)", "Other 2026 Football Offers (1)", "State U 2026 Football Offers (1)"]),
     "c": ("array<string>", [[_LIST], [_LIST], [_LIST, _LIST], [_LIST], [_LIST], [_MORE]])},
    {"error": (S, [None, "heading-scope-mismatch", "canonical-scope-mismatch", "record-count-exceeds-budget", "heading-scope-mismatch", "canonical-scope-mismatch"])},
    lambda c: {"error": providers.page_context(c["h"], c["c"], F.lit(_LIST), F.lit("State U"), F.lit(2026), F.lit("football"), F.lit("offers"), F.lit(_LIST))},
)
cases(
    "navigation_labels", "T24", "part", "p_partkey",
    {"v": ("string", ["Roster for Men's Golf", "Men's Sports Golf", "Golf, Women's Sports", "W- Golf", "Golf: Schedule", "Golf"])},
    {"label": (S, ["Men's Golf", "Men's Golf", "Women's Golf", "Women's Golf", "Golf", "Golf"])},
    lambda c: {"label": discovery.navigation_label(c["v"])},
)
cases(
    "bounded_authors", "T35 O9", "customer", "c_custkey",
    {"v": ("array<string>", [["By Ann", "Bob", "Ann"], ["null"], [], ["a", "b", "c", "d", "e", "f", "g", "h", "i"]])},
    {"authors": (S, ["Ann, Bob", None, None, "a, b, c, d, e, f, g, h"])},
    lambda c: {"authors": text.authors(c["v"])},
)
cases(
    "latest_slots", "W6 K22", "orders", "o_orderkey",
    {"v": ("timestamp_ntz", [_utc(2026, 1, 2, 2, 19), _utc(2026, 1, 2, 2, 18), _utc(2026, 1, 2, 14, 19), _utc(2026, 1, 2, 23, 59)])},
    {"slot": ("TIMESTAMP", [_utc(2026, 1, 2, 2, 19), _utc(2026, 1, 1, 14, 19), _utc(2026, 1, 2, 14, 19), _utc(2026, 1, 2, 14, 19)])},
    lambda c: {"slot": _at(windows.latest_slot(c["v"].cast("timestamp"), [139, 859]))},
)
