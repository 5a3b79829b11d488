import datetime as dt
import json

import pytest

from tidewire.sources.graphs import official_rosters, official_schedules

ROSTER, SCHEDULE = "https://www.x.org/sports/mens-golf/roster", "https://x.org/sports/mens-golf/schedule/2026"
SCHEMA = "page int, text string, url string, aliases array<string>, gender string, slugs array<string>, hosts array<string>"


class Nodes(list):
    """A page's state: ``put`` adds a value, with objects and lists inside, and returns the number of its node."""

    def put(self, value):
        at = len(self)
        self.append(None)
        if isinstance(value, dict):
            value = {k: self.put(v) for k, v in value.items()}
        elif isinstance(value, list):
            value = [self.put(v) for v in value]
        self[at] = value
        return at


def state(*values):
    nodes = Nodes()
    for v in values:
        nodes.put(v)
    return f'<h1>2024-25 Golf Roster</h1><script type="application/json" id="__NUXT_DATA__" data-x>{json.dumps(nodes)}</script>'


def run(spark, operator, *pages, url, **other):
    told = {"aliases": ["mens golf", "golf"], "gender": "mens", "slugs": ["mens-golf"], "hosts": ["x.org"]} | other
    df = spark.createDataFrame([(i, p, url, *told.values()) for i, p in enumerate(pages)], SCHEMA)
    out = {}
    for r in operator(df, ["page"]).orderBy("page", "pos").collect():
        out.setdefault(r.page, []).append(r)
    return [out.get(i, []) for i in range(len(pages))]


GOLF, FOOTBALL = {"title": "Men's Golf", "shortname": "mgolf"}, {"title": "Football"}
ANN = {"rosterPlayerId": 7, "firstName": "Ann", "lastName": "Lee", "positionShort": "G", "call_to_action": "/sports/mens-golf/roster/ann/7", "image": {"url": "/i.jpg"}}


def roster(players, sport=GOLF, **more):
    return {"players": players, "displayTitle": "Roster", "sport": sport} | more


def test_only_the_asked_sport(spark):
    two = state({"players": [{"firstName": "Side", "lastName": "Bar"}]}, roster([{"firstName": "Foot", "lastName": "Ball"}], FOOTBALL, season={"title": "2020"}),
                roster([ANN, {"firstName": "Hid", "hide": True}, {"firstName": "Eve", "gender": "F"}, {"firstName": "Guest", "sport": FOOTBALL}, {"firstName": "Bob", "gender": "M"}],
                       season={"title": "2026-27"}))
    (page,) = run(spark, official_rosters, two, url=ROSTER)
    assert [(p.error_code, p.id, p.name, p.season) for p in page] == [(None, "7", "Ann Lee", "2026-27"), (None, "Bob", "Bob", "2026-27")]
    assert (page[0].url, page[0].image_url, page[0].position) == ("https://www.x.org/sports/mens-golf/roster/ann/7", "https://www.x.org/i.jpg", "G")


def test_what_a_page_without_players_says(spark):
    pages = [
        state(roster([])), state(roster([ANN], FOOTBALL)), state({"players": [ANN]}), state(roster([{"firstName": "Hid", "hide": True}])), None, "<p>none</p>",
        state(roster([ANN])) + state(roster([ANN])), '<script id="__NUXT_DATA__" type="application/json">[{</script>', state(roster("none")), state(roster([{"rosterPlayerId": 1}])),
        state(roster([ANN | {"call_to_action": "https://other.org/1"}])), state(roster([ANN | {"positionShort": "x" * 5000}])), state(roster([ANN] * 1001)),
        state(roster([ANN, ANN | {"lastName": "New"}])),
    ]
    got = run(spark, official_rosters, *pages, url=ROSTER)
    changed = "source-format-changed"
    assert [(p[0].error_code, p[0].pos, len(p)) for p in got[:-1]] == [
        (None, -1, 1), (changed, -1, 1), (changed, -1, 1), (changed, -1, 1), ("empty-response", -1, 1), *[(changed, -1, 1)] * 8,
    ]
    assert [(p.name, p.pos, p.season) for p in got[-1]] == [("Ann New", 0, "2024-25")]


@pytest.mark.parametrize("url", ["https://x.org/sports/football/roster", "https://x.org/sports/mens-golf/schedule", "https://y.org/sports/mens-golf/roster", "http://x.org/sports/mens-golf/roster"])
def test_a_page_of_another_route(spark, url):
    (page,) = run(spark, official_rosters, state(roster([ANN])), url=url)
    assert [(p.error_code, p.name) for p in page] == [("source-scope-unverified", None)]


CARD = '<li class="sidearm-roster-player"><div class="sidearm-roster-player-name"><a href="{}">Cy Poe</a></div><div class="sidearm-roster-player-position"><span> D </span></div></li>'


def test_static_players(spark):
    own, other = CARD.format("/sports/mens-golf/roster/cy/1"), CARD.format("/sports/football/roster/cy/1")
    page, mixed, graph_first = run(spark, official_rosters, own, own + other, state(roster([ANN])) + own, url=ROSTER)
    assert [(p.name, p.position, p.url) for p in page] == [("Cy Poe", "D", "https://www.x.org/sports/mens-golf/roster/cy/1")]
    assert [p.error_code for p in mixed] == ["source-scope-unverified"] and [p.name for p in graph_first] == ["Ann Lee"]


def games(listed, sport=GOLF, **more):
    return {"games": listed, "season": {"title": "2026"}, "sport": sport} | more


def test_games(spark):
    one = {"id": 1, "date": "2026-03-01T19:00:00", "opponent": {"title": "Else U"}, "location_indicator": "A", "facility": {"title": "Hall"}, "game_center_link": "/g/1",
           "result": {"status": "W", "team_score": "3", "opponent_score": 1.0}}
    two = {"date": "2026-02-01", "opponent": {"title": "Other"}, "noplay_text": "Canceled", "location": "Town", "location_indicator": "N"}
    pages = [state(games([two], FOOTBALL), {"games": [two]}, games([one, two])), state(games([one | {"date": "soon"}])), state(games([one | {"opponent": "Else"}])), state(games([]))]
    first, undated, nameless, none = run(spark, official_schedules, *pages, url=SCHEDULE)
    day = lambda m: dt.datetime(2026, m, 1)
    assert [(g.id, g.date, g.status, g.home_away, g.venue, g.team_score, g.opponent_score) for g in first] == [
        ("1", day(3), "Final - Win", "away", "Hall", 3, 1), ("2026-02-01T00:00:00.000Z|Other", day(2), "Canceled", "neutral", "Town", None, None),
    ]
    assert first[0].url == "https://x.org/g/1"
    assert [g.error_code for g in (*undated, *nameless, *none)] == ["source-format-changed"] * 2 + [None]


def test_static_games(spark):
    card = lambda inside, more="": f'<li class="sidearm-schedule-game {more}"><div class="sidearm-schedule-game-opponent-name">Else</div>{inside}</li>'
    pages = [
        card('<time datetime="2026-03-01T19:00">x</time><div class="sidearm-schedule-game-result">W, 3-1</div>', "sidearm-schedule-home-game"),
        card('<span class="sidearm-schedule-game-toggle">Hide/Show - March 1, 2026</span>', "sidearm-schedule-game-away"),
        card('<a aria-label="Recap of Else on Mar 1, 2026: text" href="#">x</a>'), card("<b>Mar 1</b>"),
    ]
    got = run(spark, official_schedules, *pages, url=SCHEDULE)
    assert [(g[0].date, g[0].home_away, g[0].team_score, g[0].status) for g in got[:3]] == [
        (dt.datetime(2026, 3, 1), "home", 3, "W, 3-1"), (dt.datetime(2026, 3, 1), "away", None, "Scheduled"), (dt.datetime(2026, 3, 1), None, None, "Scheduled"),
    ]
    assert got[3][0].error_code == "source-format-changed"
