import copy
import json

from tidewire.operators import closed_schema as cs

AT, URL = "2026-01-01T00:00:00.000Z", "https://x.org/a"
ARTICLE = {"id": "1", "title": "T", "url": URL, "discoverySourceUrl": URL, "publishedAt": None, "publishedAtPrecision": "unknown", "imageUrl": None, "imageAlt": None, "publisher": "P"}
RECRUIT = {
    "id": "r", "name": "R", "classYear": 2026, "position": None, "status": "offered", "schoolId": "s", "sport": "golf", "sourceUrl": URL, "updatedAt": AT, "profileUrl": None, "imageUrl": None,
    "schoolName": None, "hometown": None, "rating": 99.5, "ratingSystem": "247sports", "stars": 5, "nationalRank": 1, "positionRank": None, "stateRank": None, "rankingState": "TX", "rankingGroup": None,
}
EMPTY = {"status": "empty", "lastAttemptAt": AT, "lastSuccessAt": AT, "sourceUrl": URL, "season": None, "reason": None, "records": []}
SOURCE = {"status": "ok", "lastAttemptAt": AT, "lastSuccessAt": AT, "sourceUrl": URL, "reason": None, "recordCount": 1}
GAME = {"id": "g", "date": AT, "name": "N", "status": "S", "venue": None, "homeAway": None, "opponent": "O", "teamScore": 3, "opponentScore": 2.5, "url": None}
PLAYER = {"id": "p", "name": "P", "position": None, "jersey": None, "year": None, "imageUrl": None, "url": None}
SOUND = {
    "schemaVersion": 1, "academicYear": "2025-26", "conference": {"slug": "c", "name": "C"}, "generatedAt": AT,
    "school": {"slug": "s", "ncaaId": "1", "name": "S", "athleticsUrl": None, "membershipSourceUrl": URL},
    "sports": {"mens-golf": {
        "sponsored": True, "code": "MGO", "name": "Golf", "gender": "men", "conference": {"slug": "c", "name": "C"},
        "news": EMPTY | {"status": "ok", "records": [ARTICLE, ARTICLE | {"id": "2", "author": "A", "publishedAt": AT}], "sources": [SOURCE]}, "schedule": EMPTY | {"records": [GAME]},
        "roster": EMPTY | {"records": [PLAYER]}, "recruitingAnnouncements": EMPTY, "recruitingBoard": EMPTY | {"records": [RECRUIT]}, "recruitingOffers": EMPTY,
    }},
}

NEWS = "sports.mens-golf.news"
BREACHES = [
    (("extra",), 1, [("extra", "additionalProperties")]), (("schemaVersion",), 2, [("schemaVersion", "enum")]), (("schemaVersion",), "1", [("schemaVersion", "enum")]),
    (("academicYear",), None, [("academicYear", "type")]), (("conference", "name"), ..., [("conference.name", "required")]), (("school", "athleticsUrl"), "http://x.org/", [("school.athleticsUrl", "pattern")]),
    (("generatedAt",), "2026-01-01", [("generatedAt", "pattern")]), (("sports",), {}, [("sports", "minProperties")]), (("sports", "Bad Slug"), {}, [("sports.Bad Slug", "additionalProperties")]),
    (("sports",), [], [("sports", "type")]), (("sports", "mens-golf", "sponsored"), False, [("sports.mens-golf.sponsored", "enum")]),
    (("sports", "mens-golf", "news", "records", 1, "title"), "x" * 301, [(f"{NEWS}.records[1].title", "maxLength")]),
    (("sports", "mens-golf", "news", "records", 0, "title"), "", [(f"{NEWS}.records[0].title", "minLength")]),
    (("sports", "mens-golf", "news", "records", 0, "note"), "n", [(f"{NEWS}.records[0].note", "additionalProperties")]),
    (("sports", "mens-golf", "news", "records", 0, "publishedAtPrecision"), "hour", [(f"{NEWS}.records[0].publishedAtPrecision", "enum")]),
    (("sports", "mens-golf", "news", "records", 1, "metadataCheckedAt"), None, [(f"{NEWS}.records[1].metadataCheckedAt", "type")]),
    (("sports", "mens-golf", "news", "sources"), ..., [(f"{NEWS}.sources", "required")]), (("sports", "mens-golf", "news", "sources"), [SOURCE] * 21, [(f"{NEWS}.sources", "maxItems")]),
    (("sports", "mens-golf", "news", "sources", 0, "recordCount"), 1.5, [(f"{NEWS}.sources[0].recordCount", "type")]),
    (("sports", "mens-golf", "recruitingBoard", "records", 0, "stars"), 6, [("sports.mens-golf.recruitingBoard.records[0].stars", "maximum")]),
    (("sports", "mens-golf", "recruitingBoard", "records", 0, "rankingState"), "tx", [("sports.mens-golf.recruitingBoard.records[0].rankingState", "pattern")]),
    (("sports", "mens-golf", "schedule", "records", 0, "homeAway"), "there", [("sports.mens-golf.schedule.records[0].homeAway", "enum")]),
    (("sports", "mens-golf", "schedule", "records", 0, "teamScore"), -1, [("sports.mens-golf.schedule.records[0].teamScore", "minimum")]),
    (("sports", "mens-golf", "roster", "records", 0), "p", [("sports.mens-golf.roster.records[0]", "type")]),
]


def broken(path, value):
    out = copy.deepcopy(SOUND)
    at = out
    for step in path[:-1]:
        at = at[step]
    if value is ...:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return out


def test_every_breach_is_a_row(spark):
    documents = [SOUND, *(broken(p, v) for p, v, _ in BREACHES)]
    rows = [(i, json.dumps(d)) for i, d in enumerate(documents)] + [(900, "{broken"), (901, None), (902, "[]")]
    found = {}
    for r in cs.schema_violations(spark.createDataFrame(rows, "id int, body string"), "id", "body", cs.SNAPSHOT).collect():
        found.setdefault(r.id, []).append((r.path, r.rule))
    assert 0 not in found and found.pop(900) == found.pop(901) == [("", "json")] and found.pop(902) == [("", "type")]
    assert found == {i: told for i, (_, _, told) in enumerate(BREACHES, 1)}


def test_several_breaches_of_one_document(spark):
    document = broken(("sports", "mens-golf", "news", "records", 0, "publisher"), ...)
    document["sports"]["mens-golf"]["news"]["records"][0] |= {"b": 1, "a": 2, "id": 5}
    df = spark.createDataFrame([(1, json.dumps(document))], "id int, body string")
    got = sorted((r.path.rpartition(".")[2], r.rule) for r in cs.schema_violations(df, "id", "body", cs.SNAPSHOT).collect())
    assert got == [("a", "additionalProperties"), ("b", "additionalProperties"), ("id", "type"), ("publisher", "required")]
