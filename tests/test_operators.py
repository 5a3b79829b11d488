import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewire.operators import enrich, health, joins, merge, packing, recruiting, state, windows
from tidewire.operators.classify import accepts

T0 = dt.datetime(2026, 1, 1)
ARTICLE = (
    "program string, url string, title string, published_at timestamp, image_url string, image_alt string, author string,"
    " metadata_checked_at timestamp, pos bigint"
)


def folded(rows):
    """The upsert, one record after another."""
    out = {}
    for program, url, title, at, image, alt, author, checked, _ in sorted(rows, key=lambda r: r[-1]):
        key = (program, url.split("?")[0])
        p = out.get(key, {})
        if image is not None:
            alt = alt if alt is not None else (p.get("alt") if image == p.get("image") else None)
        else:
            image, alt = p.get("image"), p.get("alt")
        checks = [c for c in (checked, p.get("checked")) if c]
        out[key] = {"title": title, "at": at, "image": image, "alt": alt, "author": author or p.get("author"), "checked": max(checks) if checks else None}
    return out


def test_upsert_equals_a_fold(spark):
    r = random.Random(4)
    pick = lambda *x: r.choice(x)
    rows = [
        (pick("p", "q"), f"https://x.org/{r.randrange(6)}{pick('', '?utm_a=1')}", f"t{i}", pick(None, T0 + dt.timedelta(hours=i)), pick(None, None, "a", "b"),
         pick(None, f"alt{i}"), pick(None, f"by{i}"), pick(None, T0 + dt.timedelta(hours=r.randrange(99))), i)
        for i in range(300)
    ]
    got = merge.upsert_by_url(spark.createDataFrame(rows, ARTICLE).repartition(5), ["program"]).collect()
    assert {
        (x.program, x.url): {"title": x.title, "at": x.published_at, "image": x.image_url, "alt": x.image_alt, "author": x.author, "checked": x.metadata_checked_at}
        for x in got
    } == folded(rows)


def test_headlines_and_top_k(spark):
    rows = [
        ("p", "https://x.org/1", "Big  WIN!", T0, None, None, None, None, 1), ("p", "https://x.org/2", "big win", T0 + dt.timedelta(hours=3), None, None, None, None, 2),
        ("p", "https://x.org/3", "big win", None, None, None, None, None, 3), ("p", "https://x.org/4", "big win", None, None, None, None, None, 4),
        ("p", "https://x.org/5", "other", T0 - dt.timedelta(days=9), None, None, None, None, 5),
    ]
    got = merge.merge_news(spark.createDataFrame(rows, ARTICLE), ["program"], 3).orderBy("rank").collect()
    assert [x.url[-1] for x in got] == ["2", "5", "3"]


def test_state_machine(spark):
    rows = [
        ("ok", None, 3, False, None, None, 0), ("empty", None, 0, True, T0, "u", 5), ("unexpected", None, 0, False, T0, "u", 5),
        ("failed", "timeout", 0, None, T0, "u", 5), ("moved", "timeout", 0, None, T0, "other", 5), ("new", "http-404", 0, None, None, None, 0),
    ]
    df = spark.createDataFrame(
        rows, "k string, error string, n_rows int, empty_confirmed boolean, prior_success_at timestamp, prior_source_url string, prior_rows int"
    )
    df = df.withColumn("at", F.lit(T0 + dt.timedelta(days=1))).withColumn("source_url", F.lit("u")).withColumn("reason", F.lit(None).cast("string"))
    got = {r.k: (r.status, r.reason, r.last_success_at == T0, r.record_count) for r in state.refreshed(df).collect()}
    assert got == {
        "ok": ("ok", None, False, 3), "empty": ("empty", None, False, 0), "unexpected": ("stale", "unexpected-empty-source", True, 5),
        "failed": ("stale", "timeout", True, 5), "moved": ("unavailable", "timeout", False, 0), "new": ("unavailable", "http-404", False, 0),
    }


@pytest.mark.parametrize("seed", range(3))
def test_wildcards_equal_a_nested_loop(spark, seed):
    r = random.Random(seed)
    left = [(r.choice("abc"), r.choice("xyz")) for _ in range(30)]
    right = [(r.choice([None, "a", "b"]), r.choice([None, "x", "y"]), i) for i in range(12)]
    got = joins.wildcard_join(spark.createDataFrame(left, "s string, p string"), spark.createDataFrame(right, "s string, p string, i int"), ["s", "p"])
    want = sorted((s, p, i) for s, p in left for a, b, i in right if (a is None or a == s) and (b is None or b == p))
    assert sorted((x.s, x.p, x.i) for x in got.collect()) == want


@pytest.mark.parametrize("ranges", [None, 1, 5, 40])
def test_as_of_of_a_hot_key(spark, ranges):
    r = random.Random(ranges or 0)
    key = lambda: r.choice(["hot"] * 6 + ["k", "m", None])
    rows = [(key(), i, r.choice([None, r.randrange(300)])) for i in range(500)]
    facts = [(key(), r.choice([None, r.randrange(40), r.randrange(300)]), r.choice([None, f"v{i}"])) for i in range(90)]
    df, told = spark.createDataFrame(rows, "k string, id int, at int").repartition(3), spark.createDataFrame(facts, "k string, t int, v string").repartition(2)
    got = {x.id: x.v for x in joins.as_of(df, "at", told, "t", ["k"], "v", ranges).collect()}
    want = {}
    for k, i, at in rows:
        seen = [(-1 if t is None else t, v) for fk, t, v in facts if fk == k and v is not None and (t is None or (at is not None and t <= at))]
        want[i] = max(seen)[1] if seen and k is not None else None
    assert got == want and len({v for v in got.values()}) > 10
    assert ranges or {x.id: x.v for x in joins.as_of(df, "at", told, "t", ["k"], "v", hot=100).collect()} == want


def test_as_of_spreads_a_hot_key(spark):
    """One user with a third of all rows is not one task's."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("at"))
    cut = packing.cut_by_range(rows, ["k", "at"], 12).where("k = 0").groupBy("__range").count()
    assert cut.count() >= 4 and cut.agg(F.max("count")).first()[0] < 400


def test_as_of_and_sets(spark):
    rows = spark.createDataFrame([("k", 1, 5), ("k", 2, 10), ("m", 3, 1)], "k string, id int, at int")
    facts = spark.createDataFrame([("k", 5, "a"), ("k", 7, "b"), ("m", 2, "c")], "k string, t int, v string")
    assert sorted((x.id, x.v) for x in joins.as_of(rows, "at", facts, "t", ["k"], "v").collect()) == [(1, "a"), (2, "b"), (3, None)]
    diff = joins.set_difference(rows.select("k"), spark.createDataFrame([("k",), ("z",)], "k string"), ["k"])
    assert sorted(map(tuple, diff.collect())) == [("m", "left"), ("z", "right")]


def test_unique_matches(spark):
    teams = spark.createDataFrame([(1, "a u", "a"), (2, "b", "b"), (3, "b x", "b"), (4, "c", "c")], "t int, exact string, loose string")
    schools = spark.createDataFrame([(10, "a u", "a"), (11, "b y", "b"), (12, "c z", "c"), (13, "c w", "c")], "s int, exact string, loose string")
    got = {x.t: (x.s, x.how) for x in joins.match_unique(teams, schools, "t", "s", "exact", "loose").collect()}
    assert got == {1: (10, "exact"), 2: (None, "none"), 3: (None, "none"), 4: (None, "none")}


def test_budget_is_sequential(spark):
    r = random.Random(1)
    asked = [(s, i, r.randrange(9)) for s in "ab" for i in range(12)]
    got = {(x.s, x.i): x.budget for x in windows.running_budget(spark.createDataFrame(asked, "s string, i int, w int"), "s", [F.col("i")], "w").collect()}
    for s in "ab":
        left = 24
        for _, i, w in (x for x in asked if x[0] == s):
            use = min(5, left, w)
            assert got[s, i] == use
            left -= use


def test_slots(spark):
    times = [T0 + dt.timedelta(minutes=m) for m in (0, 138, 139, 858, 859, 1439)]
    got = spark.createDataFrame([(t,) for t in times], "t timestamp").select(windows.latest_slot(F.col("t"), [139, 859]).alias("s")).collect()
    day = lambda d, m: T0 + dt.timedelta(days=d, minutes=m)
    assert [x.s for x in got] == [day(-1, 859), day(-1, 859), day(0, 139), day(0, 139), day(0, 859), day(0, 859)]


def test_issues_at_their_bounds(spark):
    now = F.lit(T0)
    at = lambda h: F.lit(T0 - dt.timedelta(hours=h))
    ask = lambda status, seen, made, n: health.program_issues(F.lit(status), seen, made, F.lit(n), now)
    none = F.lit(None).cast("timestamp")
    row = spark.range(1).select(
        ask("ok", at(12), at(12), 1), ask("ok", at(12.01), at(0), 1), ask("stale", none, none, 0), ask("empty", at(-5 / 60), at(-0.1), 2)
    ).first()
    assert row[0] == [] and row[1] == ["news observation is overdue"]
    assert row[2] == ["news status: stale", "no successful news observation", "invalid snapshot observation time", "no configured news source observations"]
    assert row[3] == ["invalid snapshot observation time"]


def test_violations(spark):
    df = spark.createDataFrame([("a", "ok", 0, T0, None, "u"), ("b", "unavailable", 0, T0, None, None), ("c", "empty", 2, T0, T0 + dt.timedelta(1), "u")],
                               "key string, status string, n_records int, last_attempt_at timestamp, last_success_at timestamp, source_url string")
    got = health.violations(df.withColumn("generated_at", F.lit(T0)), "key", health.snapshot_rules(F.lit(T0))).collect()
    assert sorted(map(tuple, got)) == [("a", "ok-has-rows"), ("a", "provenance"), ("c", "empty-has-none"), ("c", "success-before-attempt")]


def test_routing(spark):
    schema = (
        "title string, details string, school string, sport string, gender string, feed_school string, feed_sport string, requires boolean,"
        " ts array<string>, ds array<string>, as array<string>, st array<string>, sx array<string>"
    )
    f = "football"
    rows = [
        ("tigers win", "", "lsu", f, "men", "lsu", f, False, ["lsu"], [], [], [], []), ("tigers win", "", "lsu", f, "men", None, f, False, [], [], [], [], []),
        ("tigers win", "", "lsu", f, "men", "lsu", f, False, [], [], [], [], []), ("other team wins", "", "lsu", f, "men", "lsu", f, False, ["osu"], [], [], [], []),
        ("lsu betting odds", "", "lsu", f, "men", "lsu", f, False, ["lsu"], [], [], [], []), ("lsu nfl star", "", "lsu", f, "men", "lsu", f, False, ["lsu"], [], [], [], []),
        ("lsu wins", "", "lsu", f, "men", None, None, False, ["lsu"], [], [], [f], [f]), ("lsu wins", "", "lsu", f, "men", None, None, False, ["lsu"], [], [], [f, "golf"], [f]),
        ("womens night", "", "lsu", f, "men", "lsu", f, False, ["lsu"], [], [], [], []), ("lsu golf", "", "lsu", f, "men", "lsu", f, False, ["lsu"], [], ["golf"], [], []),
        ("", "", "lsu", f, "men", "lsu", f, False, ["lsu"], [], [], [], []),
    ]
    c = [F.col(n.split()[0]) for n in schema.split(", ")]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(accepts(*c)).collect()]
    assert got == [True, False, True, False, False, False, True, False, False, False, False]


def test_enrichment(spark):
    records = spark.createDataFrame(
        [("p", "https://x.org/1", "One", T0, None, None, None, None, 1), ("p", "https://x.org/2", "Two", T0, "https://x.org/i.jpg", None, None, None, 2),
         ("p", "https://x.org/3", "Three", T0, None, None, None, T0 - dt.timedelta(days=6), 3)], ARTICLE)
    asked = enrich.candidates(records, ["program"], F.lit(T0), 5)
    assert [r.url[-1] for r in asked.orderBy("enrich_rank").collect()] == ["1", "2"]
    page = lambda n, title, declared, image, alt=None, author=None: (f"https://x.org/{n}", title, [declared], [f"{title}!"], [], None, None, image, alt, author, None, None, None)
    pages = spark.createDataFrame(
        [page(1, "One", "https://www.x.org/1/", "/p.jpg", "a photo", "By B"), page(2, "Two", "https://x.org/other", "https://x.org/q.jpg")],
        "url string, title string, declared array<string>, headings array<string>, structured array<string>, og_title string, og_type string, og_image string, og_image_alt string,"
        " author string, body_image string, body_alt string, byline string")  # fmt: skip
    told = enrich.confirmed_metadata(pages)
    assert {r.url[-1]: r.error_code for r in told.collect()} == {"1": None, "2": "article-identity-mismatch"}
    got = {r.url[-1]: r for r in enrich.apply_metadata(records, asked, told, ["program"], F.lit(T0)).collect()}
    assert (got["1"].image_url, got["1"].image_alt, got["1"].author, got["1"].metadata_checked_at) == ("https://x.org/p.jpg", "a photo", "B", T0)
    assert (got["2"].image_url, got["2"].author, got["2"].metadata_checked_at) == ("https://x.org/i.jpg", None, T0)
    assert got["3"].metadata_checked_at == T0 - dt.timedelta(days=6)


def test_recruiting_sections(spark):
    rows = [
        ("d", 0, "heading", "Hard Commits (2)", None, "2"), ("d", 1, "row", "A Player", "/player/a-player-11", None), ("d", 2, "row", "B Player", "/player/b-player-12", None),
        ("d", 3, "heading", "Enrollees (1)", None, "1"), ("d", 4, "row", "A Player", "/player/a-player-11", None), ("e", 0, "heading", "Signees (3)", None, "3"),
        ("e", 1, "row", "C", "/player/c-1", None),
    ]
    listed = recruiting.listed(spark.createDataFrame(rows, "doc string, pos int, kind string, text string, href string, declared string"), ["doc"])
    assert {(r.doc, r.pos): (r.status, r.player_id) for r in listed.collect()} == {
        ("d", 1): ("committed", "11"), ("d", 2): ("committed", "12"), ("d", 4): ("enrolled", "11"), ("e", 1): ("signed", "1")
    }
    got = {r.doc: (r.ok, r.repeated) for r in recruiting.reconciled(listed, ["doc"]).collect()}
    assert got == {"d": (True, 1), "e": (False, 0)}
