import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewire.functions import dates, sports, text, urls
from tidewire.operators.classify import MAX_NAMES, mentions_of, recruit_headline


def one(spark, column, *values):
    """The column applied to each value of ``v``."""
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(column.alias("x")).collect()]


def test_clean_text(spark):
    got = one(spark, text.clean_text(F.col("v"), 20), None, " a <b>b</b>\u00a0\n c ", "x" * 30, "1 < 2 > 0", "a\x00b")
    assert got == ["", "a b c", "x" * 20, "1 0", "a b"]


def test_stable_id_keeps_empty_parts(spark):
    import hashlib

    df = spark.createDataFrame([("a", None, "c")], "a string, b string, c string")
    got = df.select(text.stable_id(F.col("a"), F.col("b"), F.col("c"))).first()[0]
    assert got == hashlib.sha256(b"a||c").hexdigest()[:24]


@pytest.mark.parametrize(
    "value, bad",
    [
        ("ghp_" + "a" * 36, True), ("Bearer abcdefghijklmnopqrstuvwxyz", True), ("C:\\Users\\me", True), ("/home/me/x", True),
        ("AKIA" + "A" * 16, True), ("a quiet line", False), ("/homely/path", False), (None, False),
    ],
)
def test_credentials(spark, value, bad):
    assert one(spark, text.has_credential(F.col("v")), value) == [bad]


def test_slug_and_names(spark):
    assert one(spark, text.slugify(F.col("v")), "São  José & Co.'s") == ["sao-jose-and-co-s"]
    assert one(spark, text.school_name_key(text.fold(F.col("v"))), "The University of Évora") == ["evora"]
    assert one(spark, text.clean_author(F.col("v")), "By: A. Writer", "null", None, "  ") == ["A. Writer", None, None, None]
    assert one(spark, text.plain(F.col("v")), "<p>a<script>x<y</script> b &amp; c</p>") == ["a b & c"]
    assert one(spark, text.cell(F.col("v")), "a|b & <c>\nd") == ["a\\|b &amp; &lt;c&gt; d"]


@pytest.mark.parametrize(
    "url, safe",
    [
        ("https://A.Example.com", "https://a.example.com/"), ("https://a.example.com:443/x?y=1#z", "https://a.example.com/x?y=1#z"),
        ("http://a.example.com/", None), ("https://u:p@a.example.com/", None), ("https://a.example.com:8443/", None), ("https://127.0.0.1/", None),
        ("https://localhost/", None), ("https://x.internal/", None), ("https://a.example.com/?api_key=1", None),
        ("https://a.example.com/?b=1&X-Amz-Date=2", None), ("https://a.example.com/?tokens=1", "https://a.example.com/?tokens=1"),
        ("https://a.example.com/a b", None), (None, None), ("https://a.example.com/" + "x" * 2048, None),
    ],
)
def test_safe_url(spark, url, safe):
    assert one(spark, urls.safe_url(F.col("v")), url) == [safe]


def test_url_keys(spark):
    u = "https://www.x.org/a/?utm_source=f&b=1&fbclid=2&c&mc_cid=3#top"
    assert one(spark, urls.canonical_url(F.col("v")), u) == ["https://www.x.org/a/?b=1&c"]
    assert one(spark, urls.article_identity(F.col("v")), "https://www.x.org/a/?utm_x=f") == ["https://x.org/a"]
    assert one(spark, urls.resolve_url(F.col("v"), F.lit("https://x.org/a/b")), "../c?d=1", "//y.org/z", "javascript:x") == [
        "https://x.org/c?d=1", "https://y.org/z", None
    ]
    assert one(spark, urls.host_of(F.col("v")), "https://WWW.x.org:443/a") == ["x.org"]
    assert one(spark, urls.sport_route(F.col("v")), "https://x.org/sports/mens-golf/roster", "https://x.org/") == ["mens-golf", None]


def test_dates(spark):
    at = lambda c: F.struct(dates.iso(c["at"]).alias("a"), c["precision"].alias("p"))
    got = one(
        spark, at(dates.publication_date(F.col("v"))), "Wed, 16 Sep 2026 12:00:00 GMT", "Wed, 16 Sep 2026 12:00:00 +0200",
        "2026-09-16T12:00:00Z", "2026-09-16T12:00:00+02:00", "2026-09-16T12:00:00", "16 Sep 2026", None,
    )
    assert [tuple(g) for g in got] == [
        ("2026-09-16T12:00:00.000Z", "instant"), ("2026-09-16T10:00:00.000Z", "instant"), ("2026-09-16T12:00:00.000Z", "instant"),
        ("2026-09-16T10:00:00.000Z", "instant"), (None, "unknown"), (None, "unknown"), (None, "unknown"),
    ]
    got = one(spark, at(dates.date_value(F.col("v"))), "9/6/2026", "September 6, 2026", "Sep 6, 2026", "2026-02-30", "2026-09-06", "soon")
    assert [tuple(g) for g in got] == [("2026-09-06T00:00:00.000Z", "day")] * 3 + [(None, "unknown"), ("2026-09-06T00:00:00.000Z", "day"), (None, "unknown")]


def test_limits_of_time(spark):
    now = F.lit(dt.datetime(2026, 1, 2))
    age = lambda **k: F.lit(dt.datetime(2026, 1, 2) + dt.timedelta(**k))
    row = spark.range(1).select(
        dates.not_future(age(days=1), now), dates.not_future(age(days=1, milliseconds=1), now), dates.not_future(F.lit(None).cast("timestamp"), now),
        dates.recruiting_cycle(F.lit(dt.datetime(2026, 2, 28))), dates.recruiting_cycle(F.lit(dt.datetime(2026, 3, 1))), dates.age_hours(age(hours=-12), now),
    ).first()
    assert tuple(row) == (True, False, True, 2026, 2027, 12.0)


def test_numbers(spark):
    assert one(spark, dates.score(F.col("v")), "0", "999", "1000", "-1", "x") == [0.0, 999.0, None, None, None]
    assert one(spark, dates.optional_number(F.col("v"), 100), "NA", "nr", "5", "0", "101", "4.5") == [None, None, 5.0, None, None, 4.5]
    assert one(spark, dates.season(F.col("v")), "2025-26 Roster", "none") == ["2025-26", None]


@pytest.mark.parametrize(
    "label, normal",
    [
        ("Basketball (W)", "womens basketball"), ("Soccer - Men's", "mens soccer"), ("Women’s Golf", "womens golf"), ("Track & Field", "track and field"),
        ("cross-country-women", "womens cross country"), ("Mens Rowing Heavy", "mens heavyweight rowing"), ("Rowing Lightweight", "lightweight rowing"),
        ("x" * 201, ""), (None, ""),
    ],
)
def test_labels(spark, label, normal):
    assert one(spark, sports.normal_label(F.col("v")), label) == [normal]


def test_aliases_and_routes(spark):
    programs = spark.createDataFrame(
        [(1, "womens-basketball", "Women's Basketball", "WBB", "women"), (2, "football", "Football", "MFB", "men"), (3, "mens-indoor-track", "Men's Indoor Track", "MTI", "men")],
        "program_id int, slug string, name string, code string, gender string",
    )
    rows = {(r.program_id, r.alias) for r in sports.alias_rows(programs).collect()}
    assert {(1, "wbball"), (1, "wbb"), (1, "w baskbl"), (1, "womens basketball"), (2, "football"), (2, "fb"), (2, "m footbl"), (3, "mens track"), (3, "mitrack")} <= rows
    assert (1, "basketball") not in rows
    labels = spark.createDataFrame([("WBB",), ("Hoops (W Baskbl)",), ("Nothing",)], "label string")
    found = {(r.label, r.program_id) for r in sports.match_labels(labels, sports.alias_rows(programs)).collect()}
    assert found == {("WBB", 1), ("Hoops (W Baskbl)", 1)}
    assert one(spark, sports.route_slugs(F.col("v")), "https://x.org/news/2026/1/2/football-wins.aspx?path=football") == [["football-wins", "football"]]


NAMES = [("arizona", "a"), ("arizona state", "s"), ("state", "x"), ("state", "y"), ("usc", "u"), ("ab", "t")]


@pytest.mark.parametrize("most", [100, 1])
def test_longest_names_win(spark, most):
    mentions = mentions_of(spark.createDataFrame(NAMES, "alias string, owner string"), most)
    texts = ["arizona state beats usc", "arizona state visits arizona", "state", None, "", "ab arizona arizona", "arizonastate"]
    assert one(spark, mentions(F.col("v")), *texts) == [["s"], ["s", "a"], [], [], [], ["a"], []]


def test_parts_of_a_dictionary_do_not_show(spark, monkeypatch):
    r = random.Random(3)
    words = [f"{a}{b}{c}" for a in "abcd" for b in "xyz" for c in "rst"]
    names = [(" ".join(r.choice(words) for _ in range(r.randrange(1, 4))), f"o{r.randrange(90)}", r.random() < 0.7) for _ in range(400)]
    df = spark.createDataFrame(names, "alias string, owner string, strong boolean")
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(60))) for _ in range(80)]
    whole, parts = (one(spark, mentions_of(df, most)(F.col("v")), *texts) for most in (10_000, 37))
    assert whole == parts and sum(map(len, whole)) > 100


def test_a_dictionary_above_the_bound(spark):
    names = spark.range(MAX_NAMES + 1).select(F.concat(F.lit("name "), F.col("id").cast("string")).alias("alias"), F.concat(F.lit("o"), F.col("id").cast("string")).alias("owner"))
    assert one(spark, mentions_of(names)(F.col("v")), f"name 7 meets name {MAX_NAMES} and name 20000x") == [[f"o{MAX_NAMES}", "o7"]]


def test_recruit_headlines(spark):
    got = one(spark, recruit_headline(F.col("v")), "Team signs two", "The designs", "Coach adds five to roster", "Club welcomes big class", "Assigned")
    assert got == [True, False, True, True, False]
