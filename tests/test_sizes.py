"""Work that must not grow faster than its input: rows of joins, readings of a document, bounds of pages."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidewire.operators import providers
from tidewire.plans import QUERIES
from tidewire.sources import cards, navigation, parsers


def most_rows(df):
    """The most rows that an operator of the executed plan has given."""
    df.collect()
    todo, most = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(plan.plan())
        else:
            metric = plan.metrics().get("numOutputRows")
            most = max(most, metric.get().value() if metric.isDefined() else 0)
            todo += [plan.children().apply(i) for i in range(plan.children().size())]
    return most


def readings(df):
    """How often the plan reads JSON."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json")


def test_a_name_of_many_schools_is_no_product(spark):
    rows = spark.range(400)
    schools = rows.select(F.col("id").alias("school"), F.concat(F.lit("School "), F.col("id").cast("string")).alias("name"))
    names = rows.select(F.col("id").alias("school"), F.lit("Everybody").alias("alias"))
    candidates = rows.select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("slug"), F.when(F.col("id") < 3, F.concat(F.lit("school "), F.col("id").cast("string"))).otherwise("everybody").alias("name"))
    found = providers.schools_of_candidates(candidates, schools, names)
    assert sorted(map(tuple, found.collect())) == [("s0", 0), ("s1", 1), ("s2", 2)] and most_rows(found) < 5_000
    teams = rows.select(F.col("id").alias("team_id"), F.lit("Everybody").alias("location"))
    matched = providers.match_schools(schools, names, teams)
    assert {r.reason for r in matched.collect()} == {"ambiguous-provider-school-name"} and most_rows(matched) < 5_000


def test_rosters_are_read_twice(spark):
    flat = [{"id": "q", "displayName": "Q", "position": {"abbreviation": "WR"}}]
    told = {"team": {"id": "2"}, "athletes": [{"items": [{"id": "p", "displayName": "P", "position": {"abbreviation": "K"}}]}, *flat]}
    df = parsers.provider_roster(spark.createDataFrame([(2, json.dumps(told)), (3, json.dumps(told)), (2, '{"team":{"id":"2"}}')], "team_id int, text string"), ["team_id"])
    assert sorted((r.id or "", r.position or "", r.error_code or "") for r in df.collect()) == [("", "", "invalid-roster"), ("", "", "source-team-mismatch"), ("p", "K", ""), ("q", "WR", "")]
    assert readings(df) == 2


def test_a_document_is_read_once(spark):
    article = {"headline": "State wins", "description": "", "categories": [{"type": "league", "leagueId": 1}, {"type": "team", "teamId": 2}]}
    docs = [(2, 1, "H", ["State"], json.dumps({"header": h, "articles": [article, article | {"headline": "None"}]})) for h in ("H", "Other")]
    news = parsers.provider_news(spark.createDataFrame(docs, "team_id int, league_id int, header string, names array<string>, text string"), ["team_id", "league_id", "header", "names"])
    found = providers.provider_articles(news)
    assert sorted((r.title or "", r.error_code or "") for r in found.collect()) == [("", "news-identity-mismatch"), ("State wins", "")] and readings(found) == 1
    games = parsers.provider_schedule(spark.createDataFrame([(2, '{"team":{"id":"2"},"events":[]}'), (2, "{}")], "team_id int, text string"), ["team_id"])
    assert [r.error_code for r in games.collect()] == ["source-team-mismatch"] and readings(games) == 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables are not here")
def test_documents_of_a_small_file_are_made_by_many_tasks(spark):
    folder = "/root/testdata/sf0.001"
    for name in ("provider_schedules", "provider_rosters", "provider_news", "official_cards", "official_stories", "sports_of_parts"):
        assert "REPARTITION_BY_NUM" in QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString(), name


def test_an_inventory_in_parts(spark):
    def part(first, n, league_id="9"):
        teams = [{"team": {"id": str(i), "location": f"L{i}", "displayName": "D"}} for i in range(first, first + n)]
        return json.dumps({"sports": [{"slug": "football", "leagues": [{"slug": "college-football", "id": league_id, "name": "L", "teams": teams}]}]})

    def imported(*texts):
        rows = spark.createDataFrame([("football", t, None) for t in texts], "sport string, text string, error_code string")
        programs = spark.createDataFrame([("s", "L1500", "football")], "school string, name string, sport string")
        names, news = spark.createDataFrame([], "school string, alias string"), spark.createDataFrame([], "sport string, text string")
        leagues, mappings = providers.import_providers(programs, names, rows, news)
        (league,), (mapping,) = leagues.collect(), mappings.collect()
        return league.reason, league.team_count, league.duplicates, mapping.team_id

    wrong = "inventory-identity-or-size-mismatch"
    assert imported(part(0, 1000), part(999, 1000)) == (None, 1999, 1, "1500")
    assert imported(part(0, 1000), part(1000, 1, "8"))[0] == imported(part(0, 1001))[0] == wrong


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables are not here")
def test_leagues_of_many_suppliers(spark, tmp_path):
    for name in ("nation", "customer"):
        os.symlink(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet")
    suppliers = spark.range(2000).select(F.col("id").alias("s_suppkey"), F.lit("S").alias("s_name"), F.lit(0).alias("s_nationkey"))
    suppliers.write.parquet(f"{tmp_path}/supplier.parquet")
    (league,) = QUERIES["imported_leagues"](spark, str(tmp_path)).collect()
    assert (league.status, league.team_count, league.placeholders, league.duplicates) == ("verified", 2000, 1, 2000)


def test_a_menu_that_is_too_large_is_told(spark):
    link = {"title": "Golf", "url": "/g" + "x" * 1000}
    page = lambda kind, n: f"<script>var obj = {json.dumps({'type': kind, 'data': [link] * n})};</script>"
    pages = spark.createDataFrame([(1, page("main-navigation", 2500)), (2, page("stories", 2500)), (3, page("main-navigation", 1))], "id int, text string")
    assert sorted((r.id, r.error_code, r.place) for r in navigation.declared_navigation(pages, "id").collect()) == [(1, "source-format-changed", None), (3, None, [0, 0])]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables are not here")
def test_menus_of_many_customers(spark, tmp_path):
    os.symlink("/root/testdata/sf0.001/nation.parquet", tmp_path / "nation.parquet")
    segment = F.when(F.col("id") == 13_000, "BUILDING").when(F.col("id") < 7_000, "FURNITURE").otherwise("MACHINERY")
    rows = spark.range(13_001).select(F.col("id").alias("c_custkey"), F.lit(0).alias("c_nationkey"), segment.alias("c_mktsegment"), F.lit(1.0).alias("c_acctbal"))
    rows.write.parquet(f"{tmp_path}/customer.parquet")
    found = {r.program_id: r.home_url for r in QUERIES["menu_sources"](spark, str(tmp_path)).collect()}
    assert found == {1: "https://a.edu/sports/c13000", 2: "https://a.edu/sports/c7000"}


def test_a_menu_of_too_many_nodes_is_not_made(spark, tmp_path):
    small, large = 3, 4000  # a customer has an order, an order one item
    rows = spark.range(small + large).select("id", F.when(F.col("id") < small, 1).otherwise(2).alias("nation"))
    tables = {
        "customer": rows.select(F.col("id").alias("c_custkey"), F.col("nation").alias("c_nationkey"), F.lit("BUILDING").alias("c_mktsegment"), F.lit("C").alias("c_name")),
        "orders": rows.select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("2-HIGH").alias("o_orderpriority"), F.lit("F").alias("o_orderstatus")),
        "lineitem": rows.select(F.col("id").alias("l_orderkey"), F.lit(5).alias("l_partkey"), F.lit(6).alias("l_suppkey"), F.lit(1.0).alias("l_extendedprice"), F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus")),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    found = QUERIES["declared_menus"](spark, str(tmp_path))
    assert sorted((r.n_nationkey, r.error_code or r.gender) for r in found.collect()) == [(1, "mens")] * 2 * small + [(2, "source-format-changed")]
    told, todo = [], [found._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(plan.plan())
        else:
            if kind == "ArrowEvalPythonExec":
                told.append(plan.metrics().get("pythonDataSent").get().value())
            todo += [plan.children().apply(i) for i in range(plan.children().size())]
    assert told and max(told) < 20_000  # bytes of the pages that are decoded; the large nation's would be some 700,000


def _shape(node):
    """A tree as nested values; text that was read in pieces is one."""
    out = []
    for c in node.children:
        if isinstance(c, str) and out and isinstance(out[-1], str):
            out[-1] += c
        else:
            out.append(c if isinstance(c, str) else _shape(c))
    return node.tag, node.attrs, out


def test_plain_pages_have_the_same_tree():
    parts = ['<div class="a b">', "</div>", "<P>", "</p>", "text > text", " ", '<img src="/x" ALT="">', '<br />', "</none>", '<a href="/x?a<b">', "</A>", "<!doctype html>", "<script>if (a < b) f('<b>');</script>",
             "<title>A title</title>", '<li id="x"  data-x="1" id="y">', "<style>p > b {}</style>"]
    odd = ["a &amp; b", "<!-- <b>no</b> -->", "<input disabled>", "<a href=x>", "<a href='x'>", '<b title="&lt;">', "<script>a</b></script>", "<title>a <b>", "a < b", "&", "<iframe>", "<script>", '<b x="1"y="2">', "<?x?>"]
    r, plain = random.Random(3), 0
    for i in range(3000):
        page = "".join(r.choice(parts if i % 2 or r.random() < 0.9 else odd) for _ in range(r.randrange(12)))
        slow, quick = cards._Tree(), cards._plain_tree(page)
        slow.feed(page)
        assert quick is None or _shape(quick) == _shape(slow.root), page
        assert _shape(cards.tree_of(page)) == _shape(slow.root)
        plain += quick is not None
    assert plain > 1500
