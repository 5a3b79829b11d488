import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire import publish
from tidewire.functions import text
from tidewire.operators import audit, health, joins
from tidewire.plans import OPERATORS, ORACLES, QUERIES
from tidewire.sources import catalog, documents, parsers
from tidewire.streaming.upsert import merge_into

T0 = dt.datetime(2026, 1, 1)


def test_scope_of_a_run():
    assert publish.resolve_scope("schedule", "b", ["b", "a"]) == (["a", "b"], "")
    assert publish.resolve_scope("workflow_dispatch", "", ["a"]) == (["a"], "") and publish.resolve_scope("workflow_dispatch", "a", ["a", "b"]) == (["a"], "a")
    for bad in (("push", "all"), ("workflow_dispatch", "c")):
        with pytest.raises(ValueError):
            publish.resolve_scope(*bad, ["a"])


def test_context_of_a_publication():
    good = {"GITHUB_ACTIONS": "true", "GITHUB_REPOSITORY": "o/r", "GITHUB_REF": "refs/heads/main", "GITHUB_EVENT_NAME": "schedule",
            "GITHUB_WORKFLOW_REF": "o/r/.github/workflows/maintainers.yml@refs/heads/main", "GITHUB_SHA": "a" * 40, "GITHUB_TOKEN": "t"}
    publish.assert_publish_context(good, "o/r")
    for name in good:
        with pytest.raises(ValueError, match=name if name != "GITHUB_TOKEN" else "token"):
            publish.assert_publish_context(good | {name: ""}, "o/r")


def test_ordinary_files(tmp_path):
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "empty").write_text("")
    (tmp_path / "link").symlink_to(tmp_path / "a.json")
    assert publish.regular_file(str(tmp_path), "a.json") == b"{}"
    for name in ("empty", "link", "../x", "none"):
        with pytest.raises((ValueError, OSError)):
            publish.regular_file(str(tmp_path), name)


RECORD = "program string, pos bigint, url string, title string, published_at timestamp, image_url string, image_alt string, author string, metadata_checked_at timestamp"


def test_a_batch_that_is_run_again_does_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    rows = lambda n: spark.createDataFrame([("p", n, f"https://x.org/{n}", f"t{n}", T0, None, None, None, None)], RECORD)
    first = merge_into(spark, root, rows(1), ["program"], 0)
    assert merge_into(spark, root, rows(2), ["program"], 0) == first and publish.published_batch(publish.Store(spark, root)) == 0
    assert merge_into(spark, root, rows(2), ["program"], 1) != first
    assert {r.url[-1] for r in publish.read_version(spark, root, "articles").collect()} == {"1", "2"}


def test_registries_of_another_version_are_refused(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"schemaVersion": 2, "a": "x"}))
    with pytest.raises(ValueError):
        catalog.registry(spark, f"file://{tmp_path}/r.json", T.StructType([T.StructField("a", T.StringType())]))


def test_general_entries_are_few(spark, monkeypatch):
    monkeypatch.setattr(joins, "MAX_GENERAL", 2)
    left, right = spark.createDataFrame([("a",)], "k string"), spark.createDataFrame([(None, i) for i in range(3)], "k string, v int")
    with pytest.raises(ValueError):
        joins.wildcard_join(left, right, ["k"])
    assert joins.wildcard_join(left, right.where("v < 2"), ["k"]).count() == 2


def test_plans_have_no_nested_loops(spark, tmp_path):
    left = spark.createDataFrame([("a", "x")], "s string, p string")
    right = spark.createDataFrame([(None, None, 1), ("a", None, 2)], "s string, p string, i int")
    report = health.health_report(spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1, ["x"], [], 3)], "k int, issues array<string>, warnings array<string>, articles int"), "k")
    for df in (joins.wildcard_join(left, right, ["s", "p"]), report):
        assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()


def test_nested_values(spark):
    rows = spark.createDataFrame([(1, {"golf": [{"url": "http://a", "title": "ok"}]}), (2, {"golf": [{"url": "https://a.org/", "title": "<b>"}, {"url": None, "title": None}]})],
                                 "id int, sports map<string, array<struct<url: string, title: string>>>")
    assert sorted(map(tuple, audit.public_value_violations(rows, "id", ["sports"]).collect())) == [("1", "url", "unsafe-url"), ("2", "title", "unsafe-text")]


def test_oversized_documents_are_rejected(spark):
    scalar = '<script id="__NUXT_DATA__">' + json.dumps([{"storyHeadline": 1, "storyPath": 2}, "x" * 5000, "/p"]) + "</script>"
    with pytest.raises(parsers.SourceError):
        list(parsers.official_stories(scalar, {}))
    game = {"id": "e", "date": "2026-01-01T00:00Z", "competitions": [{"competitors": [{"id": "2"}, {"id": "3", "team": {"displayName": "T"}}]}]}
    df = spark.createDataFrame([(json.dumps({"team": {"id": "2"}, "events": [game] * 401}), 2)], "text string, team_id bigint")
    assert [r.error_code for r in parsers.provider_schedule(df, ["team_id"]).collect()] == ["invalid-schedule"]


def test_programming_errors_are_raised(spark):
    def broken(page, context):
        raise NameError("no such name")

    df = spark.createDataFrame([("x",)], "text string").withColumn("k", F.lit(1))
    with pytest.raises(Exception, match="no such name"):
        parsers.parse(df, broken, parsers.LOC_ROW, ["k"]).collect()


def test_brotli_and_folding(spark):
    df = spark.createDataFrame([("é" * 100,)], "t string").select(documents.encoded_body(F.col("t"), F.lit("br")).alias("b"))
    assert df.select(documents.decode_body(F.col("b"), F.lit("br"), 500).alias("d")).first().d.text == "é" * 100
    assert df.select(documents.decode_body(F.col("b"), F.lit("br"), 100).alias("d")).first().d.error == "response-too-large"
    assert [r[0] for r in spark.createDataFrame([("abc",), ("é",), (None,)], "t string").select(text.fold(F.col("t"))).collect()] == ["abc", "e", None]


def test_every_query_names_its_operators():
    assert set(OPERATORS) >= set(QUERIES) and set(ORACLES) == set(QUERIES)
    assert all(OPERATORS[q] for q in QUERIES)
