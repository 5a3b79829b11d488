import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewire import publish
from tidewire.plans.refresh import refresh_news
from tidewire.streaming.upsert import start, windowed_counts

T0 = dt.datetime(2026, 1, 1)


def files_of(root):
    return sum(1 for _ in Path(root.removeprefix("file://"), "versions").rglob("*.parquet"))


def test_versions_and_conflicts(spark, tmp_path):
    root = f"file://{tmp_path}/p"
    a = spark.createDataFrame([("c", 1), ("d", 2), (None, 3), ("c d/é=", 4)], "conference string, n int")
    rows = lambda v=None: sorted((str(r.conference), r.n) for r in publish.read_version(spark, root, "t", v).collect())
    first = publish.publish(spark, root, {"t": a}, None)
    assert rows() == [("None", 3), ("c", 1), ("c d/é=", 4), ("d", 2)]
    files = files_of(root)
    assert publish.publish(spark, root, {"t": a.orderBy("n", ascending=False)}, first) == first and files_of(root) == files
    # one conference is published: the others stay, and only its part is written
    second = publish.publish(spark, root, {"t": spark.createDataFrame([("c", 5), ("d", 2)], "conference string, n int")}, first)
    assert second != first and rows() == [("None", 3), ("c", 5), ("c d/é=", 4), ("d", 2)] and rows(first)[1] == ("c", 1)
    assert files_of(root) == files + 1
    assert publish.publish(spark, root, {"t": a.where("n = 2")}, second) == second
    assert publish.publish(spark, root, {"t": a.limit(0)}, second) == second
    with pytest.raises(publish.Conflict):
        publish.publish(spark, root, {"t": a}, first)
    third = publish.publish(spark, root, {"u": a.drop("conference").limit(0)}, second, without={"t": ["c", None]})
    assert rows() == [("c d/é=", 4), ("d", 2)] and rows(second)[1] == ("c", 5)
    assert publish.read_version(spark, root, "u").columns == ["n"] and publish.read_version(spark, root, "u").count() == 0
    publish.publish(spark, root, {"u": a.drop("conference"), "v": a.limit(0)}, third)
    assert publish.read_version(spark, root, "u").count() == 4 and publish.read_version(spark, root, "v").count() == 0


def test_lock(spark, tmp_path):
    store = publish.Store(spark, f"file://{tmp_path}/p")
    with publish.Lock(store), pytest.raises(publish.Conflict), publish.Lock(store):
        pass
    with publish.Lock(store):
        pass


def test_manifest(spark):
    files = spark.createDataFrame([("c", "a", "{}\n"), ("c", "b", "[]\n")], "conference string, slug string, body string")
    rows = publish.manifest(files, "conference", "slug", "body")
    there = rows.select("path").withColumn("body", F.when(F.col("path").contains("/a."), "{}\n").otherwise("[1]\n"))
    more = spark.createDataFrame([("extra", "x")], "path string, body string")
    got = sorted(map(tuple, publish.manifest_violations(rows, there.unionByName(more)).collect()))
    b = "v1/conferences/c/schools/b.json"
    assert [g for g in got if g[0] != "extra"] == [(b, "digest"), (b, "length")] and ("extra", "listed") in got


def test_scope(spark):
    df = spark.createDataFrame([("c", "a", "golf"), ("c", "b", "golf")], "conference string, school string, sport string")
    assert df.where(publish.scope(school="a", sport="golf")).count() == 1 and df.where(publish.scope(everything=True)).count() == 2
    for bad in ({}, {"conference": "c", "school": "a"}, {"sport": "golf", "everything": True}, {"school": "A b"}):
        with pytest.raises(ValueError):
            publish.scope(**bad)


FIELDS = (
    "school string, sport string, source_url string, pos bigint, url string, title string, published_at timestamp, published_at_precision string,"
    " publisher string, image_url string, image_alt string, author string, metadata_checked_at timestamp"
)


def article(source, pos, n, at=T0, image=None):
    return ("s", "golf", source, pos, f"https://x.org/{n}", f"title {n}", at, "instant", "p", image, None, None, None)


def test_refresh(spark):
    now = T0 + dt.timedelta(days=1)
    sources = spark.createDataFrame(
        [("s", "golf", "u1", 0, None, False), ("s", "golf", "u2", 1, "timeout", None), ("s", "golf", "u3", 2, "http-404", None), ("s", "golf", "u4", 3, None, False)],
        "school string, sport string, source_url string, source_order int, error string, empty_confirmed boolean",
    )
    fetched = spark.createDataFrame([article("u1", 0, 1, image="https://x.org/i.jpg"), article("u1", 1, 2), article("u1", 2, 9, T0 + dt.timedelta(days=5))], FIELDS)
    prior = spark.createDataFrame([article("u1", 0, 5), article("u2", 0, 1), article("u2", 1, 6), article("u4", 0, 7)], FIELDS)
    before = spark.createDataFrame([("s", "golf", u, T0, n) for u, n in (("u1", 1), ("u2", 2), ("u4", 1))],
                                   "school string, sport string, source_url string, last_success_at timestamp, record_count int")
    articles, states, program = refresh_news(sources, fetched, prior, before, F.lit(now))
    got = {r.source_url: (r.status, r.reason, r.record_count) for r in states.collect()}
    assert got == {
        "u1": ("ok", "future-article-dates-filtered", 3), "u2": ("stale", "timeout", 2), "u3": ("unavailable", "http-404", 0), "u4": ("stale", "unexpected-empty-source", 1)
    }
    rows = {r.url[-1]: r for r in articles.collect()}
    assert sorted(rows) == ["1", "2", "5", "6", "7"]
    assert rows["1"].image_url == "https://x.org/i.jpg" and rows["1"].discovery_source_url == "u2"
    (p,) = program.collect()
    assert (p.status, p.last_success_at, p.source_url, p.n_records) == ("stale", T0, "u1", 5)


RECORD = "program string, pos bigint, url string, title string, published_at timestamp, image_url string, image_alt string, author string, metadata_checked_at timestamp"


def test_stream_folds_into_versions(spark, tmp_path):
    source, root = f"{tmp_path}/in", f"file://{tmp_path}/out"
    row = lambda pos, n, author=None: ("p", pos, f"https://x.org/{n}", f"t{n}", T0, None, None, author, None)
    for i, rows in enumerate(([row(0, 1, "A"), row(1, 2)], [row(0, 1), row(1, 3)])):
        spark.createDataFrame(rows, RECORD).write.mode("append").parquet(source)
        stream = spark.readStream.schema(RECORD).parquet(source)
        start(stream, root, ["program"], f"{tmp_path}/checkpoint").awaitTermination()
        got = {r.url[-1]: r.author for r in publish.read_version(spark, root, "articles").collect()}
        assert got == ({"1": "A", "2": None} if i == 0 else {"1": "A", "2": None, "3": None})


def test_windowed_counts(spark, tmp_path):
    spark.createDataFrame([(T0, "a"), (T0 + dt.timedelta(minutes=5), "a"), (T0 + dt.timedelta(hours=2), "b")], "ts timestamp, event_type string").write.parquet(f"{tmp_path}/e")
    counts = windowed_counts(spark.readStream.schema("ts timestamp, event_type string").parquet(f"{tmp_path}/e"))
    counts.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.event_type, r.n) for r in spark.table("counted").collect()) == [("a", 2), ("b", 1)]
