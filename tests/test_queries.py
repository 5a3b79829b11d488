"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from tidewire.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else f"{value:.9g}"
    return "null" if value is None else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    rows = sorted(tuple(map(plain, r)) for r in got.select(*columns).collect())
    answer = duck.sql(ORACLES[name])
    assert sorted(answer.columns) == columns
    assert rows == sorted(tuple(map(plain, r)) for r in answer.select(*(f'"{c}"' for c in columns)).fetchall())


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_whole_texts_are_read(spark, tmp_path):
    texts = {3: "word " * 40 + "Ann signs today", 7: "word " * 40 + "Ann sings today"}
    rows = [(i, x, "en") for i, x in texts.items()]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [r.doc_id for r in QUERIES["recruit_headline_whole"](spark, str(tmp_path)).collect()] == [3]
    assert {r.doc_id: r.title for r in QUERIES["feed_items_whole"](spark, str(tmp_path)).collect()} == texts


def test_feed_items_of_odd_documents(spark, tmp_path):
    texts = ["", " ", "#!? \n", None, "Ann", "Ann", "Ann", "Ann", "long " * 500_000 + "end", " Ann!\u00a0"]
    langs = ["en", "en", "en", "en", None, "", "a<b>&\"c'", " \ten", "en", "en"]
    rows = [(i, x, lang) for i, (x, lang) in enumerate(zip(texts, langs, strict=True))] + [(None, "Ann", "en")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = QUERIES["feed_items_whole"](spark, str(tmp_path))
    answer = con.sql(ORACLES["feed_items_whole"])
    assert sorted(map(repr, map(tuple, got.select(answer.columns).collect()))) == sorted(map(repr, answer.fetchall()))
    assert len(answer.fetchall()) == len(rows)
