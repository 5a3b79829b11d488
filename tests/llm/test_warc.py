import base64
import hashlib

import pytest

from tidewire.llm._order import store_of
from tidewire.llm.warc import read_warc, write_warc

SCHEMA = "page_id bigint, url string, html string"


def rows(prose):
    out = [(i, f"https://x/{i}", prose(i % 40) or None) for i in range(200)]
    out += [(300, "u", "same"), (301, None, "same"), (302, "a\r\nWARC-Type: response", "same"), (302, "b", "same"), (None, "n", "same"), (None, "n", "alone é")]
    return out


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def test_round_trip(spark, prose, tmp_path):
    data = rows(prose)
    df = spark.createDataFrame([(*r, "k") for r in data], SCHEMA + ", sha string").repartition(4)
    folder = write_warc(df, f"file://{tmp_path}/a", shard_bytes=2000, roll_bytes=1500)
    got = read_warc(spark, folder).collect()
    assert sorted((r.page_id or -1, r.payload_bytes, r.payload_digest) for r in got) == sorted(
        (p or -1, len((h or "").encode()), digest(h)) for p, _, h in data
    )
    by_digest = {}
    for r in got:
        by_digest.setdefault(r.payload_digest, []).append(r)
    for group in by_digest.values():
        first = [r for r in group if r.record_type == "response"]
        assert len(first) == 1
        known = [r.page_id for r in group if r.page_id is not None]
        assert first[0].page_id == (max(known) if known else None)
        assert all(r.refers_to == first[0].page_id for r in group if r.record_type == "revisit")
    texts = {digest(h): (h or "").encode() for _, _, h in data}
    assert all(bytes(r.payload) == texts[r.payload_digest] for r in got if r.record_type == "response")


def test_same_files_for_the_same_rows(spark, prose, tmp_path):
    df = spark.createDataFrame(rows(prose), SCHEMA)
    manifests = []
    for i, n in enumerate((1, 5)):
        folder = write_warc(df.repartition(n), f"file://{tmp_path}/{i}", shard_bytes=2000, roll_bytes=1500)
        manifests.append(sorted(map(tuple, spark.read.parquet(f"{folder}/manifest").select("file", "sha256", "records").collect())))
    assert manifests[0] == manifests[1] and len(manifests[0]) > 5


def test_minimum_size_of_revisits(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "longer"), (4, "d", "longer")], SCHEMA)
    got = read_warc(spark, write_warc(df, f"file://{tmp_path}/m", min_revisit_bytes=3)).collect()
    assert {r.page_id: (r.record_type, r.refers_to) for r in got} == {
        1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)
    }


def test_damage_is_noticed_and_empty_table(spark, tmp_path):
    folder = write_warc(spark.createDataFrame([(1, "a", "xy")], SCHEMA), f"file://{tmp_path}/d")
    name = spark.read.parquet(f"{folder}/manifest").first().file
    store, path = store_of(f"{folder}/archives/{name}")
    data = store.open_input_stream(path, compression=None).read()
    with store.open_output_stream(path, compression=None) as out:
        out.write(data + b"\0" * 10)
    with pytest.raises(Exception, match="BadGzipFile|not the file|Not a gzipped"):
        read_warc(spark, folder).collect()
    assert read_warc(spark, write_warc(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/e")).count() == 0


def test_one_id_with_many_rows_is_split(spark, prose, tmp_path):
    df = spark.createDataFrame([(7, "u", prose(20)) for _ in range(200)], SCHEMA)
    folder = write_warc(df, f"file://{tmp_path}/h", shard_bytes=2000)
    assert spark.read.parquet(f"{folder}/manifest").select("shard").distinct().count() > 8
    assert read_warc(spark, folder).count() == 200
