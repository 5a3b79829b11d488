import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidewire.sources import snapshot_files

SCHEMA = "conference string, school string, body string"


def written(root):
    return {str(p.relative_to(root)) for p in root.rglob("*") if p.is_file()}


def save(df, root, **options):
    snapshot_files.register(df.sparkSession)
    df.write.format(snapshot_files.FORMAT).mode("append").options(**options).save(f"file://{root}")


def test_a_file_per_school_and_a_manifest_per_conference(spark, tmp_path):
    rows = [(f"c{i % 3}", f"s-{i}", json.dumps({"school": i, "text": "é"})) for i in range(20)]
    save(spark.createDataFrame(rows, SCHEMA).repartition(4), tmp_path, generatedAt="2026-01-01T00:00:00.000Z", academicYear="2025-26")
    assert written(tmp_path) == {f"v1/conferences/{c}/schools/{s}.json" for c, s, _ in rows} | {f"v1/conferences/c{i}/manifest.json" for i in range(3)}
    for i in range(3):
        folder = tmp_path / f"v1/conferences/c{i}"
        told = json.loads((folder / "manifest.json").read_text())
        assert told["generatedAt"] == "2026-01-01T00:00:00.000Z" and [s["slug"] for s in told["schools"]] == sorted(s for c, s, _ in rows if c == f"c{i}")
        for s in told["schools"]:
            data = (folder / s["path"]).read_bytes()
            assert (hashlib.sha256(data).hexdigest(), len(data)) == (s["sha256"], s["bytes"])
    # a later run replaces its own files and no others
    save(spark.createDataFrame([("c0", "s-0", "{}")], SCHEMA), tmp_path)
    assert (tmp_path / "v1/conferences/c0/schools/s-0.json").read_text() == "{}" and len(written(tmp_path)) == 23


@pytest.mark.parametrize("bad", [("c0", "s-1", "{}"), ("c0", "Bad Slug", "{}"), ("..", "s", "{}"), ("c0", "s", ""), ("c0", None, "{}"), (None, "s", "{}")])
def test_a_failed_run_leaves_nothing(spark, tmp_path, bad):
    df = spark.createDataFrame([("c0", f"s-{i}", "{}") for i in range(8)] + [bad], SCHEMA).repartition(3)
    with pytest.raises(Exception, match="slug|two rows|bytes"):
        save(df, tmp_path)
    # a task that is still being stopped may write to the run's own folder, which nobody reads
    assert {p for p in written(tmp_path) if not p.startswith(".run-")} == set()


def test_a_task_that_is_lost(spark, tmp_path):
    """What an attempt has written that never commits is not moved."""
    writer = snapshot_files.SnapshotFiles({"path": f"file://{tmp_path}"}).writer(spark.createDataFrame([], SCHEMA).schema, False)
    lost = writer.write(iter([("c", "a", "{}"), ("c", "b", "{}")]))
    again = writer.write(iter([("c", "a", "{}"), ("c", "b", "{}")]))
    assert len(lost.files) == 2 and all("/." in f"/{p}" for p in written(tmp_path))
    writer.commit([again, None])
    assert written(tmp_path) == {"v1/conferences/c/schools/a.json", "v1/conferences/c/schools/b.json", "v1/conferences/c/manifest.json"}


def test_previews(spark, tmp_path):
    df = spark.createDataFrame([("s", "golf", "{}"), ("s", None, "[]")], "school string, sport string, body string")
    save(df, tmp_path, preview="true")
    assert written(tmp_path) == {"preview/s/golf.json", "preview/s/all-sports.json"}
    with pytest.raises(Exception, match="append"):
        df.write.format(snapshot_files.FORMAT).mode("overwrite").save(f"file://{tmp_path}")
    with pytest.raises(Exception, match="conference"):
        save(df.withColumn("x", F.lit(1)), tmp_path)
