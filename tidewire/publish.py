"""Publication: versioned folders, manifests with digests, and one pointer that moves only from its expected place."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds of what is published.
MAX_FILE, MAX_BUNDLE = 16 << 20, 128 << 20
PREVIEW = "preview"
_SHA = r"^[0-9a-f]{64}$"


class Conflict(Exception):
    """Somebody else published in between."""


class Store:
    """Small files beside the data, in any store that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(self.root)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def read(self, name: str) -> str | None:
        at = self._at(name)
        if not self.fs.exists(at):
            return None
        stream = self.fs.open(at)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file that must not exist yet; False if it does."""
        at = self._at(name)
        try:
            out = self.fs.create(at, False)
        except Exception as e:
            if self.fs.exists(at):
                return False
            raise e
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


class Lock:
    """An exclusive lock for a run's output."""

    def __init__(self, store: Store, name: str = "run.lock"):
        self.store, self.name = store, name

    def __enter__(self):
        if not self.store.create(self.name, uuid.uuid4().hex):
            raise Conflict("another run holds the lock")
        return self

    def __exit__(self, *_):
        self.store.delete(self.name)


def manifest(files: DataFrame, conference: str, name: str, body: str) -> DataFrame:
    """Path, digest and length of each file's body, in order of the path."""
    return files.select(
        F.col(conference).alias("conference"), F.col(name).alias("slug"),
        F.concat(F.lit("v1/conferences/"), F.col(conference), F.lit("/schools/"), F.col(name), F.lit(".json")).alias("path"),
        F.sha2(F.col(body).cast("binary"), 256).alias("sha256"), F.octet_length(body).cast("bigint").alias("bytes"),
    ).orderBy("path")


def manifest_violations(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Broken rules of a manifest (X6, X9, K10, A20): key, rule.  expected: path, and the body that is published."""
    told = rows.join(expected, "path", "full_outer")
    rules: dict[str, Column] = {
        "listed": F.col("sha256").isNotNull(),
        "present": F.col("body").isNotNull(),
        "digest-form": F.col("sha256").rlike(_SHA),
        "digest": F.col("sha256") == F.sha2(F.col("body").cast("binary"), 256),
        "length": F.col("bytes") == F.octet_length("body"),
        "file-size": F.col("bytes") <= MAX_FILE,
    }
    from tidewire.operators.health import violations

    out = violations(told, "path", rules)
    size = rows.groupBy("conference").agg(F.sum("bytes").alias("total")).where(F.col("total") > MAX_BUNDLE)
    return out.unionByName(size.select(F.col("conference").alias("key"), F.lit("bundle-size").alias("rule")))


def current_version(store: Store) -> str | None:
    """The version that the newest pointer names."""
    n = _pointer(store)
    return json.loads(store.read(f"pointers/{n:08d}"))["version"] if n else None


def _pointer(store: Store) -> int:
    """The number of the newest pointer: one listing of their folder."""
    at = store._at("pointers")
    if not store.fs.exists(at):
        return 0
    return max((int(f.getPath().getName()) for f in store.fs.listStatus(at) if f.getPath().getName().isdigit()), default=0)


def published_batch(store: Store) -> int:
    """The number of the last batch of a stream that is published, or -1."""
    n = _pointer(store)
    told = json.loads(store.read(f"pointers/{n:08d}")).get("batch") if n else None
    return -1 if told is None else told


def publish(
    spark: SparkSession, root: str, tables: dict[str, DataFrame], parent: str | None, partition: str = "conference", batch: int | None = None,
    without: dict[str, list] | None = None,
) -> str:
    """Publish tables on top of the version ``parent`` and point to the result, if ``parent`` is still the current one.

    A version is a list of parts, each written by it or by an earlier one: a part is the rows of a table with one value of
    ``partition``, or the whole table if it lacks that column.  Parts that are not published stay as they are, those in ``without`` (the
    values by table) go, and a part with the rows it has had is not written anew.  If nothing is left to change there is no new version.

    Pointers are numbered files that are created exclusively, so of two publishers with the same parent
    one fails with ``Conflict`` and nothing of its version is ever read.
    """
    store = Store(spark, root)
    n = _pointer(store)
    if current_version(store) != parent:
        raise Conflict(f"the current version is not {parent}")
    version = uuid.uuid4().hex
    old = parts_of(store, parent) if parent else {}
    parts = {name: dict(told) for name, told in old.items()}
    for name, df in tables.items():
        path = f"versions/{version}/{name}"
        whole = partition not in df.columns
        value = F.lit(None).cast("string") if whole else F.col(partition).cast("string")
        key = F.lit(WHOLE) if whole else F.concat(F.lit("p"), F.sha2(F.coalesce(F.concat(F.lit("="), value), F.lit("")), 256))
        df.withColumn(_PART, key).write.partitionBy(_PART).parquet(f"{root}/{path}")
        kept = parts.setdefault(name, {})
        if store.fs.globStatus(store._at(f"{path}/*/*.parquet")):
            kept.pop(WHOLE, None)
            written = _digests(spark.read.parquet(f"{root}/{path}"), df.columns, None if whole else partition)
        elif whole or not kept:  # a table without rows still has its columns
            df.limit(0).write.parquet(f"{root}/{path}/{_PART}={WHOLE}")
            written = [{"part": WHOLE, "value": None, "digest": ["0"]}]
        else:
            written = []
        for part in written:
            at = f"{path}/{_PART}={part['part']}"
            if old.get(name, {}).get(part["part"], {}).get("digest") == part["digest"]:
                kept[part["part"]] = old[name][part["part"]]
                store.delete(at)
            else:
                kept[part["part"]] = {"value": part["value"], "path": at, "digest": part["digest"]}
    for name, values in (without or {}).items():
        gone = {None if v is None else str(v) for v in values}
        parts[name] = {k: p for k, p in parts[name].items() if p["value"] not in gone}
    if parent is not None and batch is None and parts == old:
        store.delete(f"versions/{version}")
        return parent
    store.create(f"versions/{version}/parts.json", json.dumps(parts))
    if not store.create(f"pointers/{n + 1:08d}", json.dumps({"version": version, "parent": parent, "batch": batch})):
        raise Conflict("another publisher was faster")
    return version


#: The folder column of a part, and the part that is a whole table.
_PART, WHOLE = "__part", "whole"


def parts_of(store: Store, version: str) -> dict[str, dict[str, dict]]:
    """The parts of a version by table: value, path below the root, digest.  There are as many as values of the partition column."""
    return json.loads(store.read(f"versions/{version}/parts.json"))


def _digests(written: DataFrame, columns: list[str], partition: str | None) -> list[dict]:
    """A digest of each part's rows that does not depend on their order: count and two sums of hashes."""
    hashed = [F.col(f"`{c}`") for c in sorted(columns)]
    sums = [F.sum(F.xxhash64(*hashed, F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in (0, 1)]
    value = F.lit(None).cast("string") if partition is None else F.first(F.col(partition).cast("string"))
    rows = written.groupBy(_PART).agg(F.count("*").alias("n"), *sums, value.alias("value")).collect()
    return [{"part": r[_PART], "value": r["value"], "digest": [str(r["n"]), str(r["s0"]), str(r["s1"])]} for r in rows]


def read_version(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """A table of a pinned version, or of the current one (S12): one scan of its parts, whichever versions wrote them."""
    store = Store(spark, root)
    parts = parts_of(store, version or current_version(store))[name]
    return spark.read.parquet(*(f"{root}/{p['path']}" for p in parts.values()))


def consumer_view(articles: DataFrame, states: DataFrame, now: Column, keys: list[str], max_age_hours: float = 12) -> DataFrame:
    """Articles with ``fresh``: the program's news is ok or empty and was seen lately."""
    from tidewire.functions.dates import age_hours

    fresh = F.col("status").isin("ok", "empty") & F.coalesce(age_hours(F.col("last_success_at"), now) <= max_age_hours, F.lit(False))
    return articles.join(states.select(*keys, fresh.alias("fresh")), keys, "left")


def markdown_lines(rows: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """A table as the lines of a report (X10): line (from 0, the two of the head first), text."""
    from tidewire.functions.text import cell
    from tidewire.operators.packing import running

    texts = [cell(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]
    text = F.concat(F.lit("| "), F.concat_ws(" | ", *texts), F.lit(" |"))
    body = running(rows.select(*order, text.alias("text")), order, {"line": F.lit(1)}).select((F.col("line") + 1).cast("int").alias("line"), "text")
    head = rows.sparkSession.createDataFrame([(0, f"| {' | '.join(columns)} |"), (1, f"|{'---|' * len(columns)}")], "line int, text string")
    return head.unionByName(body)


#: A report is for people: the driver makes one of this many rows at most.
MAX_REPORT = 10_000


def markdown(rows: DataFrame, columns: list[str], order: list[str]) -> str:
    """The report as one text; a larger one is written as its lines."""
    lines = markdown_lines(rows, columns, order).orderBy("line").limit(MAX_REPORT + 1).collect()
    if len(lines) > MAX_REPORT:
        raise ValueError("too many rows for one report")
    return "".join(r["text"] + "\n" for r in lines)


def scope(conference: str | None = None, school: str | None = None, sport: str | None = None, everything: bool = False) -> Column:
    """The rows that a run is for: all, one conference or one school, and with a school one sport."""
    if sum(map(bool, (everything, conference, school))) != 1 or (sport and not school):
        raise ValueError("choose all, one conference, or one school with or without a sport")
    out = F.lit(True)
    for column, value in (("conference", conference), ("school", school), ("sport", sport)):
        if value:
            if not re.fullmatch(r"[a-z0-9]+(?:-[a-z0-9]+)*", value):
                raise ValueError(f"not a slug: {value}")
            out &= F.col(column) == value
    return out


def resolve_scope(event: str, requested: str | None, conferences: list[str]) -> tuple[list[str], str]:
    """The conferences of a run and its selector (C6, R34): a schedule is for all, a manual run for all or one known conference."""
    if event not in ("schedule", "workflow_dispatch"):
        raise ValueError("unsupported event")
    if event == "schedule" or requested in (None, "", "all"):
        return sorted(conferences), ""
    if requested not in conferences:
        raise ValueError("unknown conference")
    return [requested], requested


def assert_publish_context(env: dict[str, str], repository: str, workflow: str = ".github/workflows/maintainers.yml") -> None:
    """Publication runs only where it is meant to (C8, R32); the first thing that is otherwise is named."""
    wanted = {
        "GITHUB_ACTIONS": ("true",), "GITHUB_REPOSITORY": (repository,), "GITHUB_REF": ("refs/heads/main",),
        "GITHUB_EVENT_NAME": ("schedule", "workflow_dispatch"), "GITHUB_WORKFLOW_REF": (f"{repository}/{workflow}@refs/heads/main",),
    }
    for name, values in wanted.items():
        if env.get(name) not in values:
            raise ValueError(f"{name} is not as publication requires")
    if not re.fullmatch("[a-f0-9]{40}", env.get("GITHUB_SHA", "")):
        raise ValueError("GITHUB_SHA is no commit")
    if not env.get("GITHUB_TOKEN"):
        raise ValueError("no token")


def public_index(schools: DataFrame, programs: DataFrame) -> DataFrame:
    """Schools of the public index with the path of their snapshot and how many programs they have.

    schools: conference, school; programs: school.
    """
    n = programs.groupBy("school").agg(F.count("*").alias("programs"))
    path = F.concat(F.lit("v1/conferences/"), F.lower("conference"), F.lit("/schools/"), F.lower("school"), F.lit(".json"))
    return schools.join(n, "school", "left").select("conference", "school", path.alias("path"), F.coalesce("programs", F.lit(0)).cast("bigint").alias("programs"))


def running_size(files: DataFrame, order: str, most: int = MAX_BUNDLE) -> DataFrame:
    """Files with the bytes up to each and whether a bundle holds that much."""
    from tidewire.operators.packing import running

    return running(files, [order], {"running": F.col("bytes")}).withColumn("fits", F.col("running") <= most)


def manifest_document_violations(manifests: DataFrame, expected: DataFrame, now: Column) -> DataFrame:
    """Manifests as documents (X9): key (the conference), rule.

    manifests: conference, version, generated_at (text), schools (array of slugs); expected: conference, schools.
    """
    from tidewire.functions.dates import age_hours
    from tidewire.operators.health import violations

    at = F.try_to_timestamp("generated_at", F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX"))
    age = age_hours(at, now)
    rows = manifests.join(expected.select("conference", F.col("schools").alias("wanted")), "conference", "left")
    return violations(rows, "conference", {
        "version": F.col("version") == 1, "canonical-time": F.col("generated_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z$") & at.isNotNull(),
        "not-in-future": age >= -5 / 60, "not-old": age <= 24, "exact-schools": F.array_sort("schools") == F.array_sort("wanted"),
    })


def regular_file(directory: str, name: str, most: int = MAX_FILE) -> bytes:
    """The bytes of an ordinary file of a real folder on the driver (R30): no links, not empty, within bounds, not elsewhere."""
    import stat
    from pathlib import Path

    folder, path = Path(directory), Path(directory, name)
    if folder.is_symlink() or not folder.is_dir() or path.resolve().parent != folder.resolve():
        raise ValueError("not a folder of its own, or a file outside it")
    told = path.lstat()
    if not stat.S_ISREG(told.st_mode) or told.st_nlink != 1 or not 0 < told.st_size <= most:
        raise ValueError("not an ordinary file within bounds")
    return path.read_bytes()
