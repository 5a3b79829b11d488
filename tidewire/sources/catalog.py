"""The catalog of schools and programs, optional registries, and snapshots of earlier runs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.urls import safe_url
from tidewire.operators.health import violations
from tidewire.schemas import CONFERENCE, SCHOOL, SNAPSHOT

SLUG = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"
MIN_SCHOOLS, MAX_SCHOOLS, MAX_SPORTS = 300, 500, 60


def read_optional(spark: SparkSession, path: str, schema: T.StructType, lines: bool = False) -> DataFrame:
    """The JSON at a path, or an empty table if there is none; other errors are raised.

    Files hold a document or an array of them, or with ``lines`` one document a line.
    """
    try:
        return spark.read.schema(schema).option("multiLine", not lines).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def registry(spark: SparkSession, path: str, schema: T.StructType, lines: bool = False) -> DataFrame:
    """A registry's JSON of version 1 (S3, S4, S5); another version is an error."""
    versioned = T.StructType([T.StructField("schemaVersion", T.IntegerType()), *schema])
    rows = spark.read.schema(versioned).option("multiLine", not lines).option("mode", "FAILFAST").json(path)
    if not rows.where("schemaVersion is null or schemaVersion <> 1").isEmpty():
        raise ValueError("unsupported registry version")
    return rows.drop("schemaVersion")


def schools(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """School records of a catalog's JSON files."""
    return spark.read.schema(SCHOOL).option("multiLine", not lines).option("mode", "FAILFAST").json(path)


def conferences(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONFERENCE).option("multiLine", True).json(path)


def conference_list(school_rows: DataFrame) -> DataFrame:
    """Distinct conferences by slug."""
    return school_rows.select("conference.slug", "conference.name").distinct().orderBy("slug")


def programs(school_rows: DataFrame) -> DataFrame:
    """A row per sponsored sport."""
    return school_rows.select(
        F.col("slug").alias("school"), "ncaaId", F.col("name").alias("school_name"), F.col("conference.slug").alias("primary_conference"),
        F.explode("sports").alias("sport"),
    ).select("school", "ncaaId", "school_name", "primary_conference", F.col("sport.slug").alias("sport"), "sport.code", "sport.name",
             "sport.gender", F.col("sport.conference.slug").alias("conference"))


def catalog_violations(school_rows: DataFrame, least: int = MIN_SCHOOLS, most: int = MAX_SCHOOLS) -> DataFrame:
    """Broken rules of a catalog (S1): rule, key."""
    rules = {
        "slug": F.col("slug").rlike(SLUG),
        "athletics-url": F.col("athleticsUrl").isNull() | safe_url(F.col("athleticsUrl")).isNotNull(),
        "sports-count": F.size("sports").between(1, MAX_SPORTS),
        "sport-slugs-unique": F.size(F.array_distinct(F.transform("sports", lambda s: s["slug"]))) == F.size("sports"),
    }
    rows = violations(school_rows, "slug", rules)
    for key in ("slug", "ncaaId"):
        twice = school_rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
        rows = rows.unionByName(twice.select(F.col(key).cast("string").alias("key"), F.lit(f"{key}-unique").alias("rule")))
    size = school_rows.agg(F.count("*").alias("n")).where(~F.col("n").between(least, most))
    return rows.unionByName(size.select(F.col("n").cast("string").alias("key"), F.lit("school-count").alias("rule")))


def program_tree(spark: SparkSession, root: str) -> DataFrame:
    """(conference, school, sport) of a hierarchy of folders, from the paths of its files alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.mjs").option("recursiveFileLookup", True).load(root)
    path = F.col("path")
    part = lambda n: F.regexp_extract(path, r"/conferences/([^/]+)/([^/]+)/sports/([^/]+)/", n)
    return files.select(part(1).alias("conference"), part(2).alias("school"), part(3).alias("sport")).where("sport <> ''").distinct()


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Snapshots of an earlier run, one JSON file per school (S6), as ``sources.snapshot_files`` writes them; an absent school has no row."""
    return read_optional(spark, f"{root}/v1/conferences/*/schools/*.json", SNAPSHOT)


def snapshot_programs(rows: DataFrame) -> DataFrame:
    """A row per school and sport, with the program's envelopes."""
    return rows.select(
        F.col("school.slug").alias("school"), F.col("conference.slug").alias("conference"), "generatedAt", F.explode("sports").alias("sport", "program")
    )


def snapshot_articles(rows: DataFrame) -> DataFrame:
    """The news records of snapshots, as prior records of a merge."""
    news = snapshot_programs(rows).select("school", "sport", F.posexplode("program.news.records").alias("pos", "r"))
    return news.select("school", "sport", "pos", "r.*")


def exclusions_in_order(excluded: DataFrame) -> DataFrame:
    """Schools by name and exclusions by number (O5): the order of a published catalog."""
    return excluded.orderBy("ncaa_id")
