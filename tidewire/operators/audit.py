"""Whole-snapshot audits: every invariant of a published snapshot, and reports that must agree with themselves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.dates import age_hours
from tidewire.functions.text import has_credential
from tidewire.functions.urls import safe_url
from tidewire.operators.health import MAX_AGE_HOURS, REVIEW_AGE_DAYS, SKEW_HOURS, snapshot_rules, violations

_INSTANT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z$"


def public_value_error(value: Column, name: str) -> Column:
    """What a published text must not be, by the name of its field (X8): secrets, markup, unsafe addresses, odd instants."""
    url = name.lower().endswith("url")
    instant = name.endswith("At") or name == "date"
    return (
        F.when(has_credential(value), "credential")
        .when(value.rlike(r"[<>\x00-\x1f\x7f]"), "unsafe-text")
        .when(F.lit(url) & safe_url(value).isNull(), "unsafe-url")
        .when(F.lit(instant) & ~value.rlike(_INSTANT), "noncanonical-instant")
    )


def text_leaves(kind: T.DataType, at: Column, name: str = "") -> list[tuple[str, Column]]:
    """Every text in a nested type as an array of texts, with the name of its field."""
    none = F.array().cast("array<string>")
    if isinstance(kind, T.StringType):
        return [(name, F.array_compact(F.array(at)))]
    if isinstance(kind, T.StructType):
        return [leaf for f in kind for leaf in text_leaves(f.dataType, at[f.name], f.name)]
    if isinstance(kind, T.MapType):
        return text_leaves(T.ArrayType(kind.valueType), F.map_values(at), name)
    if isinstance(kind, T.ArrayType):
        inner = text_leaves(kind.elementType, F.lit(None).cast(kind.elementType), name)

        def leaf_of(i: int):
            return lambda x: text_leaves(kind.elementType, x, name)[i][1]

        return [(leaf, F.coalesce(F.flatten(F.transform(at, leaf_of(i))), none)) for i, (leaf, _) in enumerate(inner)]
    return []


def public_value_violations(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A row per unsafe text anywhere in the fields (X8): key, field, rule.  The leaves come from the schema."""

    def wrong(name: str, texts: Column) -> Column:
        errors = F.filter(F.transform(texts, lambda v: public_value_error(v, name)), lambda e: e.isNotNull())
        return F.transform(errors, lambda e: F.struct(F.lit(name).alias("field"), e.alias("rule")))

    leaves = [leaf for f in fields for leaf in text_leaves(rows.schema[f].dataType, F.col(f), f)]
    every = F.flatten(F.array(*(wrong(*leaf) for leaf in leaves)))
    return rows.select(F.col(key).cast("string").alias("key"), F.explode(every).alias("v")).select("key", "v.field", "v.rule")


def identity_violations(snapshots: DataFrame, catalog: DataFrame, now: Column) -> DataFrame:
    """Snapshots against the catalog (X7): key (the school), rule.

    snapshots: school, ncaa_id, name, athletics_url, source_url, academic_year, conference, conference_name, generated_at,
    sports (array).  catalog: the same columns but generated_at.  One full outer join.
    """
    same = ("ncaa_id", "name", "athletics_url", "source_url", "academic_year", "conference", "conference_name")
    c = catalog.select("school", *(F.col(x).alias(f"c_{x}") for x in (*same, "sports")), F.lit(True).alias("registered"))
    rows = snapshots.join(c, "school", "left")
    rules = {"registered": F.col("registered").isNotNull()}
    rules |= {f"{x}-differs": F.col("registered").isNull() | F.col(x).eqNullSafe(F.col(f"c_{x}")) for x in same}
    rules["future"] = F.col("generated_at") <= now + F.expr("INTERVAL 5 MINUTES")
    rules["sport-inventory"] = F.col("registered").isNull() | (F.array_sort("sports") == F.array_sort("c_sports"))
    return violations(rows, "school", rules)


def program_violations(programs: DataFrame, catalog: DataFrame, keys: list[str]) -> DataFrame:
    """Programs against the catalog's (X7): code, name, gender and conference of a registered sport."""
    same = ("code", "name", "gender", "conference", "conference_name")
    c = catalog.select(*keys, *(F.col(x).alias(f"c_{x}") for x in same), F.lit(True).alias("registered"))
    rows = programs.join(c, keys, "left").withColumn("key", F.concat_ws("/", *keys))
    rules = {"registered": F.col("registered").isNotNull()}
    rules |= {f"{x}-differs": F.col("registered").isNull() | F.col(x).eqNullSafe(F.col(f"c_{x}")) for x in same}
    return violations(rows, "key", rules)


def dataset_violations(datasets: DataFrame, now: Column) -> DataFrame:
    """Envelopes against their own rules (X7): key, rule.  datasets: key, and what ``health.snapshot_rules`` reads, n_ids."""
    return violations(datasets, "key", snapshot_rules(now) | {"record-ids-unique": F.col("n_ids") == F.col("n_records")})


def source_violations(collections: DataFrame, sources: DataFrame, articles: DataFrame, keys: list[str]) -> DataFrame:
    """News collections against their sources and articles (X7, K9, A17): key, rule.

    collections: keys, status, last_attempt_at, last_success_at, source_url.  sources: keys, source_order, source_url,
    status, last_attempt_at, last_success_at, record_count.  articles: keys, discovery_source_url.
    """
    n = articles.groupBy(*keys, F.col("discovery_source_url").alias("source_url")).agg(F.count("*").alias("attributed"))
    told = sources.groupBy(*keys, "source_url").agg(F.count("*").alias("repeated"))
    one = sources.join(told, [*keys, "source_url"]).join(n, [*keys, "source_url"], "full_outer")
    c = collections.select(*keys, *(F.col(x).alias(f"c_{x}") for x in ("status", "last_attempt_at", "last_success_at", "source_url")))
    one = one.join(c, keys).withColumn("key", F.concat_ws("/", *(F.col(k).cast("string") for k in keys), "source_url"))
    known = F.col("repeated").isNotNull()
    off = F.col("status") == "unavailable"
    count = F.coalesce("record_count", F.lit(0))
    rules = {
        "source-unique": ~known | (F.col("repeated") == 1),
        "provenance-exists": known,
        "provenance-successful": ~known | F.col("attributed").isNull() | F.col("status").isin("ok", "stale"),
        "source-attempt": ~known | (F.col("last_attempt_at") <= F.col("c_last_attempt_at")),
        "unavailable-source": ~known | ~off | (F.col("last_success_at").isNull() & (count == 0)),
        "source-success": ~known | off | (F.col("last_success_at") <= F.col("last_attempt_at")),
        "empty-source": ~known | (F.col("status") != "empty") | (count == 0),
        "ok-source": ~known | (F.col("status") != "ok") | (count > 0),
        "provenance-count": ~known | (count >= F.coalesce("attributed", F.lit(0))),
        "hidden-failure": ~known | ~F.col("c_status").isin("ok", "empty") | ~F.col("status").isin("stale", "unavailable"),
    }
    per_source = violations(one, "key", rules)
    fold = sources.groupBy(*keys).agg(
        F.bool_or(F.col("last_success_at").isNotNull()).alias("any_success"), F.bool_or(F.col("status").isin("stale", "unavailable")).alias("degraded"),
        F.min("last_success_at").alias("oldest"), F.min_by("source_url", "source_order").alias("first_url"),
    )
    total = articles.groupBy(*keys).agg(F.count("*").alias("n_articles"))
    from tidewire.operators.state import status_fold

    rows = c.join(fold, keys, "left").join(total, keys, "left").withColumn("key", F.concat_ws("/", *(F.col(k).cast("string") for k in keys)))
    want = status_fold(F.coalesce("any_success", F.lit(False)), F.coalesce("degraded", F.lit(False)), F.coalesce("n_articles", F.lit(0)))
    derived = {
        "derived-status": F.col("c_status") == want, "derived-success": F.col("c_last_success_at").eqNullSafe(F.col("oldest")),
        "derived-source": F.col("c_source_url").eqNullSafe(F.col("first_url")),
    }
    return per_source.unionByName(violations(rows, "key", derived))


def record_violations(records: DataFrame, key: str) -> DataFrame:
    """Records against their envelopes (X7): metadata checks, date precision, recruits' identity.

    records: key, collection, generated_at, metadata_checked_at, published_at, published_at_precision, school, sport, record_school,
    record_sport, class_year, season, recruit_status, updated_at, last_success_at.
    """
    c = F.col
    recruit = c("collection").isin("recruitingBoard", "recruitingOffers")
    news = c("published_at_precision").isNotNull()
    return violations(records, key, {
        "metadata-check": c("metadata_checked_at").isNull() | (c("metadata_checked_at") <= c("generated_at")),
        "date-precision": ~news | (c("published_at").isNull() == (c("published_at_precision") == "unknown")),
        "recruit-school": ~recruit | c("record_school").eqNullSafe(c("school")),
        "recruit-sport": ~recruit | c("record_sport").eqNullSafe(c("sport")),
        "recruit-season": ~recruit | c("class_year").cast("string").eqNullSafe(c("season")),
        "offer-status": (c("collection") != "recruitingOffers") | (c("recruit_status") == "offered"),
        "recruit-updated": ~recruit | (c("updated_at") <= c("last_success_at")),
    })


def report_violations(report: DataFrame, programs: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """A health report against its own rows, recomputed in one aggregate over one join (A19, R28): key, rule.

    report: one row of expected_programs, checked_programs, healthy_programs, repair_programs, review_programs, n_errors, passed.
    programs: key, passed, n_issues, n_warnings; expected: key.
    """
    both = programs.withColumn("told", F.lit(True)).join(expected.select(key).distinct().withColumn("wanted", F.lit(True)), key, "full_outer")
    told, wanted = F.col("told").isNotNull(), F.col("wanted").isNotNull()
    sums = both.agg(
        F.count_if(wanted).alias("n_expected"), F.count_if(told).alias("n_checked"), F.count_if(told & F.col("passed")).alias("n_healthy"),
        F.count_if(told & (F.col("n_warnings") > 0)).alias("n_review"), F.count_if(told & ~wanted).alias("n_unknown"),
        F.count_if(told & (F.col("passed") != (F.col("n_issues") == 0))).alias("n_contradicting"),
        F.count_if(wanted & ~told).alias("n_missing"), F.coalesce(F.sum("n_issues"), F.lit(0)).alias("n_issues"),
    )
    row = report.withColumn("key", F.lit("report")).join(sums.withColumn("key", F.lit("report")), "key")  # one row each
    c = F.col
    return violations(row, "key", {
        "inventory": c("expected_programs") == c("n_expected"), "unknown-program": c("n_unknown") == 0, "contradicted-issues": c("n_contradicting") == 0,
        "checked-count": c("checked_programs") == c("n_checked"), "healthy-count": c("healthy_programs") == c("n_healthy"),
        "repair-count": c("repair_programs") == c("n_expected") - c("n_healthy"), "review-count": c("review_programs") == c("n_review"),
        "missing-programs-are-errors": c("n_errors") >= c("n_missing") + c("n_issues"), "passed": c("passed") == (c("n_errors") == 0),
        "incomplete-cannot-pass": ~c("passed") | (c("healthy_programs") == c("n_expected")),
    })


def attention(programs: DataFrame) -> DataFrame:
    """Programs with issues or warnings."""
    return programs.where((F.size("issues") > 0) | (F.size("warnings") > 0))


def recent_coverage(articles: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """Per program whether its stories are recent, none in the future, and one has a photo."""
    out = articles.groupBy(*keys).agg(
        F.count("*").alias("stories"), F.count("image_url").alias("photos"), F.max("published_at").alias("latest")
    )
    age = age_hours(F.col("latest"), now)
    ok = (F.col("photos") > 0) & (age >= -24) & (age <= REVIEW_AGE_DAYS * 24)
    return out.withColumn("ok", F.coalesce(ok, F.lit(False)))


def current(at: Column, now: Column) -> Column:
    """Whether an observation is neither overdue nor in the future."""
    age = age_hours(at, now)
    return F.coalesce((age >= -SKEW_HOURS) & (age <= MAX_AGE_HOURS), F.lit(False))


def message_list(messages: Column) -> Column:
    """Whether an array is a bounded list of short texts."""
    return F.coalesce((F.size(messages) <= 10_000) & F.forall(messages, lambda m: (m != "") & (F.char_length(m) <= 4096)), F.lit(False))


def registry_violations(sources: DataFrame, programs: DataFrame, hosts: DataFrame) -> DataFrame:
    """A source registry against the catalog (X14): key, rule.

    sources: school, sport, url (null: none).  programs: school, sport.  hosts: school, host (allowed ones).
    """
    from tidewire.functions.urls import host_of

    known = programs.select("school", "sport").distinct().withColumn("sponsored", F.lit(True))
    schools = programs.select("school").distinct().withColumn("listed", F.lit(True))
    allowed = hosts.select("school", F.col("host").alias("at")).distinct().withColumn("reviewed", F.lit(True))
    rows = sources.withColumn("at", host_of(F.col("url"))).join(known, ["school", "sport"], "left").join(schools, "school", "left")
    rows = rows.join(allowed, ["school", "at"], "left").withColumn("key", F.concat_ws("/", F.col("school").cast("string"), "sport"))
    return violations(rows, "key", {
        "known-school": F.col("listed").isNotNull(), "known-sport": F.col("listed").isNull() | F.col("sponsored").isNotNull(),
        "reviewed-destination": F.col("url").isNull() | (safe_url(F.col("url")).isNotNull() & F.col("reviewed").isNotNull()),
    })


FORBIDDEN_FILES = r"(?i)(?:^|/)(?:node_modules|output(?:-[^/]*)?|previous|reports|\.git)(?:/|$)|(?:^|/)\.env(?:\.|$)|\.(?:pem|key|p12|pfx|log|tmp)$"
CONNECTIONS = r"(?:postgres(?:ql)?|mongodb(?:\+srv)?)://[^\s]+:[^\s]+@|\bsk_live_[a-zA-Z0-9]{20,}"


def file_violations(files: DataFrame) -> DataFrame:
    """Files of a public tree that must not be there, or say what must not be said (X13, R37): key, rule.  files: path, text."""
    text = F.coalesce("text", F.lit(""))
    return violations(files, "path", {
        "forbidden-file": ~F.col("path").rlike(FORBIDDEN_FILES), "public-values": ~has_credential(text), "connection-credential": ~text.rlike(CONNECTIONS),
    })


def differing_files(there: DataFrame, derived: DataFrame) -> DataFrame:
    """Generated files that differ from what the catalog gives (X12, R38): path, state.  Both: path, text."""
    a = there.select("path", F.sha2(F.col("text").cast("binary"), 256).alias("there"))
    b = derived.select("path", F.sha2(F.col("text").cast("binary"), 256).alias("derived"))
    state = F.when(F.col("there").isNull(), "missing").when(F.col("derived").isNull(), "unexpected").when(F.col("there") != F.col("derived"), "differs")
    return a.join(b, "path", "full_outer").select("path", state.alias("state")).where("state is not null")


def subset_violations(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Elements outside the known set."""
    return rows.select(*keys).distinct().join(known.select(*keys).distinct(), keys, "left_anti")


def whole_bundle(files: DataFrame, index: DataFrame, violations_: DataFrame, bundle: str) -> DataFrame:
    """The files of all bundles and the index, or none at all if any bundle has a violation (U8): bundle, path.

    One broken row holds everything back: the anti-join is on a constant of the violations, whose number is reduced to one.
    """
    every = reduce(DataFrame.unionByName, [files.select(bundle, "path"), index.select(F.lit("index").alias(bundle), "path")])
    broken = F.broadcast(violations_.limit(1).select(F.lit(1).alias("one")))
    return every.withColumn("one", F.lit(1)).join(broken, "one", "left_anti").drop("one")
