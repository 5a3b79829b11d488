"""Documents against a closed schema (X7): what is there but not allowed, what is lacking, and what is of another kind.

Reading JSON with a Spark schema loses what the schema doesn't know.  So a document is parsed to a VARIANT and walked inside its row, level
by level, to a row for each of its values: its path, and its place in the schema, which is the path without the numbers of list entries
and the free names of maps.  The schema is a table of places as well, so what a value must be is an equi-join on the place; values below
something that the schema doesn't know are not walked.

A schema is made of the functions below: ``text``, ``number``, ``one_of``, ``nullable``, ``list_of``, ``fields`` and ``entries``.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Kind:
    """What a value must be; ``inside`` are its fields, or its only kind of entry under ``""``."""

    kind: str
    least: float | None = None
    most: float | None = None
    pattern: str | None = None
    values: tuple[str, ...] | None = None
    whole: bool = False
    null: bool = False
    required: tuple[str, ...] = ()
    inside: dict[str, Kind] = field(default_factory=dict)


def text(longest: int = 300, least: int = 1, pattern: str | None = None) -> Kind:
    return Kind("text", least, longest, pattern)


def number(least: float, most: float, whole: bool = False) -> Kind:
    return Kind("number", least, most, whole=whole)


def one_of(*values: str | int | bool | None) -> Kind:
    """One of some values; a text is not the number that it writes."""
    kinds = {str: "STRING", int: "BIGINT", bool: "BOOLEAN", type(None): "VOID"}
    return Kind("enum", values=tuple(f"{kinds[type(v)]}:{'' if v is None else str(v).lower() if isinstance(v, bool) else v}" for v in values))


def nullable(kind: Kind) -> Kind:
    return replace(kind, null=True)


def list_of(kind: Kind, most: int) -> Kind:
    return Kind("list", 0, most, inside={"": kind})


def fields(optional: dict[str, Kind] | None = None, **required: Kind) -> Kind:
    """An object with just these fields."""
    return Kind("object", required=tuple(required), inside=required | (optional or {}))


def entries(kind: Kind, names: str, least: int, most: int) -> Kind:
    """An object whose fields all have names of a form and values of one kind."""
    return Kind("map", least, most, names, inside={"": kind})


def places(kind: Kind, place: str = "") -> dict[str, Kind]:
    """Every place of a schema."""
    out = {place: kind}
    for name, inner in kind.inside.items():
        below = {"list": f"{place}[]", "map": f"{place}.*"}.get(kind.kind, f"{place}.{name}")
        out |= places(inner, below)
    return out


_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("place", "kind", "pattern")] + [T.StructField(n, T.DoubleType()) for n in ("least", "most")]
    + [T.StructField(n, T.BooleanType()) for n in ("whole", "null")] + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("values", "required")]
)


def schema_table(spark: SparkSession, kind: Kind) -> DataFrame:
    """A row per place; as many as the schema has fields."""
    number_of = lambda x: None if x is None else float(x)
    rows = [(p, k.kind, k.pattern, number_of(k.least), number_of(k.most), k.whole, k.null, k.values and list(k.values), list(k.required)) for p, k in places(kind).items()]
    return spark.createDataFrame(rows, _SCHEMA)


def _is(place: Column, found: dict[str, Kind], kind: str) -> Column:
    return place.isin(*(p for p, k in found.items() if k.kind == kind) or ("-",))


def walked(documents: DataFrame, key: str, text_column: str, kind: Kind) -> DataFrame:
    """key, path, place, is (the kind of the value), said (a scalar as text), n (entries), names: a row per value of a document."""
    found = places(kind)
    depth = max(p.count(".") + p.count("[]") for p in found)
    maps = [(p, k.pattern) for p, k in found.items() if k.kind == "map"]
    value = lambda path, place, v: F.struct(path.alias("path"), place.alias("place"), v.alias("value"), F.schema_of_variant(v).alias("is"))

    def inside(x: Column) -> Column:
        named = F.map_entries(F.try_variant_get(x["value"], "$", "map<string, variant>"))
        path = lambda e: F.when(x["path"] == "", e["key"]).otherwise(F.concat(x["path"], F.lit("."), e["key"]))
        star = F.lit(False)
        for place, names in maps:
            star |= x["place"] == place
        fits = lambda e: F.coalesce(*(F.when(x["place"] == p, e["key"].rlike(names)) for p, names in maps), F.lit(False)) if maps else F.lit(False)
        below = lambda e: F.when(star & fits(e), F.concat(x["place"], F.lit(".*"))).when(star, F.concat(x["place"], F.lit(".?"))).otherwise(F.concat(x["place"], F.lit("."), e["key"]))
        listed = F.try_variant_get(x["value"], "$", "array<variant>")
        entry = lambda v, i: value(F.concat(x["path"], F.lit("["), i.cast("string"), F.lit("]")), F.concat(x["place"], F.lit("[]")), v)
        is_object = x["is"].startswith("OBJECT") & (_is(x["place"], found, "object") | _is(x["place"], found, "map"))
        return (
            F.when(is_object, F.transform(named, lambda e: value(path(e), below(e), e["value"])))
            .when(x["is"].startswith("ARRAY") & _is(x["place"], found, "list"), F.transform(listed, entry))
        )

    rows = documents.select(key, F.try_parse_json(text_column).alias("v"))
    rows = rows.withColumn("l0", F.array(value(F.lit(""), F.lit(""), F.col("v"))))
    for d in range(1, depth + 1):
        # the value of a level is copied into the next one only as far as it is walked
        rows = rows.withColumn(f"l{d}", F.flatten(F.filter(F.transform(f"l{d - 1}", inside), lambda a: a.isNotNull())))
    scalar = lambda x: F.when(~x["is"].startswith("OBJECT") & ~x["is"].startswith("ARRAY"), F.try_variant_get(x["value"], "$", "string"))
    size = lambda x: F.when(x["is"].startswith("OBJECT"), F.size(names(x))).when(x["is"].startswith("ARRAY"), F.size(F.try_variant_get(x["value"], "$", "array<variant>")))
    names = lambda x: F.map_keys(F.try_variant_get(x["value"], "$", "map<string, variant>"))
    kind_of = lambda x: F.regexp_extract(x["is"], "^[A-Z]+", 0)
    told = lambda x: F.struct(
        x["path"].alias("path"), x["place"].alias("place"), kind_of(x).alias("is"), scalar(x).alias("said"), size(x).alias("n"),
        F.when(x["is"].startswith("OBJECT") & _is(x["place"], found, "object"), names(x)).alias("names"),
    )
    return rows.select(key, F.inline(F.concat(*(F.transform(f"l{d}", told) for d in range(depth + 1)))))


def schema_violations(documents: DataFrame, key: str, text_column: str, kind: Kind) -> DataFrame:
    """key, path, rule: every place where a document differs from the schema; a text that is no JSON document breaks ``json``.

    Of several rules that a value breaks the first counts, in the order type, least, most, pattern.
    """
    table = schema_table(documents.sparkSession, kind)
    rows = walked(documents, key, text_column, kind).join(F.broadcast(table), "place", "left")  # a row per field of the schema, whatever the data
    is_number = F.col("is").isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
    length = F.char_length("said")
    wanted = lambda *names: F.col("kind").isin(*names)
    shape = (wanted("object", "map") & (F.col("is") != "OBJECT")) | (wanted("list") & (F.col("is") != "ARRAY")) | (wanted("text") & (F.col("is") != "STRING"))
    amount = F.when(is_number, F.expr("try_cast(said AS double)"))
    rule = (
        F.when(F.col("is").isNull(), "json").when(F.col("kind").isNull(), "additionalProperties").when(F.col("null") & (F.col("is") == "VOID"), None)
        .when(shape | (wanted("number") & (~is_number | (F.col("whole") & (amount != F.floor(amount))))), "type")
        .when(wanted("enum"), F.when(~F.coalesce(F.array_contains("values", F.concat("is", F.lit(":"), F.coalesce("said", F.lit("")))), F.lit(False)), "enum"))
        .when(wanted("text") & (length < F.col("least")), "minLength").when(wanted("text") & (length > F.col("most")), "maxLength")
        .when(wanted("text") & F.col("pattern").isNotNull() & ~F.rlike("said", F.col("pattern")), "pattern")
        .when(wanted("number") & (amount < F.col("least")), "minimum").when(wanted("number") & (amount > F.col("most")), "maximum")
        .when(wanted("map") & (F.col("n") < F.col("least")), "minProperties").when(wanted("map") & (F.col("n") > F.col("most")), "maxProperties")
        .when(wanted("list") & (F.col("n") > F.col("most")), "maxItems")
    )
    lacking = F.transform(F.array_except("required", "names"), lambda k: F.struct(F.when(F.col("path") == "", k).otherwise(F.concat("path", F.lit("."), k)).alias("path"), F.lit("required").alias("rule")))
    own = F.when(rule.isNotNull(), F.array(F.struct(F.col("path").alias("path"), rule.alias("rule"))))
    none = F.array().cast("array<struct<path: string, rule: string>>")
    return rows.select(key, F.inline(F.concat(F.coalesce(own, none), F.coalesce(F.when(F.col("kind") == "object", lacking), none))))


# The schema of a published snapshot, its lengths, patterns, bounds and words.
DATE = text(40, pattern=r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$")
URL = text(2048, 10, "^https://")
SLUG = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"
PRECISION = one_of("day", "instant", "unknown")
NEWS = fields(
    id=text(80), title=text(), url=URL, discoverySourceUrl=URL, publishedAt=nullable(DATE), publishedAtPrecision=PRECISION, imageUrl=nullable(URL),
    imageAlt=nullable(text()), publisher=text(160), optional={"author": nullable(text()), "metadataCheckedAt": DATE},
)
GAME = fields(
    id=text(80), date=DATE, name=text(), status=text(80), venue=nullable(text()), homeAway=one_of("home", "away", "neutral", None), opponent=text(),
    teamScore=nullable(number(0, 999)), opponentScore=nullable(number(0, 999)), url=nullable(URL), optional={"datePrecision": PRECISION},
)
PLAYER = fields(id=text(80), name=text(160), position=nullable(text(30)), jersey=nullable(text(10)), year=nullable(text(40)), imageUrl=nullable(URL), url=nullable(URL))
RANK = nullable(number(1, 100_000, whole=True))
RECRUIT = fields(
    id=text(80), name=text(160), classYear=number(2000, 2100, whole=True), position=nullable(text(30)), status=one_of("offered", "committed", "signed", "enrolled", "unknown"),
    schoolId=text(100), sport=text(100), sourceUrl=URL, updatedAt=DATE, profileUrl=nullable(URL), imageUrl=nullable(URL), schoolName=nullable(text(160)), hometown=nullable(text(160)),
    rating=nullable(number(0, 100)), ratingSystem=one_of("247sports", None), stars=nullable(number(1, 5, whole=True)), nationalRank=RANK, positionRank=RANK, stateRank=RANK,
    rankingState=nullable(text(2, pattern="^[A-Z]{2}$")), rankingGroup=nullable(text(40)),
)


def dataset(record: Kind, most: int = 400, **more: Kind) -> Kind:
    """The envelope of a collection."""
    return fields(
        status=one_of("ok", "empty", "stale", "unavailable", "unsupported"), lastAttemptAt=DATE, lastSuccessAt=nullable(DATE), sourceUrl=nullable(URL), season=nullable(text(40)),
        reason=nullable(text(160)), records=list_of(record, most), **more,
    )


SOURCE = fields(
    status=one_of("ok", "empty", "stale", "unavailable"), lastAttemptAt=DATE, lastSuccessAt=nullable(DATE), sourceUrl=URL, reason=nullable(text(160)), recordCount=number(0, 1000, whole=True)
)
CONFERENCE = fields(slug=text(100), name=text(160))
PROGRAM = fields(
    sponsored=one_of(True), code=text(30), name=text(100), gender=text(30), conference=CONFERENCE, news=dataset(NEWS, 1000, sources=list_of(SOURCE, 20)), schedule=dataset(GAME),
    roster=dataset(PLAYER), recruitingAnnouncements=dataset(NEWS), recruitingBoard=dataset(RECRUIT, 1000), recruitingOffers=dataset(RECRUIT, 1000),
)
SNAPSHOT = fields(
    schemaVersion=one_of(1), academicYear=text(20), conference=CONFERENCE,
    school=fields(slug=text(100), ncaaId=text(20), name=text(160), athleticsUrl=nullable(URL), membershipSourceUrl=URL), generatedAt=DATE, sports=entries(PROGRAM, SLUG, 1, 60),
)
