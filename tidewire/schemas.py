"""Record and snapshot types; nullable where the data model allows null."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(), "TIMESTAMP": T.TimestampType(), "DOUBLE": T.DoubleType(), "INT": T.IntegerType(),
    "BIGINT": T.LongType(), "BOOLEAN": T.BooleanType(),
}


def _struct(text: str) -> T.StructType:
    """A struct of plain fields, written "name TYPE, name TYPE"; needs no session, unlike a DDL string."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (f.split() for f in text.split(","))])


NEWS = _struct(
    "id STRING, title STRING, url STRING, discoverySourceUrl STRING, publishedAt TIMESTAMP, publishedAtPrecision STRING,"
    " imageUrl STRING, imageAlt STRING, publisher STRING, author STRING, metadataCheckedAt TIMESTAMP"
)
SCHEDULE = _struct(
    "id STRING, date TIMESTAMP, name STRING, status STRING, venue STRING, homeAway STRING, opponent STRING, teamScore DOUBLE,"
    " opponentScore DOUBLE, url STRING, datePrecision STRING"
)
ROSTER = _struct("id STRING, name STRING, position STRING, jersey STRING, year STRING, imageUrl STRING, url STRING")
RECRUIT = _struct(
    "id STRING, name STRING, classYear INT, position STRING, status STRING, schoolId STRING, sport STRING, sourceUrl STRING,"
    " updatedAt TIMESTAMP, profileUrl STRING, imageUrl STRING, schoolName STRING, hometown STRING, rating DOUBLE, ratingSystem STRING,"
    " stars INT, nationalRank INT, positionRank INT, stateRank INT, rankingState STRING, rankingGroup STRING"
)
SOURCE_HEALTH = _struct(
    "status STRING, lastAttemptAt TIMESTAMP, lastSuccessAt TIMESTAMP, sourceUrl STRING, reason STRING, recordCount INT"
)
# The six collections of a program.
COLLECTIONS = ("news", "schedule", "roster", "recruitingAnnouncements", "recruitingBoard", "recruitingOffers")
STATUSES = ("ok", "empty", "stale", "unavailable", "unsupported")
_RECORDS = {"news": NEWS, "schedule": SCHEDULE, "roster": ROSTER, "recruitingAnnouncements": NEWS}


def dataset(collection: str) -> T.StructType:
    """The envelope of a collection."""
    out = _struct(
        "status STRING, lastAttemptAt TIMESTAMP, lastSuccessAt TIMESTAMP, sourceUrl STRING, season STRING, reason STRING"
    ).add("records", T.ArrayType(_RECORDS.get(collection, RECRUIT)))
    return out.add("sources", T.ArrayType(SOURCE_HEALTH)) if collection == "news" else out


CONFERENCE = _struct("id STRING, slug STRING, name STRING")
SPORT = _struct("slug STRING, code STRING, name STRING, gender STRING").add("conference", CONFERENCE)
SCHOOL = (
    _struct("slug STRING, ncaaId BIGINT, name STRING, athleticsUrl STRING, membershipSourceUrl STRING")
    .add("conference", CONFERENCE)
    .add("sports", T.ArrayType(SPORT))
)
SLUG_NAME = _struct("slug STRING, name STRING")
PROGRAM = _struct("sponsored BOOLEAN, code STRING, name STRING, gender STRING").add("conference", SLUG_NAME)
for _c in COLLECTIONS:
    PROGRAM.add(_c, dataset(_c))
SNAPSHOT = (
    _struct("schemaVersion INT, academicYear STRING, generatedAt TIMESTAMP")
    .add("conference", SLUG_NAME)
    .add("school", _struct("slug STRING, ncaaId STRING, name STRING, athleticsUrl STRING, membershipSourceUrl STRING"))
    .add("sports", T.MapType(T.StringType(), PROGRAM))
)
