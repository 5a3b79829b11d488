"""Dates as publishers write them, and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Publication times beyond this after the observation are not believed.
FUTURE_LIMIT = "INTERVAL 24 HOURS"
_ZONE = r"(?:Z|[+-]\d\d:?\d\d|\b(?:GMT|UTC|[ECMP][SD]T))\s*$"


def iso(ts: Column) -> Column:
    """An instant as text in UTC with milliseconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def publication_date(text: Column) -> Column:
    """A feed's date: struct (at, precision).  Without a zone it is unknown."""
    at = F.when(text.rlike(_ZONE), parsed_instant(text))
    return F.struct(at.alias("at"), F.when(at.isNull(), "unknown").otherwise("instant").alias("precision"))


def parsed_instant(text: Column) -> Column:
    rfc = F.regexp_replace(F.regexp_replace(text, r"^\s*[A-Za-z]{3,9},\s*", ""), r"\s+", " ")
    # ISO texts with a zone: the date and time parts are put into one fixed form first
    form = r"^(\d{4}-\d\d-\d\d)[T ](\d\d:\d\d(?::\d\d)?)(?:[.]\d+)?\s*(Z|[+-]\d\d:?\d\d)$"
    time = F.rpad(F.regexp_extract(text, form, 2), 8, ":00")
    zone = F.regexp_replace(F.regexp_replace(F.regexp_extract(text, form, 3), "Z", "+0000"), ":", "")
    told = F.concat_ws(" ", F.regexp_extract(text, form, 1), time, zone)
    return F.coalesce(
        F.when(text.rlike(form), F.try_to_timestamp(told, F.lit("yyyy-MM-dd HH:mm:ss Z"))),
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss zzz")),
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss Z")),
    )


def day_value(text: Column) -> Column:
    """A day as a site writes it (M/D/YYYY, Month D, YYYY, or ISO), if the calendar has it."""
    return F.coalesce(
        *(
            F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(form)))
            for shape, form in (
                (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
                (r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy"),
                (r"^[A-Z][a-z]{3,8} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
                (r"^\d{4}-\d\d-\d\d$", "yyyy-MM-dd"),
            )
        )
    )


def date_value(text: Column) -> Column:
    """A site's date: struct (at, precision in instant, day, unknown)."""
    instant = F.when(text.rlike(_ZONE), parsed_instant(text))
    day = day_value(text)
    precision = F.when(instant.isNotNull(), "instant").when(day.isNotNull(), "day").otherwise("unknown")
    return F.struct(F.coalesce(instant, day).alias("at"), precision.alias("precision"))


def recruiting_cycle(at: Column) -> Column:
    """The class year that a date belongs to: from March on, the next."""
    return F.year(at) + F.when(F.month(at) >= 3, 1).otherwise(0)


def age_hours(at: Column, now: Column) -> Column:
    """Hours from ``at`` to ``now``; null if there is no date."""
    return (F.unix_millis(now.cast("timestamp")) - F.unix_millis(at.cast("timestamp"))) / F.lit(3_600_000.0)


def not_future(published_at: Column, observed_at: Column) -> Column:
    """Undated, or at most a day after the observation."""
    return published_at.isNull() | (published_at <= observed_at + F.expr(FUTURE_LIMIT))


def season(text: Column) -> Column:
    """A season such as 2025-26 in a heading, or null."""
    return F.nullif(F.regexp_extract(text, r"\b(20\d\d(?:-\d\d)?)\b", 1), F.lit(""))


def score(value: Column) -> Column:
    """A score from 0 to under 1000, or null."""
    n = value.try_cast("double")
    return F.when((n >= 0) & (n < 1000), n)


def result_score(text: Column) -> Column:
    """Digits only, under 10,000."""
    return F.when(text.rlike(r"^\d{1,4}$"), text.try_cast("int"))


def optional_number(text: Column, most: float) -> Column:
    """A positive number up to ``most``; NA and NR are null."""
    n = F.when(~F.upper(F.trim(text)).isin("NA", "NR", ""), F.trim(text).try_cast("double"))
    return F.when((n > 0) & (n <= most), n)


def slot_label(at: Column) -> Column:
    """To the minute, in UTC."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm'Z'")


def iso_date(text: Column) -> Column:
    """A date as text in its one form, or null; without a zone it is taken as UTC (T5)."""
    return iso(F.coalesce(parsed_instant(text), text.try_cast("timestamp")))


def conference_day(text: Column) -> Column:
    """A conference's day: M/D/20YY and nothing else."""
    return F.when(text.rlike(r"^\d{1,2}/\d{1,2}/20\d{2}$"), F.try_to_timestamp(text, F.lit("M/d/yyyy")))


def static_day(datetime: Column, toggle: Column, label: Column) -> Column:
    """The day of a static game card: of its time element, else the full date of its toggle or label."""
    day = F.try_to_timestamp(F.regexp_extract(datetime, r"^(\d{4}-\d{2}-\d{2})(?:[T ]|$)", 1), F.lit("yyyy-MM-dd"))
    written = F.coalesce(
        F.nullif(F.regexp_extract(toggle, r"-\s*([A-Za-z]+ \d{1,2},? \d{4})\s*$", 1), F.lit("")),
        F.nullif(F.regexp_extract(label, r"\bon ([A-Za-z]+ \d{1,2},? \d{4})\b", 1), F.lit("")),
    )
    named = F.regexp_replace(written, ",", "")
    full = F.when(named.rlike("^[A-Z][a-z]{2} "), F.try_to_timestamp(named, F.lit("MMM d yyyy"))).otherwise(F.try_to_timestamp(named, F.lit("MMMM d yyyy")))
    return F.when(F.coalesce(datetime, F.lit("")) != "", day).otherwise(full)


def season_of(title: Column, kind: str) -> Column:
    """The season in a heading that is about the kind of page, or null."""
    told = F.nullif(F.regexp_extract(title, r"\b(20\d\d(?:[-–](?:20)?\d\d)?)\b", 1), F.lit(""))
    return F.when(F.contains(F.lower(title), F.lit(kind)), told)
