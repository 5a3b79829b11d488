"""Routing of articles to programs: mentions of schools, explicit sports, the verdict on a feed's item.

All texts are folded first (``fold`` and ``ascii_words``), so they are single-spaced ASCII words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidewire.scratch import shared_root, store_of

# Acronyms that several schools use, and words that decide.
AMBIGUOUS = (
    "usc", "osu", "asu", "isu", "msu", "miami", "columbia", "brown", "ut", "uc", "ui", "mu", "lu", "cu", "su", "tu", "um",
)
PROFESSIONAL = r"\b(?:nfl|nba|wnba|mlb|nhl|mls|nwsl|super bowl|world series champion|fantasy football|fantasy basketball)\b"
BETTING = (
    r"\b(?:betting|sportsbook|parlay|moneyline|point spread|over under|best bets|betting odds|picks and predictions"
    r"|promo code|bonus bets)\b"
)
WOMEN = r"\b(?:women s|womens|women|wbb|wbkb|ncaaw|ladies|lady|girls)\b"
MEN = r"\b(?:men s|mens|men|mbb|mbkb|ncaam|boys)\b"
YOUTH = r"\b(?:high school|prep|youth|little league)\b"
RECRUITS = r"\brecruit(?:ing|s|ed)?\b"
SIGNS = r"\b(?:recruit|recruiting|commit|commits|commitment|offer|offers|signs)\b"
FOOTBALL_VARIANTS = r"\b(?:flag football|sprint football|lightweight football)\b"
TERMS = {
    "basketball": ("basketball", "hoops", "hardwood", "point guard", "shooting guard", "wbb", "mbb"),
    "football": ("football", "quarterback", "touchdown", "linebacker", "wide receiver", "running back"),
}
RECRUIT_HEADLINE = r"(?i)\b(?:signs?|signing|signees?|recruiting class|adds\b.{0,80}\bto roster|welcomes\b.{0,80}\bclass)\b"


class AliasMatcher:
    """Where names of a dictionary, or of a part of one, stand in folded text.  ``told`` gives for a name its only owner, or None."""

    def __init__(self, told: dict[str, str | None]):
        self.told = {a: o for a, o in told.items() if len(a) >= 3 and a not in AMBIGUOUS}
        self.machine = ahocorasick.Automaton()
        for alias, owner in self.told.items():
            self.machine.add_word(f" {alias} ", (len(alias) + 2, alias, owner))
        if self.told:
            self.machine.make_automaton()

    def hits(self, padded: str) -> list[tuple[int, str, int, int, str | None]]:
        """(- length, name, begin, end, owner) of every place."""
        return [(-n, alias, end - n + 1, end + 1, owner) for end, (n, alias, owner) in self.machine.iter(padded)] if self.told else []


def longest_first(hits: list[tuple], length: int) -> list[str]:
    """The owners of names in a text of ``length``: longer names take their words before shorter ones are looked for, wherever they stand."""
    taken, out = bytearray(length), {}
    for n, _, begin, end, owner in sorted(hits, key=lambda h: h[:3]):
        # two names may share the space between them
        if not any(taken[begin + 1 : end - 1]):
            taken[begin + 1 : end - 1] = b"\1" * (-n - 2)
            if owner is not None:
                out[owner] = None
    return list(out)


#: A worker holds an automaton of so many names; a larger dictionary is cut into parts that it holds one after another.
MAX_NAMES = 200_000


def schools_mentioned(owners: dict[str, Iterable[str]], strong: Iterable[str] | None = None):
    """A function of folded text: the slugs of schools it mentions (C2, K17), for a dictionary of a catalog's size.

    In summaries only ``strong`` names count (whole official names): a town or a surname there is no school.
    """
    pairs = [(a, o) for a, os in owners.items() for o in os]
    counts = None if strong is None else set(strong)
    spark = SparkSession.active()
    names = spark.createDataFrame([(a, o, counts is None or a in counts) for a, o in pairs], "alias string, owner string, strong boolean")
    return mentions_of(names)


def mentions_of(names: DataFrame, most: int = MAX_NAMES):
    """A function of folded text: the owners of the names that it mentions, in order of the names' lengths.

    names: alias, owner, and perhaps strong (whether the name counts; others still take their words); of any number.  A name of several
    owners mentions none.  The names are saved in parts of ``most``; a worker keeps one part's automaton and goes over its batch of
    texts once for each part.  Which hits stand is decided when those of all parts are known, so the parts don't show in the result.
    An Arrow UDF: the fold over what is left of a text has no JVM-side form that is linear in the text.
    """
    spark = names.sparkSession
    strong = F.max("strong") if "strong" in names.columns else F.lit(True)
    owner = F.when((F.count_distinct("owner") == 1) & strong, F.min("owner"))
    told = names.where("alias <> ''").groupBy("alias").agg(owner.alias("owner"))
    root = f"{shared_root(spark)}/names-{uuid.uuid4().hex}"
    told.write.parquet(f"{root}/all")
    parts = max(-(-spark.read.parquet(f"{root}/all").count() // most), 1)
    spark.read.parquet(f"{root}/all").withColumn("part", F.pmod(F.xxhash64("alias"), F.lit(parts))).write.partitionBy("part").parquet(f"{root}/parts")

    @pandas_udf("array<string>")
    def mentions(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            padded = [f" {t} " if t else "" for t in texts]
            hits: list[list[tuple]] = [[] for _ in padded]
            for part in range(parts):
                matcher = _matcher(f"{root}/parts", part)
                for found, text in zip(hits, padded, strict=True):
                    if text:
                        found += matcher.hits(text)
            yield pd.Series([longest_first(found, len(text)) for found, text in zip(hits, padded, strict=True)])

    return mentions


@lru_cache(maxsize=1)
def _matcher(folder: str, part: int) -> AliasMatcher:
    store, path = store_of(f"{folder}/part={part}")
    told: dict[str, str | None] = {}
    if store.get_file_info(path).type == pafs.FileType.Directory:
        for f in store.get_file_info(pafs.FileSelector(path)):
            if f.base_name.startswith("part-"):
                with store.open_input_file(f.path) as stream:
                    table = pq.ParquetFile(stream).read(["alias", "owner"])
                told.update(zip(table["alias"].to_pylist(), table["owner"].to_pylist(), strict=True))
    return AliasMatcher(told)


def sport_terms(programs: DataFrame) -> DataFrame:
    """A row per (slug, gender, term) by which a headline names a sport."""
    from tidewire.functions.text import ascii_words

    bare = lambda c: F.regexp_replace(ascii_words(c), "^(?:men s|women s|mens|womens|coed) ", "")
    fixed = F.when(F.col("slug").isin("basketball", "womens-basketball"), F.array(*map(F.lit, TERMS["basketball"])))
    fixed = fixed.when(F.col("slug") == "football", F.array(*map(F.lit, TERMS["football"])))
    fixed = fixed.when(F.col("slug").isin("baseball", "softball"), F.array("slug"))
    own = F.array_distinct(F.array(bare(F.col("name")), bare(F.col("slug"))))
    return programs.select("slug", "gender", F.explode(F.coalesce(fixed, own)).alias("term")).where("term <> ''").distinct()


def explicit_sports(text: Column, terms: list[tuple[str, str, str]]) -> Column:
    """The slugs of sports that folded text names, given (slug, gender, term)."""
    women, men = text.rlike(WOMEN), text.rlike(MEN)
    by_slug: dict[tuple[str, str], list[str]] = {}
    for slug, gender, term in terms:
        by_slug.setdefault((slug, gender), []).append(term)
    found = []
    for (slug, gender), words in sorted(by_slug.items()):
        said = text.rlike(r"\b(?:" + "|".join(sorted(words)) + r")\b")
        if gender == "men":
            said &= ~women | men
        if gender == "women":
            said &= ~men | women
        if slug == "football":
            said &= ~text.rlike(FOOTBALL_VARIANTS)
        found.append(F.when(said, F.lit(slug)))
    return F.array_distinct(F.array_compact(F.array(*found)))


def accepts(
    title: Column, details: Column, school: Column, sport: Column, gender: Column, feed_school: Column,
    feed_sport: Column, requires_gender: Column, title_schools: Column, detail_schools: Column,
    title_sports: Column, school_title_sports: Column, school_text_sports: Column,
) -> Column:
    """Whether a feed's item belongs to a program (C1, F5); the mentions are computed before."""
    text = F.concat_ws(" ", title, details)
    scope = (feed_school.isNull() | (feed_school == school)) & (feed_sport.isNull() | (feed_sport == sport))
    off_topic = text.rlike(BETTING) | (title.rlike(PROFESSIONAL) & ~title.rlike(RECRUITS))
    off_topic |= title.rlike(YOUTH) & ~text.rlike(SIGNS)
    direct = F.array_contains(title_schools, school) | F.array_contains(detail_schools, school)
    by_feed = feed_school.isNotNull() & (F.size(title_schools) == 0)
    relevant = F.when(F.size(school_title_sports) > 0, school_title_sports).otherwise(school_text_sports)
    unscoped = F.array_contains(relevant, sport) & (F.size(relevant) == 1)
    women, men = text.rlike(WOMEN), text.rlike(MEN)
    named = ~requires_gender | ((gender != "men") | men) & ((gender != "women") | women)
    other = ((gender == "men") & women & ~title.rlike(MEN)) | ((gender == "women") & men & ~title.rlike(WOMEN))
    same_sport = (F.size(title_sports) == 0) | F.array_contains(title_sports, sport)
    scoped = named & ~other & same_sport
    ok = scope & (title != "") & ~off_topic & (direct | by_feed) & F.when(feed_sport.isNull(), unscoped).otherwise(scoped)
    return F.coalesce(ok, F.lit(False))


def recruit_headline(title: Column) -> Column:
    """Whether a headline announces recruits."""
    return title.rlike(RECRUIT_HEADLINE)


def recruiting_status(section: Column) -> Column:
    """What a list's heading says of those below it; null for sections that are skipped (C4)."""
    text = F.lower(section)
    return (
        F.when(text.rlike(r"transfer|decommit"), F.lit(None))
        .when(text.rlike(r"\benroll"), "enrolled")
        .when(text.rlike(r"\bsign"), "signed")
        .when(text.rlike(r"\bcommit"), "committed")
        .otherwise("unknown")
    )
