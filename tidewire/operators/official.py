"""Routing of official pages' records: labels against programs, exclusions, sparse cards filled from metadata.

A program's aliases come as an array, made once from ``functions.sports.alias_rows``, so whether a label names the
program is an overlap of two short arrays in the row and no join per label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.sports import normal_label, sport_gender
from tidewire.functions.text import clean_author, clean_text, stable_id, tidy
from tidewire.functions.urls import host_of, safe_url
from tidewire.operators.discovery import COMBINED_FAMILIES, navigation_matches
from tidewire.operators.merge import precision_merge

# Programs that are separate although archives tag them alike, labels of coed rifle, bounds.
FOOTBALL_FAMILIES = ("football", "flag football", "lightweight football")
RIFLE_LABELS = ("rifle", "coed rifle", "mixed rifle")
BASKETBALLS = ("Men's Basketball", "Women's Basketball")
MAX_RECORDS, MAX_SCALAR = 1000, 4096
#: Fields of a page's sport object that may name it, in order.
LABEL_FIELDS = ("title", "name", "slug", "shortname", "shortName", "abbreviation", "abbrev", "global_sport_name_slug", "globalSportNameSlug")


def label_genders(labels: Column) -> Column:
    """Every ``mens`` and ``womens`` that the labels say."""
    return F.flatten(F.transform(labels, lambda x: F.regexp_extract_all(normal_label(x), F.lit(r"\b(mens|womens)\b"), F.lit(1))))


def label_forms(labels: Column) -> Column:
    """The normal forms by which labels may name a sport: whole, their complete parenthesis, their listed parts."""
    inner = lambda x: F.regexp_extract(x, r"^[A-Za-z0-9 -]{1,20}\(([^()]+)\)$", 1)
    parts = F.flatten(F.transform(labels, lambda x: F.split(x, "[,;]")))
    said = F.concat(labels, parts)
    forms = F.concat(F.transform(said, lambda x: normal_label(F.trim(x))), F.transform(said, lambda x: normal_label(inner(F.trim(x)))))
    return F.array_distinct(F.filter(forms, lambda x: x != ""))


def labels_match(labels: Column, aliases: Column) -> Column:
    """Whether a label, or a part of one, is an alias of the program."""
    return F.coalesce(F.arrays_overlap(label_forms(labels), aliases), F.lit(False))


def declared_labels(sport: Column) -> Column:
    """The labels that a sport object (a map) declares, in order of its fields."""
    fields = F.array(*(F.element_at(sport, F.lit(k)) for k in LABEL_FIELDS))
    return F.filter(fields, lambda x: x.isNotNull() & (x != ""))


def declared_aliases(sports: DataFrame, token: Column) -> DataFrame:
    """Sport objects whose own route is the page's (T46): their labels, as further aliases.  sports: a map ``sport``."""
    routes = F.array(*(F.element_at("sport", F.lit(k)) for k in ("shortname", "shortName", "slug", "global_sport_name_slug", "globalSportNameSlug")))
    return sports.where(F.array_contains(F.array_compact(routes), token)).withColumn("labels", declared_labels(F.col("sport")))


def label_conflicts(labels: Column, expected: Column, slug: Column) -> Column:
    """Whether labels name another gender than the program's, or the other weight of its crew (F8)."""
    genders = label_genders(labels)
    said = F.size(genders) > 0
    both = F.array_contains(genders, "mens") & F.array_contains(genders, "womens")
    weight = lambda word: F.exists(labels, lambda x: normal_label(x).rlike(rf"\b{word}\b"))
    other = expected.isNotNull() & said & ~F.array_contains(genders, expected)
    crew = ((slug == "mens-crew") & weight("lightweight")) | ((slug == "mens-lightweight-crew") & weight("heavyweight"))
    return F.coalesce(F.when(expected == "coed", said & ~both).otherwise(F.coalesce(other, F.lit(False)) | F.coalesce(crew, F.lit(False))), F.lit(False))


def primary_family_conflicts(labels: DataFrame, programs: DataFrame, aliases: DataFrame) -> DataFrame:
    """(school, program_id, label) where a primary label names another kind of football than the program (F8).

    labels: school, label; programs and aliases as for ``navigation_matches``.
    """
    named = navigation_matches(labels, programs, aliases)
    kinds = programs.where(F.col("family").isin(*FOOTBALL_FAMILIES)).select("school", "program_id", "family")
    other = named.join(kinds, ["school", "program_id"]).select("school", "label", F.col("family").alias("named"))
    wanted = labels.select("school", "label").distinct().join(kinds, "school")
    hit = wanted.join(other, ["school", "label"]).where("named <> family").select("school", "program_id", "label").distinct()
    return hit.join(named, ["school", "program_id", "label"], "left_anti")


def program_matches(
    labels: Column, titles: Column, declared_gender: Column, expected: Column, slug: Column, family: Column, aliases: Column,
    by_navigation: Column, only_coed_rifle: Column,
) -> Column:
    """Whether a site's sport object is the program.

    An explicit public title outranks the site's gender flag; a bare rifle title is the coed program's where a school has no
    other; a gender flag is put before ungendered labels; a declared coed rowing is both teams'; combined families are
    matched as in navigation (``by_navigation``).
    """
    genders = F.array_distinct(label_genders(titles))
    explicit = (F.size(genders) == 1) & labels_match(titles, aliases)
    bare_rifle = F.exists(titles, lambda x: normal_label(x).isin(*RIFLE_LABELS))
    coed_rifle = (expected == "coed") & (family == "rifle") & (F.size(genders) == 0) & bare_rifle & only_coed_rifle
    coed_rifle = F.coalesce(coed_rifle, F.lit(False))
    none = F.lit(None).cast("string")
    flag = sport_gender(declared_gender, none, none)
    actual = F.when(coed_rifle, expected).when(explicit, F.get(genders, F.lit(0))).otherwise(flag)
    wrong = F.coalesce(actual.isNotNull() & (actual != "coed") & ~actual.eqNullSafe(expected), F.lit(False))
    conflict = F.when(coed_rifle, label_conflicts(titles, expected, slug)).otherwise(label_conflicts(labels, expected, slug))
    gendered = actual.isin("mens", "womens") & labels_match(F.transform(labels, lambda x: F.concat(actual, F.lit(" "), x)), aliases)
    rowing = declared_gender.isin("g", "coed") & (family == "rowing") & F.exists(labels, lambda x: normal_label(x) == "rowing")
    combined = family.isin(*COMBINED_FAMILIES) & by_navigation
    any_ = F.coalesce(gendered, F.lit(False)) | F.coalesce(rowing, F.lit(False)) | labels_match(labels, aliases) | F.coalesce(combined, F.lit(False))
    return ~wrong & ~conflict & any_


def roster_gender_matches(declared: Column, expected: Column) -> Column:
    """A player without a gender is anyone's; another gender's player is dropped."""
    none = F.lit(None).cast("string")
    actual = sport_gender(declared, none, none)
    return declared.isNull() | (declared == "") | expected.isNull() | actual.eqNullSafe(expected)


def categories_fit(categories: Column, expected: Column, title: Column) -> Column:
    """Whether a conference story's categories are the sport's and no other's (F11); joint basketball pages count for both."""
    parts = F.filter(F.transform(F.split(categories, ","), lambda x: F.trim(x)), lambda x: x != "")
    alone = F.forall(parts, lambda x: (x == expected) | (x == "General"))
    joint = expected.isin(*BASKETBALLS) & F.forall(parts, lambda x: x.isin("General", *BASKETBALLS))
    joint &= title.rlike("(?i)basketball") & title.rlike("(?i)(?:schedule|media day)")
    return F.coalesce(F.array_contains(parts, expected) & (alone | joint), F.lit(False))


def conference_article(url: Column, host: Column) -> Column:
    """Whether an address is a story of the conference's own site."""
    path = F.regexp_replace(url, "^https://[^/?#]*", "")
    own = F.lower(F.regexp_extract(url, "^https://([^/?#]*)", 1)) == host
    return F.coalesce(own & path.rlike(r"^/news/20\d{2}/\d{1,2}/\d{1,2}/[^/?#]+\.aspx$"), F.lit(False))


def without_excluded(records: DataFrame, excluded: DataFrame, keys: list[str]) -> DataFrame:
    """Records whose address no other extractor has excluded."""
    return records.join(excluded.select(*keys).distinct(), keys, "left_anti")


def filled_from_metadata(cards: DataFrame, metadata: DataFrame, keys: list[str]) -> DataFrame:
    """Cards with what a story object of the same address and title says where they say nothing.

    Both: keys, url, title, published, image_url, image_alt, author; metadata also pos, of equal addresses the last counts.
    """
    fields = ("published", "image_url", "image_alt", "author")
    last = metadata.groupBy(*keys, "url").agg(F.max_by(F.struct("title", *fields), "pos").alias("m"))
    known = last.select(*keys, "url", F.col("m.title").alias("title"), *(F.col(f"m.{c}").alias(f"m_{c}") for c in fields))
    out = cards.join(known, [*keys, "url", "title"], "left")
    for c in fields:
        out = out.withColumn(c, F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"m_{c}"))).drop(f"m_{c}")
    return out


def within_records(rows: DataFrame, keys: list[str], most: int = MAX_RECORDS) -> DataFrame:
    """Documents with how many records they have and the code of what is wrong with that.

    rows: keys, id (null: no record), empty_confirmed.  None without confirmation, and more than ``most``, are errors.
    """
    n = rows.groupBy(*keys).agg(F.count("id").alias("candidates"), F.count_distinct("id").alias("n_records"), F.bool_or("empty_confirmed").alias("confirmed"))
    code = F.when(F.col("candidates") > most, "record-budget-exceeded").when(
        (F.col("n_records") == 0) & ~F.coalesce("confirmed", F.lit(False)), "source-format-changed"
    )
    return n.select(*keys, "n_records", code.alias("error_code"))


def official_records(stories: DataFrame, programs: DataFrame, keys: list[str]) -> DataFrame:
    """The records of official pages for one program each (P4): scope, exclusions, cards filled, merged by address.

    stories: keys, pos, extractor, title, url (resolved), published_at, published_at_precision, image_url, image_alt, author,
    labels, primary_labels, excluded.  programs: keys, source_url, hosts, expected, slug, aliases, routes (both arrays).
    """
    rows = stories.join(programs, keys)
    own = safe_url(F.col("url")).isNotNull() & F.array_contains("hosts", host_of(F.col("url")))
    story = own & (F.col("url") != F.col("source_url")) & F.col("url").rlike(r"^https://[^/]*/(?:[^?#]*/)?[A-Za-z0-9]")
    rows = rows.withColumn("title", tidy(F.col("title"))).where(F.coalesce(story, F.lit(False)))
    told_off = F.col("excluded") | label_conflicts(F.col("primary_labels"), F.col("expected"), F.col("slug"))
    excluded = rows.where(told_off).select(*keys, "url")
    by_route = F.arrays_overlap(F.array(F.regexp_extract("url", r"^https://[^/]*/sports?/([a-z0-9-]+)", 1)), F.col("routes"))
    fits = ~label_conflicts(F.col("labels"), F.col("expected"), F.col("slug")) & (labels_match(F.col("labels"), F.col("aliases")) | by_route)
    kept = rows.where(~told_off & F.col("title").isNotNull() & F.coalesce(fits, F.lit(False)))
    merged = precision_merge(without_excluded(kept, excluded, [*keys, "url"]), [*keys, "url"])
    return merged.withColumn("author", clean_author(F.col("author"))).withColumn("id", stable_id(*(F.col(k) for k in keys), F.col("url")))


def game_name(school: Column, opponent: Column, home_away: Column) -> Column:
    """"School vs Opponent", or "at" for away games."""
    return F.concat(clean_text(school, 100), F.when(home_away == "away", " at ").otherwise(" vs "), opponent)


def service_rows(text: Column, most: int) -> Column:
    """The error code of a conference service's answer {error, data: [objects]}, or null."""
    data = F.get_json_object(text, "$.data")
    n = F.json_array_length(data)
    error = F.get_json_object(text, "$.error")
    bad = n.isNull() | (n > most) | (error.isNotNull() & ~error.isin("", "false", "0"))
    objects = F.forall(F.from_json(data, "array<string>"), lambda x: x.startswith("{"))
    return F.when(F.coalesce(bad, F.lit(True)), "invalid-service-response").when(~F.coalesce(objects, F.lit(False)), "invalid-service-record")


def bounded_field(value: Column, most: int = MAX_SCALAR) -> Column:
    """A field within its budget: struct (value, error); null is the empty text."""
    over = F.char_length(value) > most
    return F.struct(F.when(~F.coalesce(over, F.lit(False)), F.coalesce(value, F.lit(""))).alias("value"), F.when(over, "field-exceeds-budget").alias("error"))


def confirmed_conference_news(stories: DataFrame, bodies: DataFrame, keys: list[str], most: int = 10) -> DataFrame:
    """Conference stories that are the school's (P21, U2): named in the title, or in the body where that may be asked for.

    stories: keys, url, title, categories, summary, published_at, filtered (from the school's own list), expected, host,
    school_name (a pattern); the same story of both lists counts once, as filtered if either is.
    bodies: keys, url, text of the pages that were fetched.
    """
    from tidewire.operators.windows import first_candidates

    rest = [c for c in stories.columns if c not in (*keys, "url", "filtered")]
    # the first list that has the story tells its fields
    one = stories.groupBy(*keys, "url").agg(F.min_by(F.struct(*rest), "filtered").alias("s"), F.bool_or("filtered").alias("filtered"))
    one = one.select(*keys, "url", "filtered", *(F.col(f"s.{c}").alias(c) for c in rest))
    one = one.where(conference_article(F.col("url"), F.col("host"))).withColumn("title", clean_text(F.col("title")))
    one = one.where((F.col("title") != "") & categories_fit(F.col("categories"), F.col("expected"), F.col("title")))
    in_title = F.regexp_like("title", F.col("school_name"))
    asked = one.where(~in_title & (F.col("filtered") | F.regexp_like("summary", F.col("school_name"))))
    confirmed = first_candidates(asked, keys, "url", "published_at", most).select(*keys, "url").join(bodies, [*keys, "url"])
    named = one.select(*keys, "url", "school_name").join(confirmed, [*keys, "url"]).where(F.regexp_like("text", F.col("school_name")))
    ok = named.select(*keys, "url").withColumn("in_body", F.lit(True))
    out = one.join(ok, [*keys, "url"], "left").where(in_title | F.coalesce("in_body", F.lit(False)))
    return out.withColumn("confirmed_by", F.when(in_title, "title").otherwise("body")).drop("in_body")


def followed(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """The first page of a fallback chain that has records (P22): keys, step, url, error_code.

    candidates: keys, step (0: the page itself, then declared archive, entrance, linked archive, service), url, n_records,
    error_code.  If none has, the page's own error stays.  At most one hop is followed, so steps never chain.
    """
    good = F.col("error_code").isNull() & (F.col("n_records") > 0)
    best = candidates.groupBy(*keys).agg(
        F.min_by(F.struct("step", "url", "n_records"), F.when(good, F.col("step"))).alias("b"),
        F.min_by("url", "step").alias("own_url"), F.min_by(F.coalesce("error_code", F.lit("source-format-changed")), "step").alias("own_error"),
    )
    return best.select(
        *keys, F.coalesce("b.step", F.lit(0)).alias("step"), F.coalesce("b.url", "own_url").alias("url"), F.coalesce("b.n_records", F.lit(0)).alias("n_records"),
        F.when(F.col("b").isNull(), F.col("own_error")).alias("error_code"), F.col("own_url").alias("discovery_source_url"),
    )
