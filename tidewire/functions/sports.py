"""Sport labels: normal form, gender, base sport, family, aliases, routing by label and route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sports whose name needs no gender, and the short codes sites use.
UNGENDERED = ("football", "baseball", "softball", "field hockey", "beach volleyball", "stunt", "acrobatics and tumbling")
SHORT_CODES = {
    "basketball": ("bball", "bb", "bkb", "-baskbl", "-basketball"),
    "soccer": ("soc", "-soccer"),
    "volleyball": ("vball", "vb", "-volley"),
    "tennis": ("ten",),
    "golf": ("golf",),
    "lacrosse": ("lax",),
    "fencing": ("fence", "fen"),
    "cross country": ("xc", "cross"),
    "track and field": ("track", "tf"),
    "indoor track and field": ("itrack", "itf"),
    "outdoor track and field": ("otrack", "otf"),
    "swimming and diving": ("swim", "swim-dive", "sd"),
    "rowing": ("row", "crew"),
    "ice hockey": ("ice", "hockey"),
    "gymnastics": ("gym",),
    "water polo": ("polo", "wp", "wpolo"),
    "skiing": ("ski",),
    "wrestling": ("wrest", "wres"),
    "squash": ("squash",),
    "rugby": ("rugby",),
}
#: Further names, for base sports: with {g} the gender and {p} its letter.
GENDERED_NAMES = {
    "swimming and diving": ("{g} swimming", "{g} swim"),
    "track and field": ("{g} track",),
    "ice hockey": ("{g} hockey",),
    "crew": ("{g} rowing", "{p}row", "{p}crew", "{g} heavyweight rowing"),
    "rowing": ("{g} heavyweight rowing",),
    "lightweight crew": ("{g} lightweight rowing", "{p}lrow", "{p}lcrew", "{p}lr", "{p}row-l"),
    "lightweight football": ("{g} sprint football", "sprint football", "sprint"),
    "synchronized swimming": ("{g} artistic swimming",),
    "indoor track and field": ("{g} indoor track", "{g} track and field", "{g} track", "{p}track", "{p}tf"),
    "outdoor track and field": ("{g} outdoor track", "{g} track and field", "{g} track", "{p}track", "{p}tf"),
}
PLAIN_NAMES = {
    "football": ("fb", "fball", "m-footbl"),
    "baseball": ("base", "bsb", "m-basebl"),
    "softball": ("soft", "sball", "sb", "w-softbl"),
    "acrobatics and tumbling": ("acrobatics", "acrobatics tumbling"),
}

# Rewrites of a lower-case label, in order (T17), of its base and its family.
LABEL_STEPS = (
    (r"^cross[- ]country-women$", "womens cross country"),
    (r"^(.*?)\s*\(w\)\s*$", "womens $1"),
    (r"^(.*?)\s*\(m\)\s*$", "mens $1"),
    (r"^(.*?)\s*[-–—]\s*women['’]?s\s*$", "womens $1"),
    (r"^(.*?)\s*[-–—]\s*men['’]?s\s*$", "mens $1"),
    (r"[’']", ""),
    (r"&", " and "),
    (r"[-_/]", " "),
    (r"\b(women|woman|female)\b", "womens"),
    (r"\b(men|man|male)\b", "mens"),
    (r"[^a-z0-9 ]", " "),
    (r" +", " "),
    (r"^ | $", ""),
    (r"^(mens |womens )?rowing (lightweight|heavyweight|open)$", "$1$2 rowing"),
    (r"^(mens |womens )?rowing heavy$", "$1heavyweight rowing"),
    (r"^(mens |womens )heavy rowing$", "$1heavyweight rowing"),
)
_BASE_STEPS = (
    (r"^(mens|womens|mixed|coed) ", ""),
    (r"^(indoor|outdoor) track$", "$1 track and field"),
    (r"^track (indoor|outdoor)$", "$1 track and field"),
    (r"^track$", "track and field"),
    (r"^swimming( diving)?$", "swimming and diving"),
    (r"^crosscountry$", "cross country"),
)
_FAMILY_STEPS = (
    (r"^(indoor|outdoor) track and field$", "track and field"),
    (r"^(heavyweight )?crew$", "rowing"),
    (r"^lightweight crew$", "lightweight rowing"),
)


def _rewritten(text: Column, steps) -> Column:
    for pattern, to in steps:
        text = F.regexp_replace(text, pattern, to)
    return text


def normal_label(value: Column) -> Column:
    """The normal form of a sport's label; empty if null or over 200 characters."""
    text = F.when(value.isNull() | (F.char_length(value) > 200), "").otherwise(F.lower(value))
    return _rewritten(text, LABEL_STEPS)


def sport_gender(gender: Column, name: Column, slug: Column) -> Column:
    """womens, mens, coed or null: as declared, else as the name or slug begins."""
    told = F.lower(F.coalesce(gender, F.lit("")))
    begins = lambda c: F.nullif(F.regexp_extract(normal_label(c), "^(womens|mens) ", 1), F.lit(""))
    return (
        F.when(told.isin("f", "w", "female", "women", "womens"), "womens")
        .when(told.isin("m", "male", "men", "mens"), "mens")
        .when(told.isin("x", "mixed", "coed", "co-ed"), "coed")
        .otherwise(F.coalesce(begins(name), begins(slug)))
    )


def base_sport(name: Column, slug: Column) -> Column:
    """The sport without its gender."""
    return _rewritten(normal_label(F.coalesce(F.nullif(name, F.lit("")), slug)), _BASE_STEPS)


def sport_family(base: Column) -> Column:
    """Seasons of track are one family, and crew is rowing."""
    return _rewritten(base, _FAMILY_STEPS)


def alias_rows(programs: DataFrame) -> DataFrame:
    """A row per (program, alias) of programs(program_id, slug, name, code, gender[, aliases]).

    Computed once as a dimension; matching a label is then an equi-join.
    """
    spark: SparkSession = programs.sparkSession
    # broadcast below: tables of the fixed values above, some hundred rows whatever the programs
    more = [(base, "{p}" + code) for base, codes in SHORT_CODES.items() for code in codes]
    more += [(base, name) for base, names in GENDERED_NAMES.items() for name in names]
    gendered = spark.createDataFrame(more, "base string, pattern string")
    plain = spark.createDataFrame([(b, n) for b, ns in PLAIN_NAMES.items() for n in ns], "base string, pattern string")
    own = F.col("aliases") if "aliases" in programs.columns else F.lit(None).cast("array<string>")
    p = programs.select(
        "program_id",
        sport_gender(F.col("gender"), F.col("name"), F.col("slug")).alias("g"),
        base_sport(F.col("name"), F.col("slug")).alias("base"),
        normal_label(F.col("slug")).alias("slug_label"),
        normal_label(F.col("name")).alias("name_label"),
        normal_label(F.col("code")).alias("code_label"),
        F.slice(F.coalesce(own, F.array()), 1, 100).alias("own"),
    )
    safe = lambda c: F.when(F.col("g").isNull() | c.rlike("^(mens|womens|mixed|coed) ") | c.isin(*UNGENDERED), c)
    said = F.concat(F.coalesce(F.concat(F.col("g"), F.lit(" ")), F.lit("")), F.col("base"))
    labels = F.array(
        safe(F.col("slug_label")), safe(F.col("name_label")), F.col("code_label"), normal_label(said),
        F.when(F.col("base").isin(*UNGENDERED), F.col("base")),
    )
    direct = p.select("program_id", F.explode(F.concat(labels, F.transform("own", normal_label))).alias("alias"))
    letter = F.when(F.col("g") == "womens", "w").otherwise("m")
    filled = F.replace(F.replace(F.col("pattern"), F.lit("{p}"), letter), F.lit("{g}"), F.col("g"))
    by_gender = (
        p.where(F.col("g").isin("womens", "mens")).join(F.broadcast(gendered), "base").select("program_id", normal_label(filled).alias("alias"))
    )
    by_name = p.join(F.broadcast(plain), "base").select("program_id", normal_label(F.col("pattern")).alias("alias"))
    return direct.unionByName(by_gender).unionByName(by_name).where("alias <> ''").distinct()


def match_labels(labels: DataFrame, aliases: DataFrame) -> DataFrame:
    """Adds program_id for every program that a label names, wholly or as its complete parenthesis."""
    inner = F.regexp_extract("label", r"\(([^()]+)\)\s*$", 1)
    forms = F.array_distinct(F.filter(F.array(normal_label(F.col("label")), normal_label(inner)), lambda x: x != ""))
    return labels.withColumn("alias", F.explode(forms)).join(aliases, "alias").drop("alias").distinct()


def route_slugs(url: Column) -> Column:
    """The sport slugs that an official URL declares: /sport(s)/<slug>, /news/Y/M/D/<slug…>, ?path=."""
    text = F.lower(url)
    route = F.regexp_extract(text, r"^[^?#]*/sports?/([a-z0-9-]+)", 1)
    dated = F.regexp_extract(text, r"^[^?#]*/news/\d{4}/\d{1,2}/\d{1,2}/([a-z0-9-]+)", 1)
    query = F.regexp_extract(text, r"[?&]path=([a-z0-9-]+)", 1)
    return F.array_distinct(F.filter(F.array(route, dated, query), lambda x: x != ""))

