"""Enrichment of articles with what their own pages declare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import clean_author, clean_text, fold, words_key
from tidewire.functions.urls import article_identity, host_of, resolve_each, safe_url
from tidewire.operators.windows import enrichment_rank, needs_enrichment

# Paths of brand images that sites declare where an article has no photo.
BRAND_IMAGES = r"(?i)/images/logos/site/site\.(?:png|svg|jpe?g|webp)$"
BRAND_PATHS = ("/wp-content/themes/arkansasTheme/assets/images/ark-logo-left.png",)
DEFAULT_IMAGES = (
    r"(?i)^https://(?:[^/]*\.)?foxsports\.com/[^?#]*/?static/orion/images/defaults/(?:\d+/\d+/)?story-card\.jpg(?:[?#]|$)"
    r"|^https://(?:[^/]*\.)?cbsistatic\.com/[^?#]*/?bundles/sportsmediacss/images/fantasy/default-article-image-large\.png(?:[?#]|$)"
)


def title_identity(value: Column) -> Column:
    """The form in which titles are compared."""
    return words_key(fold(clean_text(value, 1000), "NFKC"))


def title_identities(values: Column) -> Column:
    """``title_identity`` of every title of an array; null stays null."""
    cleaned = F.transform(values, lambda v: F.when(v.isNotNull(), clean_text(v, 1000)))
    # cleaned texts have no control characters, so all are folded as one text
    folded = F.split(fold(F.array_join(F.transform(cleaned, lambda v: F.coalesce(v, F.lit(""))), "\x01"), "NFKC"), "\x01")
    return F.transform(folded, lambda v, i: F.when(F.get(values, i).isNotNull(), words_key(v)))


def article_image(image: Column, page: Column) -> Column:
    """A declared image that is a photo: safe, not the page or its home, no brand image."""
    url = safe_url(image)
    path = F.regexp_replace(F.regexp_replace(url, r"^https://[^/?#]*", ""), r"[?#].*$", "")
    home = (host_of(url) == host_of(page)) & path.isin("", "/") & ~F.contains(url, F.lit("?"))
    # a resizing service names the image in its own address
    nested = F.coalesce(safe_url(F.try_url_decode(F.regexp_extract(url, r"[?&]url=([^&#]*)", 1))), F.lit(""))
    brand = lambda u, p: u.rlike(DEFAULT_IMAGES) | p.rlike(BRAND_IMAGES) | p.isin(*BRAND_PATHS)
    inner = F.regexp_replace(F.regexp_replace(nested, r"^https://[^/?#]*", ""), r"[?#].*$", "")
    return F.when(~(article_identity(url) == article_identity(page)) & ~home & ~brand(url, path) & ~brand(nested, inner), url)


# Kinds of nodes that describe an article, kinds of their authors, and bounds of their lists.
ARTICLE_TYPES, WRITER_TYPES = ("NewsArticle", "Article", "BlogPosting"), ("Person", "Organization")
MAX_NODES, MAX_WRITERS = 100, 8


def structured_nodes(scripts: Column) -> Column:
    """headline, address, writers, image of the article nodes in a page's JSON-LD scripts, in their order.

    A script holds a node, a list of them, or a graph; one of more than ``MAX_NODES`` nodes, or that is no JSON, says nothing.
    """

    def text(value: Column, path: str = "$") -> Column:
        at = F.try_variant_get(value, path, "variant")
        return F.when(F.schema_of_variant(at) == "STRING", F.try_variant_get(value, path, "string"))

    def nodes(json: Column) -> Column:
        v = F.try_parse_json(json)
        listed = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.try_variant_get(v, "$['@graph']", "array<variant>"))
        alone = F.when(v.isNotNull() & F.try_variant_get(v, "$['@graph']", "variant").isNull(), F.array(v))
        found = F.coalesce(listed, alone, F.array().cast("array<variant>"))
        return F.when(F.size(found) <= MAX_NODES, found).otherwise(F.array().cast("array<variant>"))

    def told(n: Column) -> Column:
        writer = lambda w: F.coalesce(text(w), F.when(text(w, "$['@type']").isin(*WRITER_TYPES), text(w, "$.name")))
        several = F.coalesce(F.try_variant_get(n, "$.author", "array<variant>"), F.array(F.try_variant_get(n, "$.author", "variant")))
        image = F.coalesce(F.try_variant_get(n, "$.image[0]", "variant"), F.try_variant_get(n, "$.image", "variant"))
        return F.struct(
            F.nullif(text(n, "$.headline"), F.lit("")).alias("headline"), F.coalesce(text(n, "$.url"), text(n, "$.mainEntityOfPage['@id']")).alias("address"),
            F.array_compact(F.transform(F.slice(several, 1, MAX_WRITERS), writer)).alias("writers"), F.coalesce(text(image), text(image, "$.url")).alias("image"),
        )

    articles = F.filter(F.flatten(F.transform(scripts, nodes)), lambda n: F.coalesce(text(n, "$['@type']").isin(*ARTICLE_TYPES), F.lit(False)))
    return F.transform(articles, told)


def with_structured_metadata(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Pages with ld_author and ld_image: of the nodes that are about the page's article, the first author and the first photo.

    Whether a node is about it is decided node by node: a headline must be the article's, and an address too, where it has one.  Nodes
    carry their page along, so a page is parsed once, and its nodes meet again by its keys and address.
    """
    page = F.col("url")
    rows = pages.withColumn("nodes", structured_nodes(F.col("structured"))).drop("structured")
    rows = rows.withColumn("heads", title_identities(F.concat(F.array("title"), F.transform("nodes", lambda n: n["headline"]))))
    rows = rows.withColumn("links", resolve_each(F.transform("nodes", lambda n: n["address"]), page))
    rows = rows.withColumn("images", resolve_each(F.transform("nodes", lambda n: n["image"]), page))
    n = rows.select("*", F.posexplode_outer("nodes").alias("at", "node"))
    n = n.withColumn("head", F.get("heads", F.col("at") + 1)).withColumn("link", F.get("links", "at")).withColumn("photo", F.get("images", "at"))
    same = (F.col("head").isNull() | (F.col("head") == F.get("heads", F.lit(0)))) & (
        F.col("link").isNull() | F.coalesce(article_identity(F.col("link")) == article_identity(page), F.lit(False))
    )
    names = F.array_distinct(F.filter(F.transform("node.writers", clean_author), lambda x: x.isNotNull()))
    author = F.when(F.size(names) > 0, clean_author(F.array_join(names, ", ")))
    n = n.withColumn("ld_author", F.when(same, author)).withColumn("ld_image", F.when(same, article_image(F.col("photo"), page)))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("at"))).alias(c)
    own = [c for c in pages.columns if c not in (*keys, "url", "structured")]
    return n.groupBy(*keys, "url").agg(*(F.first(c).alias(c) for c in own), first("ld_author"), first("ld_image"))


def confirmed_metadata(pages: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Image, its text and author of pages that are the article asked for (P24): keys, url, error_code, found_image, found_alt, found_author.

    pages: keys and url (one page each), title, perhaps hosts (those of the school, without www.), and a row of
    ``sources.parsers.article_metadata``.  ``error_code`` says of a page that it is outside the school's hosts, declares another
    address in any of its declarations, or confirms neither the title nor that it is the article.
    """
    page = F.col("url")
    keys = [k for k in keys or [] if k != "url"]
    rows = with_structured_metadata(pages.withColumn("declared", F.filter(resolve_each(F.col("declared"), page), lambda d: d.isNotNull())), keys)
    none = F.array().cast("array<string>")
    rows = rows.withColumn("named", title_identities(F.concat(F.array("title", "og_title"), F.coalesce("headings", none))))
    rows = rows.withColumn("shown", resolve_each(F.array("og_image", "body_image"), page))
    outside = safe_url(page).isNull()
    if "hosts" in pages.columns:
        outside |= ~F.coalesce(F.array_contains("hosts", host_of(page)), F.lit(False))
    other = F.exists("declared", lambda d: article_identity(d) != article_identity(page))
    title = F.get("named", F.lit(0))
    named = F.array_contains(F.slice("named", 2, F.size("named")), title)
    is_article = (F.size("declared") > 0) & (F.col("og_type") == "article")
    code = (
        F.when(outside, "article-outside-scope").when(F.coalesce(other, F.lit(False)), "article-identity-mismatch")
        .when((F.coalesce(title, F.lit("")) == "") | ~F.coalesce(named | is_article, named, is_article, F.lit(False)), "article-identity-not-confirmed")
    )
    graph, body = article_image(F.get("shown", F.lit(0)), page), article_image(F.get("shown", F.lit(1)), page)
    image = F.coalesce(graph, "ld_image", body)
    text_of = lambda c: F.nullif(clean_text(F.col(c)), F.lit(""))
    alt = F.coalesce(F.when(image == graph, text_of("og_image_alt")), F.when(image == body, text_of("body_alt")))
    author = F.coalesce("ld_author", clean_author(F.col("author")), clean_author(F.col("byline")))
    rows = rows.withColumn("code", code)
    good = F.col("code").isNull()
    return rows.select(
        *keys, "url", F.col("code").alias("error_code"), F.when(good, image).alias("found_image"), F.when(good, alt).alias("found_alt"), F.when(good, author).alias("found_author")
    )


def candidates(records: DataFrame, keys: list[str], observed_at: Column, limit: int = 5) -> DataFrame:
    """The records whose pages are to be asked for, in order, within the budget."""
    due = records.where(needs_enrichment(observed_at) & safe_url(F.col("url")).isNotNull())
    return enrichment_rank(due, keys).where(F.col("enrich_rank") <= limit)


def apply_metadata(records: DataFrame, asked: DataFrame, metadata: DataFrame, keys: list[str], observed_at: Column) -> DataFrame:
    """Records with what was found; what they had stays, and every record asked for counts as checked."""
    tried = asked.select(*keys, "url").withColumn("asked", F.lit(True))
    good = metadata.where("error_code is null")
    out = records.join(tried, [*keys, "url"], "left").join(good.drop("error_code"), "url", "left")
    use = F.coalesce("asked", F.lit(False))
    same = F.col("image_url").isNull() | (F.col("image_url") == F.col("found_image"))
    alt = F.when(F.col("image_url").isNull(), F.col("found_alt")).otherwise(F.coalesce("image_alt", F.when(same, F.col("found_alt"))))
    return (
        out.withColumn("image_alt", F.when(use, alt).otherwise(F.col("image_alt")))
        .withColumn("image_url", F.coalesce("image_url", F.when(use, F.col("found_image"))))
        .withColumn("author", F.coalesce("author", F.when(use, F.col("found_author"))))
        .withColumn("metadata_checked_at", F.when(use, observed_at).otherwise(F.col("metadata_checked_at")))
        .drop("asked", "found_image", "found_alt", "found_author")
    )


def as_asked(records: DataFrame, asked: str, provenance: str) -> DataFrame:
    """Records of a page that was followed, as of the page that was asked for."""
    return records.withColumn(provenance, F.col(asked)).drop(asked)
