"""Text: cleaning, keys, identifiers, folding, credential scans, people's names."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

# What no published text may contain.
CREDENTIALS = (
    r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----"
    r"|\bgh[pousr]_[A-Za-z0-9]{30,}|\bgithub_pat_[A-Za-z0-9_]{40,}|\bAKIA[A-Z0-9]{16}\b"
    r"|\bsk-(?:proj-)?[A-Za-z0-9_-]{32,}|\bBearer\s+[A-Za-z0-9._-]{20,}"
)
LOCAL_PATHS = r"(?i)[A-Z]:[\\/]Users[\\/]|/(?:home|Users)/[^/\s]+/"
MAX_INPUT = 10_000


def clean_text(value: Column, longest: int = 300) -> Column:
    """Plain one-line text: tags, angle brackets and control characters out, white space single."""
    text = F.substring(F.coalesce(value.cast("string"), F.lit("")), 1, MAX_INPUT)
    text = F.regexp_replace(text, "<[^>]*>", " ")
    text = F.regexp_replace(text, r"[<>\x00-\x1f\x7f]", " ")
    text = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.substring(text, 1, longest)


def tidy(value: Column, longest: int = 300) -> Column:
    """Cleaned text, or null if nothing is left."""
    return F.nullif(clean_text(value, longest), F.lit(""))


def has_credential(value: Column) -> Column:
    """Whether a text looks like a secret or names a local user's folder."""
    text = F.coalesce(value, F.lit(""))
    return text.rlike(CREDENTIALS) | text.rlike(LOCAL_PATHS)


def stable_id(*parts: Column) -> Column:
    """24 hex digits of the SHA-256 of the parts joined by bars; a null part counts as empty (T4)."""
    joined = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.substring(F.sha2(joined.cast("binary"), 256), 1, 24)


def words_key(value: Column) -> Column:
    """Letters and digits in lower case, all else one space (the first part of T8)."""
    return F.trim(F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}]+", " "))


def title_key(title: Column, published_at: Column, url: Column) -> Column:
    """Two articles with equal keys are the same headline of the same day."""
    day = F.coalesce(F.date_format(published_at, "yyyy-MM-dd"), url)
    return F.concat(words_key(title), F.lit("|"), day)


def _folded(form: str):
    @pandas_udf("string")
    def fold(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda t: "".join(c for c in unicodedata.normalize(form, t) if not "\u0300" <= c <= "\u036f"),
            na_action="ignore",
        )

    return fold


def fold(value: Column, form: str = "NFKD") -> Column:
    """Compatibility decomposition without combining marks.  An Arrow UDF: the JVM side has no normaliser.

    Plain ASCII stays as it is and is not sent to Python.
    """
    return F.coalesce(_folded(form)(F.when(value.rlike(r"[^\x00-\x7f]"), value)), value)


def slugify_ascii(value: Column) -> Column:
    """The part of a slug's making that needs no folding."""
    text = F.regexp_replace(F.lower(value), "['’\"]", "")
    text = F.regexp_replace(F.regexp_replace(text, "&", " and "), "[^a-z0-9]+", "-")
    return F.regexp_replace(text, "^-+|-+$", "")


def slugify(value: Column) -> Column:
    return slugify_ascii(fold(value))


def ascii_words(value: Column) -> Column:
    """Lower-case ASCII words with single spaces, ``&`` read as "and" (T15, without folding)."""
    text = F.regexp_replace(F.lower(F.coalesce(value, F.lit(""))), "&", " and ")
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def school_name_key(value: Column) -> Column:
    """A school's name without the words that most of them share."""
    text = F.regexp_replace(ascii_words(value), r"\b(university|college|the|of)\b", " ")
    return F.trim(F.regexp_replace(text, " +", " "))


def has_phrase(text: Column, phrase: Column) -> Column:
    """Whether folded text has the phrase as whole words."""
    return F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), phrase, F.lit(" ")))


def clean_author(value: Column) -> Column:
    """A byline's name or null."""
    name = clean_text(F.regexp_replace(value, r"(?i)^\s*by\s*:?\s+", ""))
    bad = (name == "") | F.lower(name).isin("null", "undefined") | (F.char_length(value) > 4096)
    return F.when(value.isNull() | bad, F.lit(None)).otherwise(name)


def authors(values: Column, most: int = 8) -> Column:
    """Distinct names of an array of bylines, in order."""
    names = F.transform(F.slice(values, 1, most), clean_author)
    return clean_author(F.nullif(F.array_join(F.array_distinct(F.filter(names, lambda n: n.isNotNull())), ", "), F.lit("")))


def cell(value: Column) -> Column:
    """Escaped for a Markdown table."""
    text = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    text = F.replace(F.replace(text, F.lit(">"), F.lit("&gt;")), F.lit("|"), F.lit("\\|"))
    return F.regexp_replace(text, r"[\r\n]+", " ")


def plain(html: Column, longest: int = 300) -> Column:
    """Text of a fragment of HTML without what scripts, styles and frames hold."""
    text = F.regexp_replace(html, r"(?is)<(script|style|noscript|iframe)\b[^>]*>.*?</\1\s*>", " ")
    text = F.regexp_replace(text, "<[^>]*>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return clean_text(text, longest)


def digest(value: Column) -> Column:
    """SHA-256 in hex of a text's bytes."""
    return F.sha2(value.cast("binary"), 256)


def commit_id(value: Column) -> Column:
    """40 lower-case hex digits, or null."""
    return F.when(value.rlike("^[a-f0-9]{40}$"), value)


def exact_keys(document: Column, keys: list[str]) -> Column:
    """Whether a JSON object has exactly these keys."""
    return F.coalesce(F.array_sort(F.json_object_keys(document)) == F.array(*map(F.lit, sorted(keys))), F.lit(False))


def public_json(document: Column) -> Column:
    """struct (value, error): a text that parses as JSON; the code withholds the contents."""
    value = F.try_parse_json(document)
    bad = document.isNull() | value.isNull()
    return F.struct(F.when(~bad, document).alias("value"), F.when(bad, "malformed-public-json").alias("error"))


def decoded_utf8(body: Column) -> Column:
    """Bytes as text if they are valid UTF-8, else null."""
    return F.try_validate_utf8(body.cast("string"))
