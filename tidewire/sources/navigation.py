"""Menus that pages declare as JSON (P26): a tree becomes rows, and columns and sections hand their gender down.

Older site themes declare their menu as ``var obj = {"type": "main-navigation", "data": [...]}``.  A node has a title, perhaps an address,
items of its own, and a number for the column of the menu it stands in.  A node whose title is only a gender, or a separator, opens a
section: what follows it among its siblings, in its column if it has one, is of that gender, and so is everything below.

The tree is flattened inside the row of its page, level by level, so only one shuffle, by page, is left for the rules that look back.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tidewire.functions.sports import normal_label
from tidewire.functions.text import clean_text
from tidewire.operators.discovery import navigation_label

# Bounds of a menu and of the script that declares it.
MAX_DEPTH, MAX_NODES, MAX_SCRIPT, MAX_TITLE, MAX_URL, MAX_COLUMN = 6, 6000, 2_000_000, 160, 2048, 20
_SCRIPT = re.compile(r"(?is)<script\b[^>]*>(.*?)</script\s*>")
_OBJECT = re.compile(r"\bvar\s+obj\s*=\s*(?=\{)")
#: How the object of a menu begins.
_MENU = re.compile(r"""\{\s*"type"\s*:\s*"main-navigation\"""")
#: The event of a separator: what follows is of the parent's gender again.
_BACK = ""


@pandas_udf(T.ArrayType(T.StringType()))
def declared_objects(texts: pd.Series) -> pd.Series:
    """The JSON literal that follows the first ``var obj =`` of each script, found by its end and never evaluated.

    Null stands for a menu in a script of more than ``MAX_SCRIPT`` characters, which is not decoded.
    """
    decoder = json.JSONDecoder()

    def literals(text):
        out = []
        for script in _SCRIPT.findall(text or ""):
            m = _OBJECT.search(script)
            if m and len(script) > MAX_SCRIPT:
                if _MENU.match(script, m.end()):
                    out.append(None)
            elif m:
                try:
                    out.append(script[m.end() : decoder.raw_decode(script, m.end())[1]])
                except (json.JSONDecodeError, RecursionError):
                    continue
        return out

    return pd.Series([literals(t) for t in texts])


def navigation_gender(label: Column) -> Column:
    """mens or womens if the label says only that (T24); else null."""
    return F.nullif(F.regexp_extract(normal_label(label), "^(mens|womens)(?: sports| varsity)?$", 1), F.lit(""))


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _text(node: Column, name: str) -> Column:
    """A field that is a JSON string; null if it is anything else."""
    at = F.try_variant_get(node, f"$.{name}", "variant")
    return F.when(_kind(at) == "STRING", F.try_variant_get(node, f"$.{name}", "string"))


def menu_nodes(pages: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, place (the positions from the script down), node: every node of a page's menus, down to ``MAX_DEPTH``.

    A menu that is too large to be decoded is one row whose place is only its script's.
    """
    scripts = pages.select(key, F.posexplode(declared_objects(F.col(text))).alias("script", "json"))
    menus = scripts.select(key, "script", F.col("json").isNull().alias("large"), F.try_parse_json("json").alias("menu"))
    menus = menus.where(F.col("large") | (F.try_variant_get("menu", "$.type", "string") == "main-navigation"))
    items = lambda v, path: F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))
    node = lambda place, i, v: F.struct(F.concat(place, F.array(i)).alias("place"), v.alias("node"))
    levels = menus.withColumn("l0", F.transform(items(F.col("menu"), "$.data"), lambda v, i: node(F.array(F.col("script")), i, v)))
    for depth in range(1, MAX_DEPTH + 1):
        below = F.transform(f"l{depth - 1}", lambda n: F.transform(items(n["node"], "$.items"), lambda v, i: node(n["place"], i, v)))
        levels = levels.withColumn(f"l{depth}", F.flatten(below))
    whole = F.array(F.struct(F.array("script").alias("place"), F.col("menu").alias("node")))
    every = F.when(F.col("large"), whole).otherwise(F.concat(*(F.col(f"l{d}") for d in range(MAX_DEPTH + 1))))
    return levels.select(key, F.inline(every))


def declared_navigation(pages: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, error_code, place, title, url, gender: the links of a page's declared menus in their order.

    A page whose menus have more than ``MAX_NODES`` nodes, or a script of more than ``MAX_SCRIPT`` characters, is one row with its error_code; one without a menu has no row.  An address is as
    the menu has it.  ``gender`` is mens, womens, or null where no section says so.
    """
    nodes = menu_nodes(pages, key, text).repartition(key)
    title = F.coalesce(clean_text(_text(F.col("node"), "title"), MAX_TITLE), F.lit(""))
    number = F.try_variant_get("node", "$.column", "variant")
    column = F.when(_kind(number).rlike("^(?:BIGINT|DECIMAL|DOUBLE)"), F.try_variant_get("node", "$.column", "double"))
    column = F.when((column == F.floor(column)) & column.between(0, MAX_COLUMN), column.cast("int"))
    separator = F.try_variant_get("node", "$.separator", "variant")
    opens = F.when(_kind(separator) == "BOOLEAN", F.try_variant_get("node", "$.separator", "boolean"))
    is_node = F.coalesce(_kind(F.col("node")).startswith("OBJECT"), F.lit(False))
    rows = nodes.select(
        key, "place", F.size("place").alias("depth"), F.when(is_node, title).otherwise("").alias("title"), F.when(is_node, column).alias("column"),
        F.when(is_node, opens).alias("opens"), F.when(is_node, _text(F.col("node"), "url")).alias("url"),
    )
    event = F.coalesce(navigation_gender(F.col("title")), F.when(F.col("opens"), _BACK))
    rows = rows.withColumn("event", event).withColumn("parent", F.slice("place", F.lit(1), F.col("depth") - 1))
    before = Window.partitionBy(key, "parent").orderBy("place")
    rows = rows.withColumn("in_section", F.last("event", True).over(before))
    before = Window.partitionBy(key, "parent", "column").orderBy("place")
    own = F.when(F.col("column").isNull(), F.col("in_section")).otherwise(F.last("event", True).over(before))
    # in document order the last node of each lesser depth is an ancestor; the nearest that says something decides
    rows = rows.withColumn("own", F.nullif(own, F.lit(_BACK)))
    down = Window.partitionBy(key).orderBy("place")
    depths = range(2, MAX_DEPTH + 2)
    for d in depths:
        rows = rows.withColumn(f"at{d}", F.last(F.when(F.col("depth") == d, F.struct("own")), True).over(down))
    above = [F.when(F.col("depth") > d, F.col(f"at{d}.own")) for d in reversed(depths)]
    rows = rows.withColumn("gender", F.coalesce("own", *above)).withColumn("n", F.count("*").over(Window.partitionBy(key)))
    rows = rows.withColumn("large", F.bool_or(F.col("depth") == 1).over(Window.partitionBy(key)))
    many = (F.col("n") > MAX_NODES) | F.col("large")
    first = F.row_number().over(down) == 1
    rows = rows.withColumn("error_code", F.when(many, "source-format-changed")).withColumn("first", first)
    link = (F.col("title") != "") & (F.char_length("url") <= MAX_URL)
    shown = lambda c: F.when(~many, F.col(c)).alias(c)
    return rows.where(F.when(many, F.col("first")).otherwise(F.coalesce(link, F.lit(False)))).select(key, "error_code", *map(shown, ("place", "title", "url", "gender")))


def menu_links(pages: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Links of declared menus as ``operators.discovery.sport_links`` reads them: key, pos, label, section, url."""
    found = declared_navigation(pages, key, text).where("error_code is null")
    label = navigation_label(F.col("title"))
    gendered = F.when(F.col("gender").isNull() | normal_label(label).rlike("^(?:mens|womens) "), label).otherwise(F.concat_ws(" ", "gender", label))
    pos = F.row_number().over(Window.partitionBy(key).orderBy("place")) - 1
    return found.select(key, pos.alias("pos"), gendered.alias("label"), F.col("gender").alias("section"), "url")
