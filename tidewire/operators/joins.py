"""Joins of the pipeline that are more than one equi-join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: So many entries may apply to everything in a wildcard join.
MAX_GENERAL = 1000


def wildcard_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``right`` whose keys are equal or null, null meaning any.

    A disjunction would be a nested loop over both tables; instead each pattern of null
    keys is an equi-join on the others.  The pattern without any key has no join key: each of its
    entries goes to every row, so there must be no more than ``MAX_GENERAL`` of them (an error otherwise);
    they stand in the plan as one literal.
    """
    rest = [c for c in right.columns if c not in keys]
    parts = []
    for mask in range(2 ** len(keys)):
        on = [k for i, k in enumerate(keys) if mask >> i & 1]
        off = [k for k in keys if k not in on]
        rows = right.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() if k in on else F.col(k).isNull() for k in keys]))
        rows = rows.select(*on, *rest, *(F.lit(True).alias(f"any_{k}") for k in off), *(F.lit(False).alias(f"any_{k}") for k in on))
        if on:
            parts.append(left.join(rows, on))
        else:
            general = rows.limit(MAX_GENERAL + 1).collect()
            if len(general) > MAX_GENERAL:
                raise ValueError(f"more than {MAX_GENERAL} entries apply to everything")
            kind = T.ArrayType(rows.schema)
            listed = F.array(*(F.struct(*(F.lit(r[c]).cast(rows.schema[c].dataType).alias(c) for c in rows.columns)) for r in general)).cast(kind)
            parts.append(left.select(*left.columns, F.inline(listed)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def missing(expected: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows that were not seen."""
    return expected.select(*keys).distinct().join(seen.select(*keys).distinct(), keys, "left_anti")


def unexpected_or_repeated(seen: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Keys seen that are not expected, or more than once (K12): keys..., n_seen, expected."""
    counts = seen.groupBy(*keys).agg(F.count("*").alias("n_seen"))
    known = expected.select(*keys).distinct().withColumn("expected", F.lit(True))
    out = counts.join(known, keys, "left").withColumn("expected", F.coalesce("expected", F.lit(False)))
    return out.where("not expected or n_seen > 1")


def set_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """What one side has and the other lacks (K13, U6): keys..., side.  Empty if the sets are equal."""
    left, right = a.select(*keys).distinct(), b.select(*keys).distinct()
    only_a = left.join(right, keys, "left_anti").withColumn("side", F.lit("left"))
    return only_a.unionByName(right.join(left, keys, "left_anti").withColumn("side", F.lit("right")))


def unique_owner(pairs: DataFrame, alias: str, owner: str) -> DataFrame:
    """Aliases that one owner has alone."""
    n = pairs.groupBy(alias).agg(F.count_distinct(owner).alias("n"), F.min(owner).alias(owner))
    return n.where("n = 1").drop("n")


def match_unique(left: DataFrame, right: DataFrame, left_id: str, right_id: str, exact: str, loose: str) -> DataFrame:
    """Left rows with the right row of the same exact name, else of the same loose name, if it is the only one
    either way (K14, K15, C9): left_id, right_id, how."""
    exact_names, loose_names = unique_owner(right, exact, right_id), unique_owner(right, loose, right_id)
    loose_left = unique_owner(left, loose, left_id).select(loose)
    first = left.join(exact_names.select(exact, F.col(right_id).alias("r_exact")), exact, "left")
    second = first.join(loose_names.join(loose_left, loose, "left_semi").select(loose, F.col(right_id).alias("r_loose")), loose, "left")
    how = F.when(F.col("r_exact").isNotNull(), "exact").when(F.col("r_loose").isNotNull(), "loose").otherwise("none")
    return second.select(left_id, F.coalesce("r_exact", "r_loose").alias(right_id), how.alias("how"))


#: A key with more rows than this is spread over several tasks by an as-of join.
HOT_ROWS = 1_000_000


def as_of(rows: DataFrame, at: str, facts: DataFrame, fact_at: str, keys: list[str], value: str, ranges: int | None = None, hot: int = HOT_ROWS) -> DataFrame:
    """Each row with the latest value at or before it (K22); of values at one time the largest, null where a key is null.

    Not a range join but one sorted pass over the union of both tables.  If the most frequent key has more than ``hot`` rows, counted
    beforehand, or if ``ranges`` are asked for, the union is cut into ranges of (keys, time), so that a key with very many rows spreads over
    several tasks.  Each range looks back within itself; what it finds nothing for takes the last value of the key in an earlier range, of
    which there is one row per key and range.
    """
    from pyspark.sql import Window

    from tidewire.operators.packing import cut_by_range

    none = F.lit(None).cast(facts.schema[value].dataType)
    tagged = rows.withColumn("__at", F.col(at)).withColumn("__fact", none).withColumn("__row", F.lit(1))
    other = facts.select(*keys, F.col(fact_at).alias("__at"), F.col(value).alias("__fact"), F.lit(0).alias("__row"))
    both = tagged.unionByName(other, allowMissingColumns=True)
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    back = lambda *by: F.last("__fact", ignorenulls=True).over(
        Window.partitionBy(*by).orderBy("__at", "__row", "__fact").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    if ranges is None:
        most = both.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if most <= hot:
            out = both.withColumn("__near", back(*keys)).where("__row = 1")
            return out.withColumn(value, F.when(whole, F.col("__near"))).drop("__at", "__fact", "__row", "__near")
    cut = cut_by_range(both, [*keys, "__at"], ranges)
    near = cut.withColumn("__near", back(*keys, "__range")).where("__row = 1")
    known = F.col("__fact").isNotNull()
    last = cut.groupBy(*keys, "__range").agg(F.max_by(F.when(known, F.col("__fact")), F.when(known, F.struct("__at", "__fact"))).alias("__last"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("__carried", F.last("__last", ignorenulls=True).over(before)).drop("__last")
    out = near.join(carried, [*keys, "__range"], "left")
    return out.withColumn(value, F.when(whole, F.coalesce("__near", "__carried"))).drop("__at", "__fact", "__row", "__range", "__near", "__carried")


def with_previous(rows: DataFrame, previous: DataFrame, keys: list[str], defaults: dict[str, Column] | None = None) -> DataFrame:
    """Rows with what is known of them from before (K1, K2): a left join; ``defaults`` for what is not."""
    out = rows.join(previous, keys, "left")
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), value))
    return out


def replaced(rows: DataFrame, replacements: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows whose columns a reviewed replacement of the same keys overrides (K26); ``replaced`` says which."""
    r = replacements.select(*keys, *(F.col(c).alias(f"__{c}") for c in columns), F.lit(True).alias("replaced"))
    out = rows.join(r, keys, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(f"__{c}", c)).drop(f"__{c}")
    return out.withColumn("replaced", F.coalesce("replaced", F.lit(False)))


def unchanged_files(there: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Manifest rows with whether the bytes are there and the same (K10): keys, agrees.  there: keys, body."""
    told = there.select(*keys, F.sha2(F.col("body").cast("binary"), 256).alias("__sha"), F.octet_length("body").alias("__n"))
    out = manifest.join(told, keys, "left")
    same = (F.col("sha256") == F.col("__sha")) & (F.col("bytes") == F.col("__n"))
    return out.select(*keys, F.coalesce(same, F.lit(False)).alias("agrees"))
