"""A query and its SQL stand together; importing a module of queries registers them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: The survey's operators that each query runs.
OPERATORS: dict[str, tuple[str, ...]] = {}


class Tables:
    """The tables of one folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows that are about to become documents, dealt over all slots: a table of few megabytes is read by one task, whatever its rows grow to."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism), key)


def query(sql: str | None = None, ops: str = ""):
    """Register a function of ``Tables`` under its name; ``ops`` are the survey's ids."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        OPERATORS[f.__name__] = tuple(ops.split())
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def value_sql(v) -> str:
    """A value as a DuckDB literal."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, list):
        return "[" + ", ".join(map(value_sql, v)) + "]"
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v.isoformat(' ')}'"
    return "'" + str(v).replace("'", "''") + "'"


def pick_sql(key: str, values: list, kind: str | None = None) -> str:
    """The value at the key's remainder, in DuckDB."""
    got = f"([{', '.join(map(value_sql, values))}])[CAST({key} % {len(values)} AS INTEGER) + 1]"
    return f"CAST({got} AS {kind})" if kind else got


def pick(key: Column, values: list, kind: str) -> Column:
    """The value at the key's remainder: a column that takes each of ``values`` in turn over a whole table."""
    literal = lambda v: F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)
    return F.element_at(F.array(*(literal(v).cast(kind) for v in values)), (key % len(values) + 1).cast("int"))


def cases(
    name: str, ops: str, table: str, key: str, inputs: dict[str, tuple[str, list]], outputs: dict[str, tuple[str, list]],
    make: Callable[[dict[str, Column]], dict[str, Column]],
) -> None:
    """Register a query that runs column functions over a whole table, whose rows take the cases in turn by their key.

    inputs: (Spark type, values); outputs: (DuckDB type, what each case must give).
    """

    def run(t: Tables) -> DataFrame:
        rows = getattr(t, table).select(key, *(pick(F.col(key), values, kind).alias(c) for c, (kind, values) in inputs.items()))
        made = make({c: F.col(c) for c in inputs})
        return rows.select(key, *(v.alias(c) for c, v in made.items()))

    run.__name__ = name
    told = ", ".join(f"{pick_sql(key, values, kind)} AS {c}" for c, (kind, values) in outputs.items())
    query(f"SELECT {key}, {told} FROM {table}", ops)(run)
