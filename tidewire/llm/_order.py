"""Deterministic shards in order of an id, and files that appear complete or not at all."""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from collections.abc import Callable

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The keys' range is cut into so many equal cells; a cell that is too large is cut again, into ``PARTS`` over the range that its rows have.
CELLS, PARTS = 16_384, 16
#: There are no more shards than this, so what the driver holds is bounded; shards of larger tables are larger.
MAX_SHARDS = 65_536
#: Bits of the digest behind the id in a key.
_BITS = 48


def store_of(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all machines share, and the path in it."""
    return pafs.FileSystem.from_uri(uri if ":" in uri.split("/", 1)[0] else "file://" + uri)


def shards(light: DataFrame, shard_bytes: int, overhead: int = 0) -> tuple[Callable[[DataFrame], DataFrame], int]:
    """A function that adds ``shard`` to rows with id and sha, and the number of shards.

    ``light`` has a row for each row to be dealt: id (bigint), sha (hex), n (bytes).  Shards are ranges of (id, first digits
    of sha) in that order, a null id first.  Their bounds come from a histogram of the bytes that is refined where the rows
    are: a cell with more than ``shard_bytes`` is cut anew over the range from its least to its largest key, until it fits or has one
    key only.  So one far id, ids in clusters, and one id with many rows give even shards, and equal tables equal shards.  Rows
    of equal id and content stay together.
    """
    ends = light.agg(F.min("id").alias("lo"), F.sum(F.col("n") + overhead).alias("bytes")).first()
    lo, total = ends["lo"] or 0, ends["bytes"] or 0
    shard_bytes = max(shard_bytes, total // MAX_SHARDS + 1)
    number = F.coalesce(F.col("id").cast("decimal(20,0)") - F.lit(lo) + 1, F.lit(0)).cast("decimal(20,0)")
    digits = F.conv(F.substring("sha", 1, _BITS // 4), 16, 10).cast("decimal(15,0)")
    key = (number * F.lit(1 << _BITS).cast("decimal(15,0)") + digits).cast("decimal(38,0)")
    keyed = light.select(key.alias("key"), (F.col("n") + overhead).alias("n"))
    span = keyed.agg(F.min("key").alias("lo"), F.max("key").alias("hi")).first()
    levels: list[_Level] = []
    # ranges that are cut at a level: (least key, width of a part); the whole table is the only one at first
    cuts = [(int(span["lo"] or 0), (int(span["hi"] or 0) - int(span["lo"] or 0)) // CELLS + 1)]
    rows, parts = keyed.withColumn("child", F.lit(0)), CELLS
    while cuts:
        level = _Level(cuts, parts)
        rows = rows.withColumn("cell", level.cell(F.col("key"), F.col("child")))
        found = rows.groupBy("cell").agg(F.sum("n").alias("bytes"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()
        cuts = []
        for r in sorted(found, key=lambda r: r["cell"]):
            low, high = int(r["lo"]), int(r["hi"])
            level.bytes[r["cell"]] = r["bytes"]
            if r["bytes"] > shard_bytes and low < high:
                level.child[r["cell"]] = len(cuts)
                cuts.append((low, (high - low) // PARTS + 1))
        levels.append(level)
        parts = PARTS
        if cuts:
            rows = rows.withColumn("child", _constant(level.child)[F.col("cell")]).where("child >= 0").select("key", "n", "child")
    n_shards = _number(levels, shard_bytes)

    def deal(df: DataFrame) -> DataFrame:
        out = df.withColumn("__key", key).withColumn("__child", F.lit(0)).withColumn("shard", F.lit(-1))
        for i, level in enumerate(levels):
            cell = F.when(F.col("__child") >= 0, level.cell(F.col("__key"), F.greatest(F.col("__child"), F.lit(0))))
            out = out.withColumn("__cell", cell).withColumn("shard", F.coalesce(_constant(level.first)[F.col("__cell")], F.col("shard")))
            child = _constant(level.child)[F.col("__cell")] if i + 1 < len(levels) else F.lit(-1)
            out = out.withColumn("__child", F.coalesce(child, F.lit(-1)))
        return out.drop("__key", "__child", "__cell")

    return deal, n_shards


class _Level:
    """The cells of one refinement: ``parts`` for each range that is cut."""

    def __init__(self, cuts: list[tuple[int, int]], parts: int):
        self.cuts, self.parts = cuts, parts
        self.bytes, self.child, self.first = ([x] * (len(cuts) * parts) for x in (0, -1, -1))

    def cell(self, key: Column, child: Column) -> Column:
        low = _constant([c[0] for c in self.cuts], "decimal(38,0)")[child]
        width = _constant([c[1] for c in self.cuts], "decimal(38,0)")[child]
        return (child * self.parts + F.call_function("div", key - low, width)).cast("int")


def _number(levels: list[_Level], shard_bytes: int) -> int:
    """Gives every cell that is not cut again its shard, in order; returns how many shards there are."""
    shard, held = 0, 0
    stack = [(0, c) for c in reversed(range(len(levels[0].bytes)))]
    while stack:
        at, c = stack.pop()
        level = levels[at]
        if level.child[c] >= 0:
            begin = level.child[c] * levels[at + 1].parts
            stack += [(at + 1, x) for x in reversed(range(begin, begin + levels[at + 1].parts))]
            continue
        if held and held + level.bytes[c] > shard_bytes:
            shard, held = shard + 1, 0
        level.first[c] = shard
        held += level.bytes[c]
    return shard + 1


def _constant(values: list, kind: str = "int") -> Column:
    """An array of integers that the optimizer folds into one literal."""
    return F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast(f"array<{kind}>")


class RollingFiles:
    """The files of one shard, numbered from 0.

    A file gets its name when it is complete; a task that is repeated writes the
    same bytes under the same names.  What lost tasks leave in ``open`` is never read.
    """

    def __init__(self, folder: str, shard: int, suffix: str):
        self.store, self.path = store_of(folder)
        self.shard, self.suffix, self.seq, self.out = shard, suffix, 0, None
        self.store.create_dir(posixpath.join(self.path, "open"), recursive=True)

    @property
    def name(self) -> str:
        return f"shard-{self.shard:05d}-{self.seq:05d}{self.suffix}"

    def put(self, data: bytes) -> None:
        if self.out is None:
            self.temporary = posixpath.join(self.path, "open", uuid.uuid4().hex)
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self.sha, self.bytes = hashlib.sha256(), 0
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def close(self) -> dict:
        """Complete the file; its manifest row."""
        self.out.close()
        final = posixpath.join(self.path, self.name)
        if self.store.type_name != "local" and self.store.get_file_info(final).type != pafs.FileType.NotFound:
            self.store.delete_file(final)  # of an earlier attempt, with the same bytes
        self.store.move(self.temporary, final)
        row = {"shard": self.shard, "seq": self.seq, "file": self.name, "bytes": self.bytes, "sha256": self.sha.hexdigest()}
        self.seq += 1
        self.out = None
        return row
