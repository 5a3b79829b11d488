"""WARC archives: a deterministic sharded writer, and a reader.

Records are written in order of (id, SHA-1 of the payload).  A histogram of
payload bytes, refined where the rows are, gives the bounds of the shards, so equal
tables give equal files whatever machines write them.  Each shard is sorted and written by one task as a stream: it starts a new file whenever the
compressed size passes ``roll_bytes`` (a shard holds several such files), writes each file under a temporary name,
moves it to its final name when it is complete, and returns a manifest row with
its size and SHA-256.  The manifest is committed by Spark when all tasks have
ended.  A reader takes what the manifest names and nothing else, so files of lost
tasks are harmless, and a task that runs twice writes the same bytes twice.

Of records with equal payloads of at least ``min_revisit_bytes``, the one with the
largest id is the response, the others are revisits that refer to it.  This is
decided on (id, digest) alone: payloads are shuffled once, to their shards, where a
row that says "revisit" sorts directly before the payload it is about.

Headers and digests are made anew from the payload when a record is written, and
checked when it is read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import posixpath
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm._common import Scratch, shared_root, text_or_empty
from tidewire.llm._order import RollingFiles, shards, store_of

SHARD_BYTES, ROLL_BYTES = 32 << 20, 2 << 20
DATE = "1970-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD_BYTES = 600
_MANIFEST = "shard int, seq int, file string, records bigint, bytes bigint, sha256 string, first_id bigint, last_id bigint"
_RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: int | None, digest: str, repeat: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}/{repeat}')}>"


def _header_value(text: str) -> str:
    """Control characters would end a header line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", f"sha1:{_digest(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id, url, payload: bytes, refers_to=None, is_revisit=False, repeat=0) -> bytes:
    """A compressed response or revisit record."""
    digest = _digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", _urn(page_id, digest, repeat)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _header_value(url)))
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if is_revisit:
        headers += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", _urn(refers_to, digest, 0))]
        if refers_to is not None:
            headers.append(("X-Refers-To-Page-ID", str(refers_to)))
    return _record(headers, http if is_revisit else http + payload)


class _Archives(RollingFiles):
    """The archives of one shard; ``done`` has their manifest rows."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        super().__init__(folder, shard, ".warc.gz")
        self.roll_bytes, self.done = roll_bytes, []

    def write(self, page_id: int | None, record: bytes) -> None:
        if self.out is None:
            self.records, self.first = 0, page_id
            info = [
                ("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn(None, self.name, 0)), ("WARC-Date", DATE),
                ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields"),
            ]
            self.put(_record(info, b"format: WARC File Format 1.1\r\n"))
        self.put(record)
        self.records += 1
        self.last = page_id
        if self.bytes >= self.roll_bytes:
            self.finish()

    def finish(self) -> None:
        if self.out is not None:
            self.done.append(self.close() | {"records": self.records, "first_id": self.first, "last_id": self.last})


def write_warc(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 0,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
) -> str:
    """Write a record per row of ``pages``; returns the folder, with ``archives`` and the ``manifest`` table.

    A null payload is the empty one; a null id sorts first and is left out of the
    headers; of repeated rows, the first is treated as having the largest id.  An
    empty table makes an empty manifest.  Other columns of ``pages``, whatever their names, are not read.  A very long
    payload is one record of its shard; it is held once, as the record that is written.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    folder = folder or f"{shared_root(spark)}/archive-{uuid.uuid4().hex}"
    payload = text_or_empty(payload_col).cast("binary")
    base = pages.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).withColumn("sha", F.sha1("payload"))
    light = scratch.save(base.select("id", "sha", F.octet_length("payload").cast("bigint").alias("n")), "light")

    deal, n_shards = shards(light, shard_bytes, _RECORD_BYTES)

    known = light.where(F.col("n") >= min_revisit_bytes)
    tops = known.groupBy("sha").agg(F.max("id").alias("top"), F.count("*").alias("c")).where("c > 1")
    revisits = (
        known.select("id", "sha").distinct().join(tops, "sha").where("not id <=> top").select("id", "sha", "top")
    )
    rows = base.select("id", "sha", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("bigint").alias("top"))
    says = revisits.select(
        "id", "sha", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("binary").alias("payload"), "top",
    )
    dealt = (
        deal(rows.unionByName(says))
        .repartitionById(n_shards, "shard")
        .sortWithinPartitions("shard", "id", "sha", "kind", "url")
    )
    archives = f"{folder}/archives"

    def write(batches):
        files, at, said, repeat = None, None, None, 0
        for batch in batches:
            for r in batch.to_pylist():
                if files is None or files.shard != r["shard"]:
                    if files:
                        files.finish()
                        yield _manifest_rows(files.done)
                    files = _Archives(archives, r["shard"], roll_bytes)
                key = (r["id"], r["sha"])
                if r["kind"] == 0:
                    said = (key, r["top"])
                    continue
                repeat = repeat + 1 if key == at else 0
                at = key
                decided = said is not None and said[0] == key
                revisit = decided or (repeat > 0 and len(r["payload"]) >= min_revisit_bytes)
                target = said[1] if decided else r["id"] if revisit else None
                files.write(r["id"], page_record(r["id"], r["url"], r["payload"], target, revisit, repeat))
        if files:
            files.finish()
            yield _manifest_rows(files.done)

    dealt.mapInArrow(write, _MANIFEST).write.option("compression", "uncompressed").parquet(f"{folder}/manifest")
    scratch.keep()
    return folder


def _manifest_rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_pylist(rows, pa.schema([(n, kinds[k]) for n, k in map(str.split, _MANIFEST.split(", "))]))


class _Checked:
    """A stream that keeps count and digest of what was read."""

    def __init__(self, stream):
        self.stream, self.sha, self.bytes = stream, hashlib.sha256(), 0

    def read(self, n: int = -1) -> bytes:
        data = self.stream.read(n if n >= 0 else None)
        self.sha.update(data)
        self.bytes += len(data)
        return data


def read_records(stream) -> list:
    """Yields (headers, block) of each record of an uncompressed WARC stream."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if f"sha1:{_digest(block)}" != headers["warc-block-digest"]:
            raise ValueError(f"block digest of {headers['warc-record-id']} does not match")
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("record does not end where its length says")
        yield headers, block


def read_warc(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the manifest names: page_id, url, payload_bytes, payload_digest, record_type, refers_to
    and, if wanted, payload (null for a revisit).  Sizes and digests of files, blocks and payloads are checked."""
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    n_files = max(manifest.count(), 1)
    archives = f"{folder}/archives"
    schema = _RECORDS + (", payload binary" if with_payload else "")
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in schema.split(", ")]

    def batch_of(rows):
        columns = list(zip(*rows, strict=True))[: len(names)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names)

    def read(batches):
        store, path = store_of(archives)
        for batch in batches:
            for f in batch.to_pylist():
                checked = _Checked(store.open_input_stream(posixpath.join(path, f["file"]), compression=None))
                rows, held = [], 0
                for headers, block in read_records(gzip.GzipFile(fileobj=checked)):
                    kind = headers["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and _digest(payload) != digest:
                        raise ValueError(f"payload digest of {headers['warc-record-id']} does not match")
                    told = int(http.decode().lower().partition("content-length:")[2].split("\r\n")[0])
                    number = lambda k: int(headers[k]) if k in headers else None  # noqa: B023, E731
                    size = len(payload) if kind == "response" else told
                    rows.append(
                        (number("x-page-id"), headers.get("warc-target-uri"), size, digest, kind,
                         number("x-refers-to-page-id"), payload if kind == "response" else None)
                    )
                    held += len(block) if with_payload else 200
                    if held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)
                if (checked.bytes, checked.sha.hexdigest()) != (f["bytes"], f["sha256"]):
                    raise ValueError(f"{f['file']} is not the file that the manifest names")

    return manifest.select("file", "bytes", "sha256").repartition(n_files).mapInArrow(read, schema)
