"""A sink that writes one JSON file per school in one job, however many conferences there are.

``df.write.format("snapshot_files").mode("append").save(root)`` takes rows with ``conference``, ``school`` and ``body``, and writes
``v1/conferences/<conference>/schools/<school>.json`` below the root.  With the option ``preview`` the files are those of a run for one
school, ``preview/<school>/<sport or all-sports>.json``, and have no manifest.

Tasks write below a folder of the run.  Only what committed tasks have written is moved to its place when all are done; then each
conference gets its manifest, which names its files with their digests, so a conference without a manifest of this run is not yet to be
read.  A run that fails, or is killed before that, leaves at most its own folder, whose name begins with a dot, so readers pass it over.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tidewire.publish import MAX_FILE
from tidewire.scratch import store_of
from tidewire.sources.catalog import SLUG

FORMAT = "snapshot_files"


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SnapshotFiles)


class SnapshotFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("files are replaced one by one: use mode append")
        names = schema.fieldNames()
        for wanted in ("school", "body", *(() if self.options.get("preview") else ("conference",))):
            if wanted not in names:
                raise ValueError(f"no column {wanted}")
        return _Writer(self.options["path"].rstrip("/"), names, {k.lower(): v for k, v in self.options.items()})


@dataclass
class _Written(WriterCommitMessage):
    """What a task has written: (place below the root, place below the run's folder, conference, school, sha256, bytes)."""

    files: list[tuple] = field(default_factory=list)


class _Writer(DataSourceWriter):
    def __init__(self, root: str, names: list[str], options: dict[str, str]):
        self.root, self.names, self.options = root, names, options
        self.preview = str(options.get("preview", "")).lower() == "true"
        self.run = f".run-{uuid.uuid4().hex}"

    def _place(self, row: dict) -> str:
        parts = [row["school"], row.get("sport") or "all-sports"] if self.preview else [row["conference"], row["school"]]
        for part in parts:
            if not part or not re.fullmatch(SLUG, part):
                raise ValueError(f"not a slug: {part}")
        return "preview/{}/{}.json".format(*parts) if self.preview else "v1/conferences/{}/schools/{}.json".format(*parts)

    def write(self, iterator) -> WriterCommitMessage:
        store, path = store_of(self.root)
        attempt, out = uuid.uuid4().hex, []
        for r in iterator:
            row = dict(zip(self.names, r, strict=True))
            data = (row["body"] or "").encode()
            if not 0 < len(data) <= MAX_FILE:
                raise ValueError(f"a file of {len(data)} bytes")
            place = self._place(row)
            own = f"{self.run}/{attempt}/{place}"
            store.create_dir(posixpath.dirname(posixpath.join(path, own)), recursive=True)
            with store.open_output_stream(posixpath.join(path, own), compression=None) as stream:
                stream.write(data)
            out.append((place, own, row.get("conference"), row["school"], hashlib.sha256(data).hexdigest(), len(data)))
        return _Written(out)

    def commit(self, messages: list) -> None:
        store, path = store_of(self.root)
        files = sorted(f for m in messages if m is not None for f in m.files)
        for (a, *_), (b, *_) in zip(files, files[1:], strict=False):
            if a == b:
                raise ValueError(f"two rows for {a}")
        folders = sorted({posixpath.dirname(f[0]) for f in files})
        for folder in folders:
            store.create_dir(posixpath.join(path, folder), recursive=True)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda f: self._move(store, posixpath.join(path, f[1]), posixpath.join(path, f[0])), files))
        if not self.preview:
            self._manifests(store, path, files)
        store.delete_dir(posixpath.join(path, self.run)) if files else None

    def _move(self, store: pafs.FileSystem, own: str, place: str) -> None:
        if store.type_name != "local" and store.get_file_info(place).type != pafs.FileType.NotFound:
            store.delete_file(place)
        store.move(own, place)

    def _manifests(self, store: pafs.FileSystem, path: str, files: list[tuple]) -> None:
        conferences: dict[str, list[dict]] = {}
        for _, _, conference, school, sha, size in files:
            conferences.setdefault(conference, []).append({"slug": school, "path": f"schools/{school}.json", "sha256": sha, "bytes": size})
        for conference, schools in conferences.items():
            told = {"schemaVersion": 1, "academicYear": self.options.get("academicyear"), "conference": {"slug": conference}, "generatedAt": self.options.get("generatedat")}
            text = json.dumps(told | {"schools": sorted(schools, key=lambda s: s["slug"])}, indent=2) + "\n"
            own = posixpath.join(path, self.run, f"{conference}.manifest.json")
            with store.open_output_stream(own, compression=None) as stream:
                stream.write(text.encode())
            self._move(store, own, posixpath.join(path, f"v1/conferences/{conference}/manifest.json"))

    def abort(self, messages: list) -> None:
        store, path = store_of(self.root)
        if store.get_file_info(posixpath.join(path, self.run)).type == pafs.FileType.Directory:
            store.delete_dir(posixpath.join(path, self.run))
