"""Where jobs put tables and files that all machines must see."""

from __future__ import annotations

import re
import tempfile

from pyarrow import fs as pafs
from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a fresh one where it is unset and all runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="tidewire-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def store_of(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all machines share, and the path in it."""
    return pafs.FileSystem.from_uri(uri if ":" in uri.split("/", 1)[0] else "file://" + uri)
