"""Storage that driver and executors share: a folder for what has to be written between two jobs, files by their URL."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

_own: str | None = None


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir. Where that is unset, in a folder of this machine if driver and executors are one
    process, as in tests; an error on a cluster."""
    global _own
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        _own = _own or "file://" + tempfile.mkdtemp(prefix="strandline-")
        found = _own
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def opened(url: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URL and the path in it; a name without a scheme is a local path."""
    if url.startswith("file:") or "://" not in url:
        return fs.LocalFileSystem(), url.removeprefix("file://").removeprefix("file:").rstrip("/")
    system, path = fs.FileSystem.from_uri(url.replace("s3a://", "s3://", 1))
    return system, path.rstrip("/")
