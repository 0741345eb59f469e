"""Stored library tables.

Reports run on stored library tables, as the reference's queries run on
stored database tables. For the driver's star schema the tables are derived
once (``Library.from_driver``) and written as Parquet under the session's
``spark.checkpoint.dir`` (a shared folder on a cluster), keyed by a
fingerprint of the input files; later queries read the written tables. A
written table also cuts the lineage: losing an executor never recomputes the
derivation. A small marker table written last tells a complete copy from a
partial one.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid

from pyspark.sql import SparkSession

from folio.session import scratch_dir
from folio.sources.library import LAYOUT_VERSION, Library

DRIVER_INPUTS = ("supplier", "nation", "customer", "part", "orders", "events")
MARKER = "_folio_complete"

_state = {"root": None, "ready": set(), "enabled": True, "libs": {}}
_lock = threading.Lock()


def set_root(path: str | None) -> None:
    """Folder for stored library tables (default: <checkpoint dir>/folio/library)."""
    _state["root"] = path


def set_enabled(flag: bool) -> None:
    """Turn materialization off: every call derives the tables lazily instead."""
    _state["enabled"] = flag


def fresh_root(spark: SparkSession) -> str:
    """A new, empty folder under the checkpoint directory (e.g. for a timed run)."""
    path = scratch_dir(spark, f"library-{uuid.uuid4().hex[:12]}")
    set_root(path)
    return path


def fingerprint(sf_dir: str, spark: SparkSession) -> str:
    """Identity of the driver inputs: path, length and modification time of
    every input file, asked of the file system that Spark reads. One pair of
    sums a table, so the driver holds no list of files."""
    h = hashlib.sha1(LAYOUT_VERSION.encode())
    h.update(os.path.abspath(sf_dir).encode() if "://" not in sf_dir else sf_dir.encode())
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in DRIVER_INPUTS:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        files = path.getFileSystem(conf).listFiles(path, True)
        n, seen = 0, 0
        while files.hasNext():
            f = files.next()
            one = f"{f.getPath().toString()}:{f.getLen()}:{f.getModificationTime()}"
            seen ^= int.from_bytes(hashlib.sha1(one.encode()).digest(), "big")
            n += 1
        h.update(f"{name}:{n}:{seen}".encode())
    return h.hexdigest()[:16]


def _complete(spark: SparkSession, path: str, fp: str) -> bool:
    """Whether the marker, written last, is there and names this input."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MARKER}/_SUCCESS")
    if not marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):
        return False
    rows = spark.read.parquet(f"{path}/{MARKER}").collect()
    return len(rows) == 1 and rows[0][0] == fp


def materialize(spark: SparkSession, sf_dir: str) -> str:
    """Write the derived library tables once; return their folder."""
    fp = fingerprint(sf_dir, spark)
    root = _state["root"] or scratch_dir(spark, "library")
    path = f"{root.rstrip('/')}/{fp}"
    if path in _state["ready"]:
        return path
    with _lock:
        return _materialize_locked(spark, sf_dir, path, fp)


def _materialize_locked(spark: SparkSession, sf_dir: str, path: str, fp: str) -> str:
    if path in _state["ready"]:
        return path
    if not _complete(spark, path, fp):
        Library.store_from_driver(spark, sf_dir, path)
        spark.createDataFrame([(fp,)], "fingerprint string").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/{MARKER}")
    _state["ready"].add(path)
    return path


def stored_folder(spark: SparkSession, sf_dir: str) -> str | None:
    """Folder of the stored library tables of a driver data folder; none if they are not stored."""
    return materialize(spark, sf_dir) if _state["enabled"] else None


def library_for(spark: SparkSession, sf_dir: str) -> Library:
    """The library tables for a driver data folder: the stored copy, or with
    ``set_enabled(False)`` the lazily derived tables. Failing to store them is
    an error, never a silent change of plan."""
    if not _state["enabled"]:
        return Library.from_driver(spark, sf_dir)
    path = materialize(spark, sf_dir)
    cached = _state["libs"].get(path)
    if cached is None or cached[0] is not spark:
        cached = (spark, Library.from_parquet(spark, path))
        _state["libs"][path] = cached
    return cached[1]
