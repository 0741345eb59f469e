"""Applying job outputs to stored tables (INSERT ... SELECT, UPDATE).

Stored tables are immutable Parquet folders; a batch of changes produces the
next version of a table: rows whose key was updated are replaced (anti join
on the key + union of the new images), inserted rows are appended. The new
version is written to its own folder, so readers of the old one are not
disturbed and a failed write leaves the old version intact.
"""

from __future__ import annotations

from collections.abc import Sequence

import uuid

from pyspark.sql import DataFrame

from folio.session import scratch_dir


def apply_changes(base: DataFrame, updates: DataFrame | None = None, inserts: DataFrame | None = None,
                  keys: Sequence[str] = ()) -> DataFrame:
    """``base`` with ``updates`` replacing rows of equal ``keys`` and ``inserts`` added."""
    out = base
    cols = base.columns
    if updates is not None:
        out = out.join(updates.select(*keys), list(keys), "left_anti").unionByName(updates.select(*cols))
    if inserts is not None:
        out = out.unionByName(inserts.select(*cols))
    return out


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a job's decided requests to the shared folder and read them back, so that
    its output tables derive from one decision and a lost executor changes nothing."""
    path = f"{scratch_dir(df.sparkSession, 'jobs')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_version(df: DataFrame, path: str) -> None:
    """Write a table version to its own folder (never over the one being read)."""
    df.write.mode("errorifexists").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """INSERT ... SELECT into a stored table folder."""
    df.write.mode("append").parquet(path)
