"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folio.session import scratch_dir

#: Bytes that separate words: space, tab, newline, vertical tab, form feed, carriage return.
#: ``bytes.split()`` cuts at exactly these.
SPACE = "\\x20\\x09-\\x0D"


def ship(module_name: str) -> None:
    """Send a module's functions to the executors by value, so that workers need not have
    the repository on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder for a written table, under the session's ``spark.checkpoint.dir``."""
    return f"{scratch_dir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back. This cuts the lineage: a lost
    executor never makes Spark compute the table again, and every reader sees the same rows.
    ``compression``: other than the session's, as zstd for whole texts."""
    path = new_path(df.sparkSession, name)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str, what: Column | None = None) -> tuple[DataFrame, int]:
    """A ``stored`` table and the sum of ``what`` over its rows (or their number), taken while it is written. A query of its own
    for each such sum costs the driver a plan, jobs and a scan; loops over many small tables ask for hundreds."""
    seen = Observation()
    table = stored(df.observe(seen, F.sum(F.lit(1) if what is None else what).alias("total")), name)
    return table, int(seen.get["total"] or 0)


def numbered(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A stored copy of ``df``, each row with a number of its own: ``row, carried``, the latter a struct of its ``columns``
    (or all). A number made while reading depends on how the files were split for that read; here it is
    written, so whoever reads rows and numbers from this table finds the same number at a row."""
    return stored(df.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in columns or df.columns]).alias("carried")), "numbered", "zstd")


#: Rows and bytes of a batch of whole texts on its way to a Python worker (Spark's defaults: 10000, 64 MB).
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Send whole texts to Python workers in small batches, where the deployment left Spark's sizes as they are. A
    batch stands in the JVM and twice in the worker; in a long session, each of whose tasks keeps a worker, that adds up."""
    for key, usual, own in (("maxRecordsPerBatch", "10000", BATCH_ROWS), ("maxBytesPerBatch", str(64 << 20), BATCH_BYTES)):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", usual).rstrip("b") == usual:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(own))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def broadcast_if_small(df: DataFrame, max_rows: int, rows: int | None = None) -> DataFrame:
    """Hint a broadcast only for a table counted to hold at most ``max_rows`` rows; a larger
    one is left to a shuffled join. ``rows``: their number, if known; else ``df`` should be a stored table (it is read twice)."""
    return F.broadcast(df) if (df.limit(max_rows + 1).count() if rows is None else rows) <= max_rows else df


def per_process(key, make):
    """``make()`` once for each Python worker process, which runs many tasks. Functions sent by value have new
    globals in every task; what all tasks of a worker share stands among its modules."""
    made = sys.modules.setdefault("_folio_per_process", {})
    if key not in made:
        made[key] = make()
    return made[key]


def give_back() -> None:
    """At a task's end in a reused Python worker: hand freed memory to the system, for the JVM and other workers."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def fold_of(column: str = "doc_id", folds: int = 3):
    """crc32 of the id written as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


ship(__name__)
