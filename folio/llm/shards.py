"""Sharding by global byte-size prefix sums (DataFrame functions only).

Rows are range-partitioned by key and each partition's byte and row totals are summed up. The
running sum of these totals (one row a partition) gives every partition its global offset;
a running sum inside each partition gives every row its own. Cutting the byte axis at equal
targets yields contiguous shards whose sizes differ by at most about one row's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import documents, stored

N_SHARDS = 24
#: Bytes counted for a row besides its text.
ROW_OVERHEAD = 8


def byte_shards(df: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text",
                overhead: int = ROW_OVERHEAD, carry: list[str] | None = None) -> DataFrame:
    """Assign each row of ``df`` to one of ``n_shards`` contiguous shards of near-equal bytes.

    Returns ``key, size, text_crc32, shard, slot`` and a struct ``carried`` of the ``carry``
    columns. A row's shard is the one that holds the middle of its byte range
    ``[start, start + size)`` on the axis cut into ``n_shards`` equal targets.

    Defined cases: a null text has no bytes and checksum 0; null keys come first; rows with
    equal keys are ordered by checksum, then by their place in the input, so repeated rows each
    get a place; a text longer than a target leaves shards without rows; an empty table gives no
    rows. Other input columns are ignored unless carried, and cannot clash (``carried`` is a
    struct).
    """
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    slim = df.select(
        F.col(key).alias("k"), (F.length(raw).cast("long") + overhead).alias("size"), F.crc32(raw).alias("crc"),
        F.monotonically_increasing_id().alias("place"),
        F.struct(*[F.col(c) for c in carry or []]).alias("carried") if carry else F.lit(None).cast("string").alias("carried"))
    # Written once: the partition number of each row is then a fact, not something a retry may change.
    ranged = stored(slim.repartitionByRange("k", "crc", "place").withColumn("part", F.spark_partition_id()), "shard-rows")

    # One row a partition: bounded by the number of partitions, whatever the data.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
               .select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte0"),
                       F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row0"),
                       F.sum("bytes").over(Window.partitionBy()).alias("total")))

    inside = Window.partitionBy("part").orderBy(F.col("k").asc_nulls_first(), "crc", "place")
    mid = f"(2 * (byte0 + upto) - size) * {n_shards}L div (2 * total)"
    placed = (ranged.withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("nth", F.row_number().over(inside) - 1)
              .join(offsets, "part")
              .select("k", "size", "crc", "carried", F.expr(f"cast(least({n_shards - 1}L, {mid}) as int)").alias("shard"),
                      (F.col("row0") + F.col("nth")).alias("row")))
    # One row a shard.
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    out = placed.join(F.broadcast(first), "shard")
    return out.select(F.col("k").alias(key), "size", F.col("crc").alias("text_crc32"), "shard",
                      (F.col("row") - F.col("first_row")).alias("slot"), *(["carried"] if carry else []))


def write_shards(df: DataFrame, path: str, n_shards: int, key: str = "doc_id", text: str = "text") -> None:
    """Write the rows of ``df`` as one folder a shard (``shard=0`` ...), in slot order inside each file."""
    placed = byte_shards(df, n_shards, key, text, carry=list(df.columns))
    (placed.select("carried.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
     .repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
     .write.partitionBy("_shard").parquet(path))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(documents(spark, sf_dir), N_SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
