"""W12 — key assignment for new rows (the AUTO_INCREMENT counter).

New keys continue after the largest existing key, in the order of a request
column (and, if a request may add several rows, a second column). Rows are counted
per block of the order column and offset by a prefix sum over the block
table, in levels, so no step orders all new rows in one task, and a recomputed
stage gives the same keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.ranking import offsets_before, sequence_within
from folio.operators.skew import q


def assign_keys(rows: DataFrame, existing: DataFrame, key_col: str, order_col: str, within: str | None = None) -> DataFrame:
    """``rows`` with ``key_col`` = max(existing key) + 1, 2, ... in the order of ``order_col``, whose equal
    values are ordered by ``within`` (both integers, unique together)."""
    base = existing.selectExpr(f"CAST(coalesce(max({q(key_col)}), 0) AS BIGINT)").scalar()
    if within is None:
        numbered = sequence_within(rows, [], [order_col], out_col="_key_seq")
    else:
        before = offsets_before(rows.groupBy(order_col).agg(F.expr("count(1) AS _n")), [], order_col, {"_n": "_before"})
        numbered = (sequence_within(rows, [order_col], [within], out_col="_key_seq").join(before, order_col)
                    .withColumn("_key_seq", F.col("_key_seq") + F.col("_before")).drop("_before"))
    return numbered.withColumn(key_col, base + F.col("_key_seq")).drop("_key_seq")
