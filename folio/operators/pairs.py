"""Unordered pairs of rows sharing a key (a self equi-join with ``a.id < b.id``).

The output of a group of n rows is n(n-1)/2 pairs — that is the report, it
cannot be avoided. What can be avoided is one task producing all pairs of a
hot group. Keys with more than ``hot_rows`` rows (a bounded table, see
``operators.skew``) are split on a grid: each row gets one of
S = ceil(n / hot_rows) buckets (hash of its id), and the pairs of buckets
(i <= j) are the cells. A row of bucket b goes to the S cells of row b and
column b, so every cell compares at most hot_rows x hot_rows rows, and each
unordered pair meets in exactly one cell: (min bucket, max bucket). Other
keys take the plain equi-join (one cell).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.skew import hot_keys

DEFAULT_HOT_ROWS = 10_000


def pairs_within_key(df: DataFrame, key_col: str, id_col: str, carry: Sequence[str],
                     hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Rows ``key, a_<id>, a_<carry...>, b_<id>, b_<carry...>`` for every pair
    of rows with equal non-NULL ``key`` and ``a.id < b.id``."""
    rows = df.filter(F.col(key_col).isNotNull()).select(key_col, id_col, *carry)
    hot = (hot_keys(rows, [key_col], hot_rows)
           .select(key_col, F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int").alias("_s")))
    # The hot-key list holds at most rows / hot_rows keys; with the small
    # hot_rows needed for small cells that bound can be large, so the join
    # strategy is left to AQE's measured sizes (skew-join splitting included).
    bucketed = (rows.join(hot, key_col, "left")
                .withColumn("_s", F.coalesce(F.col("_s"), F.lit(1)))
                .withColumn("_b", F.pmod(F.xxhash64(id_col), F.col("_s")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("_s") - 1))
    # as the row side of a cell: cells (b, j) for j >= b; as the column side: cells (i, b) for i <= b
    as_row = (bucketed.select("*", other.alias("_o")).filter(F.col("_o") >= F.col("_b"))
              .select(F.col(key_col), F.col("_b").alias("_ci"), F.col("_o").alias("_cj"),
                      *[F.col(c).alias(f"l_{c}") for c in (id_col, *carry)]))
    as_col = (bucketed.select("*", other.alias("_o")).filter(F.col("_o") <= F.col("_b"))
              .select(F.col(key_col).alias("_key_r"), F.col("_o").alias("_ri"), F.col("_b").alias("_rj"),
                      *[F.col(c).alias(f"r_{c}") for c in (id_col, *carry)]))
    same_cell = ((F.col(key_col) == F.col("_key_r")) & (F.col("_ci") == F.col("_ri"))
                 & (F.col("_cj") == F.col("_rj")))
    # off-diagonal cells hold each pair once in either order; diagonal cells need the id order
    once = (F.col("_ci") != F.col("_cj")) | (F.col(f"l_{id_col}") < F.col(f"r_{id_col}"))
    joined = as_row.join(as_col, same_cell & once)
    first = F.col(f"l_{id_col}") < F.col(f"r_{id_col}")
    return joined.select(
        F.col(key_col),
        *[F.when(first, F.col(f"l_{c}")).otherwise(F.col(f"r_{c}")).alias(f"a_{c}") for c in (id_col, *carry)],
        *[F.when(first, F.col(f"r_{c}")).otherwise(F.col(f"l_{c}")).alias(f"b_{c}") for c in (id_col, *carry)])
