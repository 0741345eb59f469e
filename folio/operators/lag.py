"""LAG over groups that may be hot, with hot groups computed chunk by chunk.

``LAG(x) OVER (PARTITION BY p ORDER BY o)`` puts every row of a group into
one window partition. When a single member (say) owns a large share of all
rows, that one task does the work of the whole job. ``chunked_lag`` finds
the hot groups (more than ``hot_rows`` rows; a bounded, broadcast table, see
``operators.skew``) and splits only those into chunks of the ordering (e.g.
calendar months):

1. the last value of every (hot p, chunk) — an aggregate, combined map-side;
2. LAG of that value over the chunks of p — one row per chunk, so this
   window is bounded by the number of chunks, not by the data;
3. that value is added as a sentinel row that sorts first in its chunk, and
   LAG runs inside (p, chunk): the first real row of a chunk picks up the
   previous chunk's last value from the sentinel. Sentinels are dropped.

Groups that are not hot form a single chunk, which is exactly the plain
window. The big table is shuffled once, on (group, chunk), for the window;
step 3 is a union, not a join. The chunk column must be non-decreasing in
the order columns inside a group, and the order columns must be unique
inside a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.skew import DEFAULT_HOT_ROWS, q, q_list, tag_hot


def chunked_lag(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                value_col: str, chunk_col: str, out_col: str, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    part = list(partition_cols)
    by_part = f"PARTITION BY {q_list(part)} " if part else ""
    order = q_list(order_cols)
    tagged = tag_hot(df, part, hot_rows)
    last = (tagged.where("_hot").groupBy(*part, chunk_col)
            .agg(F.expr(f"max_by({q(value_col)}, struct({order})) AS _lag_last")))
    carried = (last.selectExpr(*[q(c) for c in part], f"{q(chunk_col)} AS _lag_chunk",
                               f"lag(_lag_last) OVER ({by_part}ORDER BY {q(chunk_col)}) AS _lag_carry")
               .where("_lag_carry IS NOT NULL"))
    real = tagged.selectExpr("*", f"CASE WHEN _hot THEN {q(chunk_col)} END AS _lag_chunk",
                             "false AS _lag_sentinel").drop("_hot")
    sentinels = carried.selectExpr(*[q(c) for c in part], "_lag_chunk", f"_lag_carry AS {q(value_col)}",
                                   "true AS _lag_sentinel")
    # Shuffle on (group, chunk) explicitly: rows already partitioned by the
    # group alone (e.g. after a join on it) would keep a hot group in one task.
    both = real.unionByName(sentinels, allowMissingColumns=True).repartition(*part, "_lag_chunk")
    window = f"PARTITION BY {q_list([*part, '_lag_chunk'])} ORDER BY _lag_sentinel DESC, {order}"
    return (both.selectExpr("*", f"lag({q(value_col)}) OVER ({window}) AS {q(out_col)}")
            .where("NOT _lag_sentinel")
            .drop("_lag_sentinel", "_lag_chunk"))
