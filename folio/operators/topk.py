"""Top-k helpers.

``orderBy(...).limit(k)`` is planned as TakeOrderedAndProject: every task
keeps its own k best rows and only those meet on one task, so a plain top-k is
already distributed. ``keep_top_k_with_ties`` is for pushing a top-k below
joins whose columns take part in the final ordering: it keeps every row whose
leading sort value reaches the k-th best one, so no row that could make the
final top-k is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k_cut(df: DataFrame, col: str, k: int, descending: bool = True):
    """Scalar struct ``(v, n)``: the k-th best non-NULL value of ``col`` and the
    number of non-NULL values taken (n < k: fewer than k values exist).

    It is a scalar subquery over a TakeOrderedAndProject, so the cut is found
    without sorting the table."""
    c = F.col(col)
    best = df.filter(c.isNotNull()).select(c).orderBy(c.desc() if descending else c.asc()).limit(k)
    return best.select(F.struct((F.min(col) if descending else F.max(col)).alias("v"),
                                F.count(F.lit(1)).alias("n"))).scalar()


def keep_top_k_with_ties(df: DataFrame, col: str, k: int, descending: bool = True) -> DataFrame:
    """Rows whose ``col`` is among the k best values counting ties (NULLs last)."""
    c = F.col(col)
    cut = top_k_cut(df, col, k, descending)
    reaches = (c >= cut.getField("v")) if descending else (c <= cut.getField("v"))
    return df.filter(F.coalesce(reaches, F.lit(False)) | (cut.getField("n") < k))


def enrich_top_k(top: DataFrame, *lookups: tuple[DataFrame, str | list[str], str]) -> DataFrame:
    """Join lookup tables to the result of a top-k, keeping the k rows as the
    broadcast side of every join: the k rows are a proven size bound, so the
    large lookup tables are only scanned, never shuffled.

    ``lookups`` are ``(table, join key(s), how)`` applied in order."""
    out = top
    for table, key, how in lookups:
        out = F.broadcast(out).join(table, key, how)
    return out
