"""Differences and intersections of tables with repeated rows (EXCEPT ALL, INTERSECT ALL).

Both tables are one, each row with +1 or -1; signs are added up for equal rows, before the shuffle and after it. Repeats stay a
number: a row that is there a million times more is one row of the result, not a million in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _counted(a: DataFrame, b: DataFrame) -> DataFrame:
    """The columns of ``a``, ``_a`` and ``_b``: how often each row is in either table (nulls are equal)."""
    both = a.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(b.select(*a.columns).withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1)))
    return both.groupBy(*a.columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))


def bag_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``change, columns..., times``: the rows of which ``new`` has more ('added') or fewer ('removed') than ``old``."""
    return (_counted(old, new).where("_a <> _b")
            .select(F.expr("if(_b > _a, 'added', 'removed') AS change"), *old.columns, F.abs(F.col("_b") - F.col("_a")).alias("times")))


def bag_common(a: DataFrame, b: DataFrame) -> DataFrame:
    """``columns..., times``: the rows that both have, so often as the one that has fewer."""
    return _counted(a, b).where("_a > 0 AND _b > 0").select(*a.columns, F.least("_a", "_b").alias("times"))
