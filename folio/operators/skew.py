"""Finding the hot keys of a DataFrame.

The scalable operators split only the groups that are too large for one
task. ``hot_keys`` counts rows per key (a map-side combined aggregate) and
keeps keys with more than ``threshold`` rows. There are at most
rows / threshold such keys; every other key takes the plain path.

The operators write their expressions as SQL text (``selectExpr``): the
plan is the same as with Column objects, but it is built with a handful of
calls to the JVM instead of hundreds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A window partition of up to a million rows is sorted comfortably in one task.
DEFAULT_HOT_ROWS = 1 << 20


def q(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def q_list(names: Sequence[str]) -> str:
    return ", ".join(q(n) for n in names)


def hot_keys(df: DataFrame, keys: Sequence[str], threshold: int) -> DataFrame:
    """``keys..., _rows`` for every key with more than ``threshold`` rows."""
    return df.groupBy(*keys).agg(F.expr("count(1) AS _rows")).where(f"_rows > {int(threshold)}")


def tag_hot(df: DataFrame, keys: Sequence[str], threshold: int) -> DataFrame:
    """``df`` with a boolean ``_hot`` column (true for rows of hot keys). The
    hot-key table grows with the data (rows / threshold keys), so how it is
    joined is left to its measured size."""
    hot = hot_keys(df, keys, threshold).selectExpr(*[q(k) for k in keys], "true AS _hot_key")
    return (df.join(hot, list(keys), "left")
            .selectExpr("*", "coalesce(_hot_key, false) AS _hot").drop("_hot_key"))
