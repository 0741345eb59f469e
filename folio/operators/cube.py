"""All grouping sets of a few columns, from one pass over the facts.

Spark's CUBE expands each fact row once a grouping set, and once more for a distinct count. Here the facts are combined
once, to one row for each value of the finest group and key; coarser states are made of finer ones. A distinct count cannot be
added up over a column unless each key has one value there. So columns that the key determines are rolled up by
adding, and only the others have a state of their own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _subsets(names: Sequence[str]) -> Iterator[tuple[str, ...]]:
    for size in range(len(names), -1, -1):
        yield from combinations(names, size)


def distinct_cube(facts: DataFrame, dims: Sequence[str], key: str, weight: str, determined: Sequence[str] = ()) -> DataFrame:
    """``dims..., level, total, keys`` for every grouping set: the sum of ``weight`` and the number of distinct ``key`` values.

    ``level`` has one bit a column of ``dims``, the last one lowest, set where the column is rolled up (its value is null then).
    ``determined`` names the columns of ``dims`` of which each key has one value. Null values of a column are a group
    of their own; a null key adds to ``total`` alone; no facts give the grand total alone, of 0 and 0.
    """
    free = [d for d in dims if d not in determined]
    finest = facts.groupBy(*dims, key).agg(F.sum(weight).alias("total"))
    out = None
    for kept in _subsets(free):
        state = finest if len(kept) == len(free) else finest.groupBy(*kept, *determined, key).agg(F.sum("total").alias("total"))
        level = state.groupBy(*kept, *determined).agg(F.sum("total").alias("total"), F.count(key).alias("keys"))
        for own in _subsets(list(determined)):
            part = level if len(own) == len(determined) else level.groupBy(*kept, *own).agg(F.sum("total").alias("total"), F.sum("keys").alias("keys"))
            here = {*kept, *own}
            bits = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in here)
            part = part.select(*[F.col(d) if d in here else F.lit(None).cast(facts.schema[d].dataType).alias(d) for d in dims],
                               F.lit(bits).alias("level"), *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("total", "keys")])
            out = part if out is None else out.unionByName(part)
    return out
