"""Distinct counts and quantiles from small states that merge.

A state is kept for each month: a HyperLogLog sketch of the keys and a KLL sketch of the values. Any range of months is answered by
merging its states, without the rows. Their sizes are fixed by the parameters, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2^14 registers: a standard error of 1.04 / 2^7 = 0.8 %; an estimate is held to three of them.
REGISTERS_LOG2 = 14
DISTINCT_BOUND = 3 * 1.04 / 2 ** (REGISTERS_LOG2 / 2)
#: Items of a KLL level; the rank of a quantile is held to one hundredth (at this size its error is below a third of that).
KLL_ITEMS = 800
RANK_BOUND = 0.01


def distinct_states(df: DataFrame, day: str, key: str) -> DataFrame:
    """``month, state`` of the keys by month. Rows without a day or a key do not count."""
    return (df.where(f"`{day}` IS NOT NULL AND `{key}` IS NOT NULL").groupBy(F.trunc(day, "month").alias("month"))
            .agg(F.hll_sketch_agg(key, F.lit(REGISTERS_LOG2)).alias("state")))


def distinct_over(states: DataFrame, period: str) -> DataFrame:
    """``period, estimate``: months' states merged by ``quarter`` or ``year``."""
    return (states.groupBy(F.trunc("month", period).alias("period"))
            .agg(F.hll_sketch_estimate(F.hll_union_agg("state")).alias("estimate")))


def value_states(df: DataFrame, day: str, value: str) -> DataFrame:
    """``month, state`` of whole-number values by month. Rows without a day or a value do not count."""
    return (df.where(f"`{day}` IS NOT NULL AND `{value}` IS NOT NULL").groupBy(F.trunc(day, "month").alias("month"))
            .agg(F.kll_sketch_agg_bigint(F.col(value).cast("long"), F.lit(KLL_ITEMS)).alias("state")))


def quantile_over(states: DataFrame, period: str, rank: float) -> DataFrame:
    """``period, estimate``: the value at ``rank`` (0 to 1), months' states merged by ``quarter`` or ``year``."""
    return (states.groupBy(F.trunc("month", period).alias("period"))
            .agg(F.kll_sketch_get_quantile_bigint(F.kll_merge_agg_bigint("state"), F.lit(rank)).alias("estimate")))
