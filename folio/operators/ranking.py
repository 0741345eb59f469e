"""Rankings and running totals that never funnel all rows into one task.

A window without PARTITION BY (or with a hot partition key) makes Spark plan
``Exchange SinglePartition`` (or one giant partition). The helpers below get
the same numbers from small derived tables:

* ``sequence_within`` — ROW_NUMBER inside a group: plain for ordinary groups;
  hot groups (and the whole table when there is no group) through per-block
  counts and prefix sums, so rows are numbered inside bounded blocks.
* ``rank_by_value`` — RANK / DENSE_RANK from the table of distinct values,
  itself ranked block-wise along the value range (``value_ranks``).
* ``percent_rank_by_value`` — PERCENT_RANK from the same value ranks.
* ``running_total_by_key`` — SUM() OVER (ORDER BY k) with the default RANGE
  frame, from per-key sums (peers share the value, as in SQL).

All are exact and deterministic: no partition ids, no sampling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.operators.skew import DEFAULT_HOT_ROWS, q, q_list, tag_hot

DEFAULT_BLOCK_WIDTH = 1 << 16
# Blocks in one step of a prefix sum, and steps: blocks, blocks of blocks, and so on.
LEVEL_WIDTH = 1 << 16
LEVELS = 2


def _order(c: str, descending: bool, nulls_first: bool | None = None) -> Column:
    col = F.col(c)
    if descending:
        return col.desc_nulls_first() if nulls_first else col.desc_nulls_last()
    return col.asc_nulls_last() if nulls_first is False else col.asc_nulls_first()


def offsets_before(counts: DataFrame, part: Sequence[str], block: str, sums: dict[str, str],
                   levels: int = LEVELS, level_width: int | None = None) -> DataFrame:
    """For every row of a block table ``part, block, <values>``: the sums of
    each value (``{value: output}``) over the blocks before it in its part.

    Blocks are added up inside blocks of blocks, whose own offsets come from the
    same step one level up. Sparse block numbers give many blocks; a level holds
    at most ``level_width`` of them in one window, and 64-bit numbers cut by
    2^16 three times leave no more than that at the top.
    """
    width = level_width or LEVEL_WIDTH
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

    def running(rows: DataFrame, keys: list[str], order: str, named: dict[str, str]) -> DataFrame:
        by = f"PARTITION BY {q_list(keys)} " if keys else ""
        return rows.selectExpr(*[q(c) for c in [*part, *keys[len(part):], order]],
                               *[f"coalesce(sum({q(v)}) OVER ({by}ORDER BY {q(order)} {before}), 0) AS {q(o)}" for v, o in named.items()])

    if levels == 0:
        return running(counts, list(part), block, sums)
    upper = f"{block}_{levels}"
    tagged = counts.selectExpr("*", f"floor({q(block)} / {width}) AS {q(upper)}")
    totals = tagged.groupBy(*part, upper).agg(*[F.sum(v).alias(v) for v in sums])
    above = offsets_before(totals, part, upper, {v: f"_above_{o}" for v, o in sums.items()}, levels - 1, width)
    inside = running(tagged, [*part, upper], block, sums)
    joined = inside.join(above, [*part, upper])
    return joined.selectExpr(*[q(c) for c in [*part, block]],
                             *[f"{q(o)} + {q('_above_' + o)} AS {q(o)}" for o in sums.values()])


def sequence_within(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                    out_col: str = "seq", block_width: int = DEFAULT_BLOCK_WIDTH,
                    hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY partition_cols ORDER BY order_cols).

    Groups with at most ``hot_rows`` rows are numbered by the plain window.
    Hot groups (see ``operators.skew``) and the
    whole table when there are no partition columns are cut into blocks of
    ``block_width`` consecutive values of ``order_cols[0]`` (an integer
    column), so a block holds at most ``block_width`` rows when that column is
    unique in its group; blocks are offset by a prefix sum over the
    block table, in levels (``offsets_before``). Remaining order columns break ties inside a block.
    """
    part = list(partition_cols)
    block = f"floor({q(order_cols[0])} / {int(block_width)})"
    if part:
        tagged = (tag_hot(df, part, hot_rows)
                  .selectExpr("*", f"CASE WHEN _hot THEN {block} END AS _seq_blk").drop("_hot"))
        counts = tagged.where("_seq_blk IS NOT NULL")
    else:
        tagged = df.selectExpr("*", f"{block} AS _seq_blk")
        counts = tagged
    offsets = offsets_before(counts.groupBy(*part, "_seq_blk").agg(F.expr("count(1) AS _seq_n")),
                             part, "_seq_blk", {"_seq_n": "_seq_off"})
    # Shuffle on (group, block) explicitly, before the offsets join: rows
    # already partitioned by the group alone would keep a hot group in one task.
    joined = tagged.repartition(*part, "_seq_blk").join(offsets, [*part, "_seq_blk"], "left")
    number = (f"CAST(coalesce(_seq_off, 0) + row_number() OVER (PARTITION BY {q_list([*part, '_seq_blk'])} "
              f"ORDER BY {q_list(order_cols)}) AS BIGINT) AS {q(out_col)}")
    return joined.selectExpr("*", number).drop("_seq_blk", "_seq_off")


def value_ranks(df: DataFrame, value_col: str, descending: bool, block_width: float) -> DataFrame:
    """For every distinct value of ``value_col`` (numeric): ``_v``, the number of
    rows ordered before it (``_rows_before``), the number of distinct values
    ordered before it (``_vals_before``), its own row count (``_c``) and the
    number of rows in all (``_total``, summed over the block table).

    The distinct values are cut into blocks of ``block_width`` along the value
    range (NULL in its own block: first ascending, last descending, as in SQL);
    the blocks are summed in levels, values are ordered inside their block. No step holds more than one block of distinct values."""
    key = "-_v" if descending else "_v"
    edge = 2 ** 62 if descending else -(2 ** 62)
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    tagged = (df.selectExpr(f"{q(value_col)} AS _v").groupBy("_v").agg(F.expr("count(1) AS _c"))
              .selectExpr("_v", "_c", f"{key} AS _key",
                          f"CASE WHEN _v IS NULL THEN CAST({edge} AS BIGINT) "
                          f"ELSE CAST(floor(({key}) / {block_width!r}) AS BIGINT) END AS _blk"))
    blocks = tagged.groupBy("_blk").agg(F.expr("sum(_c) AS _bc"), F.expr("count(1) AS _bv"))
    offsets = offsets_before(blocks, [], "_blk", {"_bc": "_off_rows", "_bv": "_off_vals"})
    total = blocks.select(F.coalesce(F.sum("_bc"), F.lit(0))).scalar()
    inside = f"PARTITION BY _blk ORDER BY _key {before}"
    return tagged.join(offsets, "_blk").withColumn("_total", total.cast("bigint")).selectExpr(
        "_v", "_c", "_total",
        f"CAST(_off_rows + coalesce(sum(_c) OVER ({inside}), 0) AS BIGINT) AS _rows_before",
        f"CAST(_off_vals + coalesce(count(1) OVER ({inside}), 0) AS BIGINT) AS _vals_before")


def rank_by_value(df: DataFrame, value_col: str, descending: bool = True,
                  rank_col: str | None = "rank", dense_col: str | None = "dense_rank",
                  block_width: float = DEFAULT_BLOCK_WIDTH) -> DataFrame:
    """RANK() and DENSE_RANK() OVER (ORDER BY value_col) for every row of ``df``,
    from the distinct values (``value_ranks``), joined back on the value."""
    cols = ["_v"]
    if rank_col:
        cols.append(f"_rows_before + 1 AS {q(rank_col)}")
    if dense_col:
        cols.append(f"_vals_before + 1 AS {q(dense_col)}")
    ranks = value_ranks(df, value_col, descending, block_width).selectExpr(*cols)
    return df.join(ranks, F.col(value_col).eqNullSafe(F.col("_v"))).drop("_v")


def percent_rank_by_value(df: DataFrame, value_col: str, out_rank: str = "_rank",
                          out_n: str = "_n_rows", block_width: float = DEFAULT_BLOCK_WIDTH) -> DataFrame:
    """Adds RANK() OVER (ORDER BY value_col ASC) and the row count, so that
    PERCENT_RANK = (rank - 1) / (n - 1) (0 when n = 1) can be formed exactly."""
    ranks = value_ranks(df, value_col, False, block_width).selectExpr(
        "_v", f"_rows_before + 1 AS {q(out_rank)}", f"_total AS {q(out_n)}")
    return df.join(ranks, F.col(value_col).eqNullSafe(F.col("_v"))).drop("_v")


def running_total_by_key(df: DataFrame, key_col: str, value_col: str, out_col: str,
                         nulls_first: bool = True, result_type: str | None = None) -> DataFrame:
    """SUM(value) OVER (ORDER BY key) with the default RANGE frame.

    For keys of few values only, such as dates: the table of distinct keys is
    ordered in one task.

    Rows with equal keys (peers) all get the total up to and including their
    key, exactly as the SQL default frame does. NULL keys sort first when
    ``nulls_first`` (MySQL / Spark ascending order).
    """
    sums = df.groupBy(key_col).agg(F.sum(value_col).alias("_s"))
    upto = Window.orderBy(_order(key_col, False, nulls_first)).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("_s").over(upto)
    if result_type:
        total = total.cast(result_type)
    cum = sums.select(F.col(key_col).alias("_k"), total.alias(out_col))
    return df.join(cum, F.col(key_col).eqNullSafe(F.col("_k"))).drop("_k")
