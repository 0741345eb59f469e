"""The last value so far, per key, along an order: as-of joins and sessions.

``running_last`` gives every row the last non-null value at or before it in its key. The value must not
decrease along the order (a struct that begins with the order columns, say), so "last" is "largest" and
combines on the map side. Keys with more than ``hot_rows`` rows are cut into chunks of the order: each
chunk's largest value is carried to the later chunks as a sentinel row (see ``operators.lag``), so a
hot key is many tasks. The big table is shuffled once and never joined to anything of its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.lag import chunked_lag
from folio.operators.skew import DEFAULT_HOT_ROWS, q, q_list, tag_hot


def running_last(df: DataFrame, part: Sequence[str], order_cols: Sequence[str], value: str, chunk: str, out: str,
                 hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """``df`` with ``out``: the last non-null ``value`` of the key up to and with the row. ``chunk`` must not
    decrease along ``order_cols``, which must be unique inside a key."""
    part = list(part)
    tagged = tag_hot(df, part, hot_rows)
    last = tagged.where("_hot").groupBy(*part, chunk).agg(F.max(value).alias("_last"))
    before = f"OVER (PARTITION BY {q_list(part)} ORDER BY {q(chunk)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    sentinels = (last.selectExpr(*[q(c) for c in part], f"{q(chunk)} AS _chunk", f"max(_last) {before} AS {q(value)}", "true AS _sentinel")
                 .where(f"{q(value)} IS NOT NULL"))
    real = tagged.selectExpr("*", f"CASE WHEN _hot THEN {q(chunk)} END AS _chunk", "false AS _sentinel").drop("_hot")
    # An explicit shuffle: rows already dealt by the key alone would keep a hot key in one task.
    both = real.unionByName(sentinels, allowMissingColumns=True).repartition(*part, "_chunk")
    window = f"PARTITION BY {q_list([*part, '_chunk'])} ORDER BY _sentinel DESC, {q_list(order_cols)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return both.selectExpr("*", f"max({q(value)}) OVER ({window}) AS {q(out)}").where("NOT _sentinel").drop("_sentinel", "_chunk")


def asof_join(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, left_id: str, right_id: str,
              carry: Sequence[str], chunk: str, strict: bool = True, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Each row of ``left`` with the columns ``carry`` of the latest row of ``right`` of the same ``by`` whose time is
    before its own (or at it, if not ``strict``); of equal times the largest ``right_id``. Nulls where there is none.

    Both sides are put into one table and sorted once; no pair of rows is formed. ``chunk`` is SQL over ``_time`` and
    ``_id`` that cuts a hot key (not decreasing along both). Rows of ``left`` without key or time match nothing and stay; such
    rows of ``right`` match nothing. ``left_id`` is unique.
    """
    usable = f"{q(by)} IS NOT NULL AND {q(left_time)} IS NOT NULL"
    kept = [c for c in left.columns if c != by]
    # At one time the left row comes first if only earlier rows count, else last.
    l_rows = left.where(usable).selectExpr(f"{q(by)} AS _by", f"{q(left_time)} AS _time", f"{0 if strict else 2} AS _side", f"{q(left_id)} AS _id",
                                           f"struct({q_list(kept)}) AS _left")
    r_rows = (right.where(f"{q(by)} IS NOT NULL AND {q(right_time)} IS NOT NULL")
              .selectExpr(f"{q(by)} AS _by", f"{q(right_time)} AS _time", "1 AS _side", f"{q(right_id)} AS _id",
                          f"struct({q(right_time)} AS _time, {q(right_id)} AS _id{''.join(', ' + q(c) for c in carry)}) AS _found"))
    rows = l_rows.unionByName(r_rows, allowMissingColumns=True).selectExpr("*", f"{chunk} AS _cut")
    found = running_last(rows, ["_by"], ["_time", "_side", "_id"], "_found", "_cut", "_latest", hot_rows).where("_left IS NOT NULL")
    matched = found.selectExpr(f"_by AS {q(by)}", *[f"_left.{q(c)} AS {q(c)}" for c in kept], "_latest")
    rest = left.where(f"NOT ({usable})").select(by, *kept)
    joined = matched.unionByName(rest, allowMissingColumns=True)
    return joined.selectExpr(*[q(c) for c in left.columns], f"_latest._id AS {q('latest_' + right_id)}", *[f"_latest.{q(c)} AS {q('latest_' + c)}" for c in carry])


def sessions(df: DataFrame, key: str, time: str, row_id: str, gap: str, chunk: str, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """``key, session_start, session_end, n_rows``: runs of a key's rows in which no two neighbours are more than ``gap``
    (SQL, an interval) apart. ``chunk`` is SQL over the columns that cuts a hot key.

    A row starts a session if the row before it is too far away or missing; its time is then carried on as the
    session's name. Rows without a time belong to no session; rows without a key are one key's (null); equal times are one moment.
    """
    named = df.where(F.col(time).isNotNull()).selectExpr(f"{q(key)} IS NULL AS _none", f"coalesce({q(key)}, 0) AS _key", f"{q(time)} AS _time", f"{q(row_id)} AS _id", f"{chunk} AS _cut")
    part = ["_none", "_key"]
    lagged = chunked_lag(named, part, ["_time", "_id"], "_time", "_cut", "_before", hot_rows)
    starts = lagged.selectExpr("*", f"CASE WHEN _before IS NULL OR _time - _before > {gap} THEN _time END AS _start")
    told = running_last(starts, part, ["_time", "_id"], "_start", "_cut", "_session", hot_rows)
    return (told.groupBy(*part, "_session").agg(F.max("_time").alias("session_end"), F.count(F.lit(1)).alias("n_rows"))
            .selectExpr(f"CASE WHEN NOT _none THEN _key END AS {q(key)}", "_session AS session_start", "session_end", "n_rows"))
