"""Rows that last from a start to an end: overlapping pairs, and the most that are open at once.

``overlapping_pairs`` cuts time into bins. A row stands in every bin that it covers, and asks in the bin of its
own start alone; so a pair meets once, in the bin where the later of the two starts, and no duplicates are
removed. Cells (key and bin) with many rows are split on the asking side.

``peak_open`` sweeps over starts (+1) and ends (-1). Events of one moment are summed first; running sums are taken
inside blocks of time and lifted by the sums of the blocks before, so no group is one task's work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.ranking import offsets_before
from folio.operators.skew import q, q_list

#: Rows of a cell that one task compares with those standing in it.
CELL_ROWS = 1 << 12


def overlapping_pairs(df: DataFrame, key: str, row_id: str, start: str, end: str, width: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``key, first_id, second_id, overlap_start, overlap_end`` of all pairs of rows of a key whose times overlap; the first is the one
    that starts earlier (of equal starts, the smaller id). Starts and ends are whole numbers, the end is not part
    of the row, and ``width`` is that of a bin. Rows without key, start or end, or that end before they last, pair with nothing."""
    usable = df.where(f"{q(key)} IS NOT NULL AND {q(start)} < {q(end)}").selectExpr(
        f"{q(key)} AS _key", f"{q(row_id)} AS _id", f"CAST({q(start)} AS LONG) AS _start", f"CAST({q(end)} AS LONG) AS _end")
    asking = usable.selectExpr("*", f"CAST(floor(_start / {width}) AS LONG) AS _bin")
    # A cell with many asking rows is cut; who stands in it stands in each part. There are few such cells (rows / cell_rows at most).
    cut = (asking.groupBy("_key", "_bin").agg(F.count(F.lit(1)).alias("_n")).where(f"_n > {cell_rows}")
           .selectExpr("_key", "_bin", f"CAST(ceil(_n / {cell_rows}) AS INT) AS _parts"))
    asks = (asking.join(cut, ["_key", "_bin"], "left")
            .selectExpr("_key", "_bin", "_id AS second_id", "_start AS _s2", "_end AS _e2", "CAST(pmod(xxhash64(_id), coalesce(_parts, 1)) AS INT) AS _part"))
    stands = (usable.selectExpr("*", f"explode(sequence(CAST(floor(_start / {width}) AS LONG), CAST(floor((_end - 1) / {width}) AS LONG))) AS _bin")
              .join(cut, ["_key", "_bin"], "left")
              .selectExpr("_key", "_bin", "_id AS first_id", "_start AS _s1", "_end AS _e1", "explode(sequence(0, coalesce(_parts, 1) - 1)) AS _part"))
    return (stands.join(asks, ["_key", "_bin", "_part"])
            .where("first_id <> second_id AND (_s1 < _s2 OR (_s1 = _s2 AND first_id < second_id)) AND _s2 < _e1")
            .selectExpr(f"_key AS {q(key)}", "first_id", "second_id", "_s2 AS overlap_start", "least(_e1, _e2) AS overlap_end"))


def peak_open(df: DataFrame, groups: Sequence[str], start: str, end: str, block_width: int) -> DataFrame:
    """``groups, peak, reached``: the most rows of a group open at one moment, and the first such moment. Starts and ends are
    whole numbers; a row is open from its start until before its end. Rows without start or end, or that end before they last, count nowhere."""
    groups = list(groups)
    usable = df.where(f"{q(start)} < {q(end)}")
    steps = usable.selectExpr(*[q(g) for g in groups], f"inline(array(struct(CAST({q(start)} AS LONG) AS _at, 1L AS _step), struct(CAST({q(end)} AS LONG) AS _at, -1L AS _step)))")
    moments = steps.groupBy(*groups, "_at").agg(F.sum("_step").alias("_step")).selectExpr("*", f"CAST(floor(_at / {block_width}) AS LONG) AS _block")
    blocks = moments.groupBy(*groups, "_block").agg(F.sum("_step").alias("_step"))
    before = offsets_before(blocks, groups, "_block", {"_step": "_open_before"})
    running = f"sum(_step) OVER (PARTITION BY {q_list([*groups, '_block'])} ORDER BY _at)"
    level = (moments.repartition(*groups, "_block").selectExpr("*", f"{running} AS _inside").join(before, [*groups, "_block"])
             .selectExpr(*[q(g) for g in groups], "_at", "_inside + _open_before AS _open"))
    best = level.groupBy(*groups).agg(F.max(F.struct("_open", F.expr("-_at AS _early"))).alias("_m"))
    return best.selectExpr(*[q(g) for g in groups], "_m._open AS peak", "-_m._early AS reached")
