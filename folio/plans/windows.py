"""Window-function reports (group 8).

Windows without PARTITION BY (8.1, 8.2, 8.7) are computed from small value
tables (``folio.operators.ranking``) so that no step sends all rows to one
task; the per-member LAG of 8.8 is computed chunk by chunk
(``folio.operators.lag``), as is the per-name LAG of 8.4. 8.6 orders the
table of days, which is bounded by the calendar.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.config import AS_OF_EVENTS
from folio.functions.scalar import days_between, full_name, ratio_round, year_month
from folio.operators.lag import chunked_lag
from folio.operators.ranking import (percent_rank_by_value, rank_by_value, running_total_by_key,
                                     sequence_within)
from folio.plans.common import loan_counts_per_book_with_copies
from folio.sources.library import Library

#: Pieces into which the ids of a day are cut where one member may hold a large part of it (8.8).
DAY_PIECES = 256


def q8_1_member_ranks(lib: Library) -> DataFrame:
    """ROW_NUMBER / RANK / DENSE_RANK of members by loan count (ties by member_id).

    rank and dense_rank come from the table of distinct counts; row_number =
    rank + position among members with the same count - 1, numbered per block.
    """
    per_member = lib.loans.groupBy("member_id").agg(F.count("loan_id").alias("total_loans"))
    ranked = rank_by_value(per_member, "total_loans", descending=True, rank_col="rank_no",
                           dense_col="dense_rank_no")
    numbered = sequence_within(ranked, ["total_loans"], ["member_id"], out_col="pos")
    return (numbered.join(lib.members.select("member_id", full_name().alias("member_name")), "member_id")
            .select((F.col("rank_no") + F.col("pos") - 1).alias("row_num"), "rank_no", "dense_rank_no",
                            "member_name", "total_loans", "member_id")
            .orderBy(F.col("total_loans").desc(), F.col("member_id"))
            .drop("member_id"))


def q8_2_running_fines(lib: Library) -> DataFrame:
    paid = lib.fines.filter(F.col("paid") == F.lit(True)).select("payment_date", "fine_amount", "fine_id")
    return (running_total_by_key(paid, "payment_date", "fine_amount", "running_total", nulls_first=True,
                                 result_type="decimal(20,2)")
            .orderBy(F.col("payment_date").asc_nulls_first(), "fine_id")
            .select("payment_date", "fine_amount", "running_total"))


def q8_3_top3_per_genre(lib: Library, k: int = 3) -> DataFrame:
    """Books with RANK <= k by loans inside their genre (ties kept).

    Spark plans the rank filter as a WindowGroupLimit that already runs before
    the shuffle, so a genre holding many books sends only its best rows."""
    per_book = loan_counts_per_book_with_copies(lib).join(lib.books.select("book_id", "genre", "title"), "book_id")
    w = Window.partitionBy("genre").orderBy(F.col("n_loans").desc())
    return (per_book.withColumn("genre_rank", F.rank().over(w).cast("long"))
            .filter(F.col("genre_rank") <= k)
            .orderBy("genre", "genre_rank", "book_id")
            .select("genre", "title", F.col("n_loans").alias("loan_count"), "genre_rank"))


def q8_4_monthly_change(lib: Library) -> DataFrame:
    """Member-month loan counts with the previous row of the same member name
    (the reference partitions by name, so namesakes share one sequence).

    Many members can share a name, so the LAG runs per chunk of
    (month, block of member ids) — see operators.lag."""
    monthly = (lib.loans.groupBy("member_id", year_month("loan_date").alias("loan_month"))
               .agg(F.count("loan_id").alias("monthly_loans"))
               .join(lib.members.select("member_id", full_name().alias("member_name")), "member_id")
               .withColumn("_chunk", F.struct("loan_month", F.floor(F.col("member_id") / F.lit(1 << 16)))))
    lagged = chunked_lag(monthly, ["member_name"], ["loan_month", "member_id"], "monthly_loans", "_chunk",
                         "prev_month_loans")
    return (lagged.withColumn("difference", F.col("monthly_loans") - F.col("prev_month_loans"))
            .orderBy("member_name", "loan_month", "member_id")
            .select("member_name", "loan_month", "monthly_loans", "prev_month_loans", "difference"))


def q8_5_next_event(lib: Library, as_of: _dt.date = AS_OF_EVENTS) -> DataFrame:
    """Each member's first event on/after as_of (earliest event_id on a tie):
    a min_by aggregate, combined map-side, instead of ROW_NUMBER per member."""
    events = lib.lib_events.filter(F.col("event_date") >= F.lit(as_of)).select("event_id", "event_name", "event_date")
    per_member = (lib.event_registrations.select("member_id", "event_id").join(events, "event_id")
                  .groupBy("member_id").agg(F.min_by(F.struct("event_name", "event_date"),
                                                     F.struct("event_date", "event_id")).alias("nxt")))
    return (per_member.join(lib.members.select("member_id", full_name().alias("member_name")), "member_id")
            .orderBy("nxt.event_date", "member_id")
            .select("member_name", F.col("nxt.event_name").alias("next_event"), F.col("nxt.event_date").alias("event_date")))


def q8_6_moving_avg(lib: Library, k: int = 30) -> DataFrame:
    daily = lib.loans.groupBy(F.col("loan_date").alias("loan_day")).agg(F.count("loan_id").alias("loans_count"))
    w = Window.orderBy("loan_day").rowsBetween(-6, 0)
    return (daily.withColumn("moving_avg_7_days",
                             ratio_round(F.sum("loans_count").over(w), F.count("loans_count").over(w), 2))
            .orderBy(F.col("loan_day").desc()).limit(k))


def q8_7_fine_percentile(lib: Library) -> DataFrame:
    """PERCENT_RANK of the unpaid fines, ranked on the fines alone; names are joined to the ranked rows
    (along foreign keys, so the population is the same)."""
    rows = lib.fines.filter(F.col("paid") == F.lit(False)).select("fine_id", "loan_id", "fine_amount")
    # blocks of 100 currency units: at most 10,000 distinct cent amounts each
    ranked = percent_rank_by_value(rows, "fine_amount", out_rank="_r", out_n="_n", block_width=100)
    pct = F.when(F.col("_n") == 1, F.lit(0.0)).otherwise(
        ratio_round(F.col("_r") - 1, F.col("_n") - 1, 2, mult=100))
    return (ranked.select("fine_id", "loan_id", "fine_amount", pct.alias("percentile_rank"))
            .join(lib.loans.select("loan_id", "member_id"), "loan_id")
            .join(lib.members.select("member_id", full_name().alias("member_name")), "member_id")
            .orderBy(F.col("percentile_rank").desc(), "fine_id")
            .select("member_name", "fine_amount", "percentile_rank"))


def q8_8_loan_gaps(lib: Library) -> DataFrame:
    """Days between a member's consecutive loans (ties on a day by loan_id).
    LAG per member is computed in pieces of a day (see operators.lag): a day's loans are cut by their ids into
    DAY_PIECES equal ranges, so that a piece stays small whatever one member borrows."""
    last = lib.loans.agg(F.coalesce(F.max("loan_id"), F.lit(0)).alias("last")).scalar()
    piece = F.floor(F.col("loan_id") / (last + 1) * DAY_PIECES)
    rows = (lib.loans.select("member_id", "loan_id", "loan_date")
            .withColumn("_piece", F.datediff("loan_date", F.lit("1970-01-01")).cast("long") * DAY_PIECES + piece))
    lagged = chunked_lag(rows, ["member_id"], ["loan_date", "loan_id"], "loan_date", "_piece", "prev_loan_date")
    return (lagged.join(lib.members.select("member_id", full_name().alias("member_name")), "member_id")
            .orderBy("member_name", "loan_date", "loan_id")
            .select("member_name", "loan_date", "prev_loan_date",
                    days_between("loan_date", "prev_loan_date").alias("days_gap")))
