"""Aggregation reports (group 4)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.config import AS_OF_EVENTS
from folio.functions.scalar import full_name, ratio_round
from folio.operators.topk import enrich_top_k, top_k_cut
from folio.plans.common import book_author
from folio.sources.library import Library


def q4_1_membership_share(lib: Library) -> DataFrame:
    """Members per type and their share of all members. The total is summed
    over the grouped rows (one per membership type), not by a second scan."""
    grouped = lib.members.groupBy("membership_type").agg(F.count(F.lit(1)).alias("member_count"))
    total = F.sum("member_count").over(Window.partitionBy())
    return (grouped.select("membership_type", "member_count",
                           ratio_round(F.col("member_count"), total, 2, mult=100).alias("percentage"))
            .orderBy(F.col("member_count").desc()))


def q4_2_fines_summary(lib: Library) -> DataFrame:
    """Per paid-state rows plus the overall row, from one ROLLUP over paid: a
    single scan and shuffle. grouping_id tells the overall row from a group
    whose paid is NULL (which, as in the reference, reads 'Outstanding')."""
    rolled = lib.fines.rollup("paid").agg(F.sum("fine_amount").cast("decimal(20,2)").alias("total_amount"),
                                          F.count(F.lit(1)).alias("fine_count"),
                                          F.grouping_id().alias("_overall"))
    status = (F.when(F.col("_overall") == 1, "Overall Total")
              .when(F.col("paid") == F.lit(True), "Collected").otherwise("Outstanding"))
    return rolled.select(status.alias("payment_status"), "total_amount", "fine_count")


def q4_3_top_genres(lib: Library, k: int = 5) -> DataFrame:
    return (lib.books.groupBy("genre").agg(F.countDistinct("book_id").alias("number_of_titles"),
                                           F.sum("total_copies").cast("long").alias("total_copies"))
            .orderBy(F.col("total_copies").desc(), F.col("genre")).limit(k))


def q4_4_avg_loan_days(lib: Library) -> DataFrame:
    """Mean loan length of returned loans per membership type. Loans are summed
    per member first (map-side combined), then joined to members."""
    per_member = (lib.loans.filter(F.col("status") == "returned")
                  .select("member_id", "loan_id", F.datediff("return_date", "loan_date").alias("d"))
                  .groupBy("member_id").agg(F.sum("d").alias("sum_d"), F.count("d").alias("n_d"),
                                            F.count("loan_id").alias("n_loans")))
    by_type = (per_member.join(lib.members.select("member_id", "membership_type"), "member_id")
               .groupBy("membership_type").agg(F.sum("sum_d").alias("sum_d"), F.sum("n_d").alias("n_d"),
                                               F.sum("n_loans").alias("total_loans")))
    return (by_type.select("membership_type", ratio_round(F.col("sum_d"), F.col("n_d"), 1).alias("avg_loan_days"),
                           F.col("total_loans").cast("long").alias("total_loans"))
            .orderBy(F.col("avg_loan_days").desc()))


def q4_5_never_borrowed_copies(lib: Library) -> DataFrame:
    lent_copies = lib.loans.select("copy_id").distinct()
    never = lib.book_copies.select("copy_id", "book_id", "acquisition_date").join(lent_copies, "copy_id", "left_anti")
    return (never.join(book_author(lib), "book_id")
            .orderBy("acquisition_date", "copy_id")
            .select("title", "author_name", "genre", "acquisition_date"))


def q4_6_member_activity(lib: Library, k: int = 10) -> DataFrame:
    """Members by number of (loan, fine) rows of ``members ⟕ loans ⟕ fines``.

    The reference counts after joining fines, so a loan with two fines counts
    twice. Fines are first reduced to one row per loan (count, unpaid sum); a
    loan then weighs max(#fines, 1) — the same numbers without the fan-out.
    """
    per_loan = lib.fines.groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("n_fines"),
        F.sum(F.when(F.col("paid") == F.lit(False), F.col("fine_amount")).otherwise(F.lit(0)))
        .alias("unpaid"))
    weighted = (lib.loans.select("loan_id", "member_id", "status").join(per_loan, "loan_id", "left")
                .select("member_id",
                        F.greatest(F.coalesce(F.col("n_fines"), F.lit(0)), F.lit(1)).alias("w"),
                        F.col("status"), F.coalesce(F.col("unpaid"), F.lit(0)).alias("unpaid")))
    per_member = weighted.groupBy("member_id").agg(
        F.sum("w").cast("long").alias("total_loans"),
        F.sum(F.when(F.col("status") == "active", F.col("w")).otherwise(F.lit(0))).cast("long").alias("active_loans"),
        F.sum("unpaid").cast("decimal(20,2)").alias("unpaid_fines"))
    order = [F.col("total_loans").desc(), F.col("member_id")]
    top = per_member.filter(F.col("total_loans") > 0).orderBy(*order).limit(k)
    return (enrich_top_k(top, (lib.members.select("member_id", full_name().alias("member_name")), "member_id", "inner"))
            .orderBy(*order)
            .select("member_name", "total_loans", "active_loans", "unpaid_fines"))


def q4_7_monthly_loans(lib: Library, k: int = 6) -> DataFrame:
    """The newest k months. They are found first (a small aggregate of months), so the distinct counts
    expand only their loans and not the whole history."""
    months = lib.loans.select(F.trunc("loan_date", "month").alias("m")).distinct()
    cut = top_k_cut(months, "m", k)
    newest = F.coalesce(F.col("loan_date") >= cut.getField("v"), F.lit(False)) | (cut.getField("n") < k)
    joined = (lib.loans.select("loan_id", "member_id", "copy_id", "loan_date").filter(newest)
              .join(lib.book_copies.select("copy_id", "book_id"), "copy_id"))
    return (joined.groupBy(F.year("loan_date").cast("long").alias("loan_year"),
                           F.month("loan_date").cast("long").alias("loan_month"))
            .agg(F.count("loan_id").alias("total_loans"),
                 F.countDistinct("member_id").alias("unique_borrowers"),
                 F.countDistinct("book_id").alias("unique_books"))
            .orderBy(F.col("loan_year").desc(), F.col("loan_month").desc()).limit(k))


def q4_8_event_capacity(lib: Library, as_of: _dt.date = AS_OF_EVENTS) -> DataFrame:
    regs = lib.event_registrations.groupBy("event_id").agg(F.count("registration_id").alias("n"))
    events = lib.lib_events.filter(F.col("event_date") > F.lit(as_of))
    out = (events.join(regs, "event_id", "left")
           .select("event_id", "event_name", "event_date",
                   F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("registrations"),
                   "max_attendees"))
    return (out.withColumn("capacity_percentage",
                           ratio_round(F.col("registrations"), F.col("max_attendees"), 1, mult=100))
            .orderBy(F.col("capacity_percentage").desc(), "event_id").drop("event_id"))
