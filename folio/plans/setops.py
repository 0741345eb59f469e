"""Set-operation reports (group 7)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.config import AS_OF
from folio.functions.scalar import full_name
from folio.operators.topk import enrich_top_k, keep_top_k_with_ties, top_k_cut
from folio.plans.common import (active_loans_per_copy, copy_dim,
                                loan_counts_per_book_with_copies, unpaid_fines_per_loan)
from folio.sources.library import Library


def q7_1_all_people(lib: Library) -> DataFrame:
    people = lib.members.select(full_name().alias("full_name"), "email", F.lit("Member").alias("type"))
    authors = lib.authors.select(F.col("author_name").alias("full_name"), F.lit(None).cast("string").alias("email"),
                                 F.lit("Author").alias("type"))
    return people.unionByName(authors).distinct().orderBy("type", "full_name")


def q7_2_activity_log(lib: Library, k: int = 50) -> DataFrame:
    """Newest k of loans ∪ events ∪ registrations.

    Each arm is first cut to the rows whose date reaches that arm's k-th
    newest date, so only those rows are joined to members and books; the
    final order adds type, person and description as tie-breaks.

    Loans and registrations are cut further, as one date may hold very many. Rows
    newer than the cut date are fewer than k. Among the rows on the cut date, the
    ones that can still be in the top k belong to members whose name is among
    the k smallest names of members with a row that day (ties kept): every
    such member has at least one of those rows. Only those rows are joined.
    """
    names = lib.members.select("member_id", full_name().alias("person"))

    def newest(rows: DataFrame, day: str) -> DataFrame:
        cut = top_k_cut(rows, day, k)
        newer = rows.filter(F.col(day) > cut.getField("v"))
        on_cut = rows.filter(F.col(day) == cut.getField("v"))
        first_names = keep_top_k_with_ties(on_cut.select("member_id").distinct().join(names, "member_id"),
                                           "person", k, descending=False)
        return newer.unionByName(on_cut.join(first_names.select("member_id"), "member_id", "left_semi"))

    loan_arm = (newest(lib.loans.select("loan_id", "member_id", "copy_id", "loan_date"), "loan_date").join(copy_dim(lib, "title"), "copy_id")
                .join(names, "member_id")
                .withColumnRenamed("title", "description")
                .select(F.lit("Loan").alias("activity_type"), F.col("loan_date").alias("activity_date"),
                        "person", "description"))
    events = keep_top_k_with_ties(lib.lib_events, "event_date", k)
    event_arm = events.select(F.lit("Event").alias("activity_type"), F.col("event_date").alias("activity_date"),
                              F.lit(None).cast("string").alias("person"), F.col("event_name").alias("description"))
    regs = newest(lib.event_registrations.select("event_id", "member_id", "registration_date"), "registration_date")
    reg_arm = (regs.join(names, "member_id")
               .join(lib.lib_events.select("event_id", F.col("event_name").alias("description")), "event_id")
               .select(F.lit("Registration").alias("activity_type"),
                       F.col("registration_date").alias("activity_date"), "person", "description"))
    return (loan_arm.unionByName(event_arm).unionByName(reg_arm)
            .orderBy(F.col("activity_date").desc(), F.col("activity_type"), F.col("person").asc_nulls_first(),
                     F.col("description"))
            .limit(k))


def q7_3_available_vs_loaned(lib: Library) -> DataFrame:
    """Per title: copies without an active loan, and active-loan rows.

    Both arms of the reference come from one per-copy table (k = active
    loans of the copy), aggregated once and unpivoted; a title gets an arm's
    row only when that arm counts at least one row, as with GROUP BY.
    """
    per_copy = (lib.book_copies.select("copy_id", "book_id")
                .join(active_loans_per_copy(lib), "copy_id", "left")
                .select("book_id", F.coalesce(F.col("k"), F.lit(0)).alias("k")))
    per_book = per_copy.groupBy("book_id").agg(
        F.count(F.when(F.col("k") == 0, 1)).alias("available"), F.sum("k").alias("on_loan"))
    per_title = (per_book.join(lib.books.select("book_id", "title"), "book_id")
                 .groupBy("title").agg(F.sum("available").cast("long").alias("available"),
                                       F.sum("on_loan").cast("long").alias("on_loan")))
    arms = F.array(F.struct(F.lit("Available").alias("status"), F.col("available").alias("total")),
                   F.struct(F.lit("On Loan").alias("status"), F.col("on_loan").alias("total")))
    return (per_title.select("title", F.inline(arms))
            .filter(F.col("total") > 0)
            .orderBy("title"))


def q7_4_members_with_issues(lib: Library, as_of: _dt.date = AS_OF) -> DataFrame:
    who = lib.members.select("member_id", full_name().alias("member_name"), "email")
    overdue = (lib.loans.filter((F.col("due_date") < F.lit(as_of)) & (F.col("status") == "active"))
               .groupBy("member_id").agg(F.count(F.lit(1)).alias("issue_count"))
               .withColumn("issue_type", F.lit("Overdue")))
    unpaid = (unpaid_fines_per_loan(lib).join(lib.loans.select("loan_id", "member_id"), "loan_id")
              .groupBy("member_id").agg(F.sum("unpaid_count").cast("long").alias("issue_count"))
              .withColumn("issue_type", F.lit("Unpaid Fines")))
    arms = overdue.unionByName(unpaid).join(who, "member_id").select("member_name", "email", "issue_type",
                                                                     "issue_count")
    suspended = lib.members.filter(F.col("status") == "suspended").select(
        full_name().alias("member_name"), "email", F.lit("Suspended").alias("issue_type"),
        F.lit(1).cast("long").alias("issue_count"))
    return arms.unionByName(suspended).distinct().orderBy("member_name")


def q7_5_popular_unpopular(lib: Library, k: int = 10) -> DataFrame:
    """The two top k are taken on the counts alone; only their rows are joined (along foreign keys)."""
    per_book = loan_counts_per_book_with_copies(lib)
    popular = (per_book.filter(F.col("n_loans") > 0).orderBy(F.col("n_loans").desc(), F.col("book_id")).limit(k)
               .withColumn("category", F.lit("Popular")))
    unpopular = (per_book.orderBy(F.col("n_loans").asc(), F.col("book_id")).limit(k)
                 .withColumn("category", F.lit("Unpopular")))
    books = lib.books.select("book_id", "title", "author_id")
    authors = lib.authors.select("author_id", F.col("author_name").alias("author"))
    return (enrich_top_k(popular.unionByName(unpopular), (books, "book_id", "inner"), (authors, "author_id", "inner"))
            .orderBy("category", "n_loans", "book_id")
            .select("title", "author", "category", F.col("n_loans").alias("loan_count")))
