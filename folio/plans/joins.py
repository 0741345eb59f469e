"""Join reports (group 5)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.config import AS_OF, AS_OF_EVENTS
from folio.functions.scalar import days_between, full_name, ratio_round
from folio.operators.pairs import pairs_within_key
from folio.operators.topk import enrich_top_k
from folio.plans.common import (active_loans_per_copy, book_author, copy_dim, loans_per_book,
                                unpaid_fines_per_loan)
from folio.sources.library import Library


def q5_1_loan_history(lib: Library, k: int = 20) -> DataFrame:
    """The k newest loans with member, book and author. The top-k (ties by
    loan_id) is taken on loans alone; the joins follow foreign keys."""
    order = [F.col("loan_date").desc(), F.col("loan_id").desc()]
    top = lib.loans.orderBy(*order).limit(k)
    books = lib.books.select("book_id", F.col("title").alias("book_title"), "author_id")
    authors = lib.authors.select("author_id", F.col("author_name").alias("author"))
    return (enrich_top_k(top,
                         (lib.members.select("member_id", full_name().alias("member_name"), "email"), "member_id",
                          "inner"),
                         (lib.book_copies.select("copy_id", "book_id"), "copy_id", "inner"),
                         (books, "book_id", "inner"), (authors, "author_id", "inner"))
            .orderBy(*order)
            .select("member_name", "email", "book_title", "author", "loan_date", "due_date",
                    "return_date", "status"))


def q5_2_on_loan(lib: Library, as_of: _dt.date = AS_OF) -> DataFrame:
    active = lib.loans.filter(F.col("status") == "active").select("loan_id", "member_id", "copy_id", "loan_date", "due_date")
    copies = copy_dim(lib, "title", author=True, copy_cols=("copy_number",))
    return (active.join(copies, "copy_id")
            .join(lib.members.select("member_id", full_name().alias("member_name")), "member_id")
            .orderBy("due_date", "loan_id")
            .select(F.col("title").alias("book_title"), F.col("author_name").alias("author"), "copy_number",
                    "member_name", "loan_date", "due_date",
                    days_between("due_date", F.lit(as_of)).alias("days_until_due")))


def q5_3_members_unpaid(lib: Library) -> DataFrame:
    """Members with unpaid fines: number of loans with an unpaid fine, total.
    Fines are reduced per loan, then per member, before members are joined."""
    per_member = (unpaid_fines_per_loan(lib).join(lib.loans.select("loan_id", "member_id"), "loan_id")
                  .groupBy("member_id").agg(F.count("loan_id").alias("overdue_books"),
                                            F.sum("unpaid_sum").cast("decimal(20,2)").alias("total_unpaid_fines")))
    return (per_member.join(lib.members.select("member_id", full_name().alias("member_name"), "email", "phone"),
                            "member_id")
            .orderBy(F.col("total_unpaid_fines").desc(), "member_id")
            .select("member_name", "email", "phone", "overdue_books", "total_unpaid_fines"))


def q5_4_availability(lib: Library) -> DataFrame:
    """Copies, copies on loan and available copies per book.

    As in the reference, ``copies ⟕ active loans`` counts a copy with k active
    loans k times; per copy that is max(k, 1) copy rows and k loan rows.
    """
    per_copy = (lib.book_copies.select("copy_id", "book_id")
                .join(active_loans_per_copy(lib), "copy_id", "left")
                .select("book_id", F.coalesce(F.col("k"), F.lit(0)).alias("k")))
    per_book = per_copy.groupBy("book_id").agg(
        F.sum(F.greatest(F.col("k"), F.lit(1))).cast("long").alias("total_copies"),
        F.sum("k").cast("long").alias("copies_on_loan"))
    books = book_author(lib).select("book_id", F.col("title").alias("book_title"), F.col("author_name").alias("author"))
    out = (books.join(per_book, "book_id", "left")
           .select("book_id", "book_title", "author",
                   F.coalesce(F.col("total_copies"), F.lit(0)).cast("long").alias("total_copies"),
                   F.coalesce(F.col("copies_on_loan"), F.lit(0)).cast("long").alias("copies_on_loan")))
    return (out.withColumn("available_copies", F.col("total_copies") - F.col("copies_on_loan"))
            .orderBy("available_copies", "book_id").drop("book_id"))


def q5_5_attendance(lib: Library, as_of: _dt.date = AS_OF_EVENTS) -> DataFrame:
    events = lib.lib_events.filter(F.col("event_date") >= F.lit(as_of)).select("event_id", "event_name", "event_date")
    return (lib.event_registrations.select("event_id", "member_id", "registration_date")
            .join(events, "event_id")
            .join(lib.members.select("member_id", full_name().alias("member_name"), "email", "last_name"), "member_id")
            .orderBy("event_date", "last_name", "member_id", "event_id")
            .select("event_name", "event_date", "member_name", "email", "registration_date"))


def q5_6_author_popularity(lib: Library, k: int = 10) -> DataFrame:
    """Authors by loans: books with loans, loans, loans per book (top k).
    Loans are counted per copy, then per book, then per author."""
    per_author = (loans_per_book(lib).join(lib.books.select("book_id", "author_id"), "book_id")
                  .groupBy("author_id").agg(F.countDistinct("book_id").alias("book_count"),
                                            F.sum("n_loans").cast("long").alias("total_loans")))
    order = [F.col("total_loans").desc(), F.col("author_id")]
    top = per_author.filter(F.col("total_loans") > 0).orderBy(*order).limit(k)
    return (enrich_top_k(top, (lib.authors.select("author_id", F.col("author_name").alias("author")), "author_id", "inner"))
            .orderBy(*order)
            .select("author", "book_count", "total_loans",
                    ratio_round(F.col("total_loans"), F.col("book_count"), 2).alias("avg_loans_per_book")))


def q5_7_members_never_borrowed(lib: Library) -> DataFrame:
    borrowers = lib.loans.select("member_id").distinct()
    return (lib.members.join(borrowers, "member_id", "left_anti")
            .orderBy("join_date", "member_id")
            .select(full_name().alias("member_name"), "email", "join_date", "membership_type"))


def q5_8_same_address_pairs(lib: Library) -> DataFrame:
    people = lib.members.select("member_id", "address", full_name().alias("name"))
    pairs = pairs_within_key(people, "address", "member_id", ["name"])
    return (pairs.orderBy("address", "a_member_id", "b_member_id")
            .select(F.col("a_name").alias("member_1"), F.col("b_name").alias("member_2"),
                    F.col("address").alias("shared_address")))
