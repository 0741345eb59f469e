"""Basic reports: filters, projections, sorts, small joins (group 3).

Here and in the other groups, a sort on a column of few values (a year, a date, a count) ends with the
row's unique id: a range exchange never splits equal sort keys, so without it one task would get
all rows of a value."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.config import AS_OF, AS_OF_EVENTS, RECENT_JOIN_DAYS, UPCOMING_EVENT_DAYS
from folio.functions.scalar import days_between, full_name
from folio.operators.topk import enrich_top_k
from folio.plans.common import copy_dim
from folio.sources.library import Library


def q3_1_active_members(lib: Library) -> DataFrame:
    return (lib.members.filter(F.col("status") == "active")
            .orderBy("last_name", "first_name", "member_id")
            .select("first_name", "last_name", "email", "membership_type"))


def q3_2_books_since_2001(lib: Library, min_year: int = 2001) -> DataFrame:
    books = lib.books.filter(F.col("publication_year") >= min_year)
    return (books.join(lib.authors.select("author_id", "author_name"), "author_id", "left")
            .orderBy(F.col("publication_year").desc(), "book_id")
            .select("title", "author_name", F.col("publication_year").alias("pub_year"), "genre"))


def q3_3_genre_search(lib: Library, genre: str = "PROMO") -> DataFrame:
    """Copies per book of one genre (0 for a book without copies)."""
    books = lib.books.filter(F.col("genre") == genre).select("book_id", "title", "genre", "author_id")
    copies = lib.book_copies.select("book_id", "copy_id")
    return (books.join(lib.authors.select("author_id", "author_name"), "author_id", "left")
            .join(copies, "book_id", "left")
            .groupBy("book_id", "title", "author_name", "genre")
            .agg(F.count("copy_id").alias("total_copies"))
            .orderBy("title", "book_id")
            .select("title", "author_name", "genre", "total_copies"))


def q3_4_overdue_loans(lib: Library, as_of: _dt.date = AS_OF) -> DataFrame:
    loans = lib.loans.filter((F.col("status") == "active") & (F.col("due_date") < F.lit(as_of)))
    return (loans.select("loan_id", "member_id", "copy_id", "loan_date", "due_date")
            .join(copy_dim(lib, "title"), "copy_id")
            .join(lib.members.select("member_id", full_name().alias("member_name")), "member_id")
            .orderBy("due_date", "loan_id")  # the most days overdue first
            .select("member_name", F.col("title").alias("book_title"), "loan_date", "due_date",
                    days_between(F.lit(as_of), "due_date").alias("days_overdue")))


def q3_5_recent_joiners(lib: Library, as_of: _dt.date = AS_OF, days: int = RECENT_JOIN_DAYS) -> DataFrame:
    return (lib.members.filter(F.col("join_date") >= F.date_sub(F.lit(as_of), days))
            .orderBy(F.col("join_date").desc(), "member_id")
            .select("first_name", "last_name", "join_date", "membership_type"))


def q3_6_poor_condition(lib: Library) -> DataFrame:
    copies = lib.book_copies.filter(F.col("condition_status").isin("poor", "fair"))
    severity = F.when(F.col("condition_status") == "poor", 1).when(F.col("condition_status") == "fair", 2).otherwise(3)
    return (copies.join(lib.books.select("book_id", F.col("title").alias("book_title")), "book_id")
            .orderBy(severity, "acquisition_date", "copy_id")
            .select("book_title", "copy_number", "condition_status", "acquisition_date"))


def q3_7_top_unpaid_fines(lib: Library, k: int = 10) -> DataFrame:
    """The k largest unpaid fines. The top-k is taken on fines alone (ties by
    fine_id), then joined along foreign keys: only k rows reach the joins."""
    top = (lib.fines.filter(F.col("paid") == F.lit(False))
           .orderBy(F.col("fine_amount").desc(), F.col("fine_id")).limit(k)
           .select("fine_id", "loan_id", "fine_amount", "fine_reason"))
    return (enrich_top_k(top, (lib.loans.select("loan_id", "member_id", "loan_date"), "loan_id", "inner"),
                         (lib.members.select("member_id", full_name().alias("member_name")), "member_id", "inner"))
            .orderBy(F.col("fine_amount").desc(), F.col("fine_id"))
            .select("member_name", "fine_amount", "fine_reason", "loan_date"))


def q3_8_upcoming_events(lib: Library, as_of: _dt.date = AS_OF_EVENTS,
                         days: int = UPCOMING_EVENT_DAYS) -> DataFrame:
    d = F.col("event_date")
    return (lib.lib_events.filter((d > F.lit(as_of)) & (d <= F.date_add(F.lit(as_of), days)))
            .orderBy("event_date", "event_id")
            .select("event_name", "event_date", "event_type", "max_attendees"))
