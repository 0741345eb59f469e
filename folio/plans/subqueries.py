"""Subquery and CTE reports (group 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.config import MEMBERSHIP_FEE
from folio.functions.scalar import full_name, ratio_round, year_month
from folio.operators.topk import enrich_top_k
from folio.plans.common import book_author, copy_dim, loans_per_book, unpaid_fines_per_loan
from folio.sources.library import Library


def q6_1_above_avg_fines(lib: Library) -> DataFrame:
    """Members whose unpaid total exceeds the mean unpaid total per loan.

    mean = S / N (S = all unpaid, N = loans with unpaid fines), one scalar
    subquery; ``total > S / N`` is tested as ``total * N > S`` — exact.
    """
    per_loan = unpaid_fines_per_loan(lib)
    stats = per_loan.select(F.struct(F.sum("unpaid_sum").alias("s"), F.count(F.lit(1)).alias("n"))).scalar()
    per_member = (per_loan.join(lib.loans.select("loan_id", "member_id"), "loan_id")
                  .groupBy("member_id").agg(F.sum("unpaid_sum").cast("decimal(20,2)").alias("total_unpaid_fines"),
                                            F.sum("unpaid_count").cast("long").alias("number_of_fines")))
    return (per_member.filter(F.col("total_unpaid_fines") * stats.getField("n") > stats.getField("s"))
            .join(lib.members.select("member_id", full_name().alias("member_name")), "member_id")
            .orderBy(F.col("total_unpaid_fines").desc(), "member_id")
            .select("member_name", "total_unpaid_fines", "number_of_fines"))


def q6_2_popular_books(lib: Library) -> DataFrame:
    """Books lent more often than the mean over books that were lent at all."""
    per_book = loans_per_book(lib)
    stats = per_book.select(F.struct(F.sum("n_loans").alias("s"), F.count(F.lit(1)).alias("n"))).scalar()
    return (per_book.filter(F.col("n_loans") * stats.getField("n") > stats.getField("s"))
            .join(book_author(lib), "book_id")
            .orderBy(F.col("n_loans").desc(), "book_id")
            .select(F.col("title").alias("book_title"), F.col("author_name").alias("author"),
                    F.col("n_loans").cast("long").alias("total_loans"),
                    ratio_round(stats.getField("s"), stats.getField("n"), 4).alias("avg_loans")))


def q6_3_borrowing_summary(lib: Library) -> DataFrame:
    loan_counts = lib.loans.groupBy("member_id").agg(
        F.count(F.lit(1)).alias("lc"), F.count(F.when(F.col("status") == "active", 1)).alias("ac"))
    fine_totals = (lib.fines.groupBy("loan_id").agg(F.sum("fine_amount").alias("s"))
                   .join(lib.loans.select("loan_id", "member_id"), "loan_id")
                   .groupBy("member_id").agg(F.sum("s").alias("ft")))
    active = F.coalesce(F.col("ac"), F.lit(0)).cast("long")
    return (lib.members.select("member_id", full_name().alias("member_name"))
            .join(loan_counts, "member_id", "left")
            .join(fine_totals, "member_id", "left")
            .orderBy(F.coalesce(F.col("lc"), F.lit(0)).desc(), "member_id")
            .select("member_name",
                    F.coalesce(F.col("lc"), F.lit(0)).cast("long").alias("total_loans"),
                    active.alias("active_loans"),
                    F.coalesce(F.col("ft"), F.lit(0)).cast("decimal(20,2)").alias("total_fines"),
                    F.when(active > 0, "Active Borrower").otherwise("Inactive").alias("member_status")))


def q6_4_books_never_loaned(lib: Library) -> DataFrame:
    lent_copies = lib.book_copies.select("copy_id", "book_id").join(
        lib.loans.select("copy_id").distinct(), "copy_id", "left_semi")
    lent_books = lent_copies.select("book_id").distinct()
    never = lib.books.join(lent_books, "book_id", "left_anti")
    copies = lib.book_copies.groupBy("book_id").agg(F.count("copy_id").alias("n_copies"))
    return (never.select("book_id", "title", "genre", "publication_year", "author_id")
            .join(lib.authors.select("author_id", F.col("author_name").alias("author")), "author_id")
            .join(copies, "book_id", "left")
            .orderBy("publication_year", "book_id")
            .select("title", "author", "genre",
                    F.coalesce(F.col("n_copies"), F.lit(0)).cast("long").alias("total_copies"),
                    "publication_year"))


def q6_5_attended_all(lib: Library, event_type: str = "book_club") -> DataFrame:
    """Relational division by counting: (event, member) is unique, so a member
    registered for every event of the type has as many rows as there are events."""
    club = lib.lib_events.filter(F.col("event_type") == event_type).select("event_id")
    n_events = club.select(F.count(F.lit(1))).scalar()
    per_member = (lib.event_registrations.select("event_id", "member_id").join(club, "event_id")
                  .groupBy("member_id").agg(F.count("event_id").alias("events_attended")))
    return (per_member.filter(F.col("events_attended") == n_events)
            .join(lib.members.select("member_id", full_name().alias("member_name")), "member_id")
            .orderBy("member_name", "member_id")
            .select("member_name", "events_attended"))


def q6_6_monthly_revenue(lib: Library, k: int = 12) -> DataFrame:
    """Fines paid plus membership fees per month, latest k months.

    The reference's ``f ⟕ m UNION m ⟕ f`` is a full outer join of two tables
    that each have one row per month; a NULL month (paid, no payment date)
    matches nothing and stays its own row.
    """
    fr = (lib.fines.filter(F.col("paid") == F.lit(True))
          .groupBy(year_month("payment_date").alias("f_month"))
          .agg(F.sum("fine_amount").cast("decimal(20,2)").alias("fine_total")))
    mr = (lib.members.groupBy(year_month("join_date").alias("m_month"))
          .agg((F.count("member_id") * MEMBERSHIP_FEE).cast("long").alias("membership_total")))
    fine_rev = F.coalesce(F.col("fine_total"), F.lit(0)).cast("decimal(20,2)")
    member_rev = F.coalesce(F.col("membership_total"), F.lit(0)).cast("long")
    return (fr.join(mr, F.col("f_month") == F.col("m_month"), "full_outer")
            .select(F.coalesce("f_month", "m_month").alias("month"),
                    fine_rev.alias("fine_revenue"), member_rev.alias("membership_revenue"),
                    (fine_rev + member_rev).cast("decimal(20,2)").alias("total_revenue"))
            .orderBy(F.col("month").desc_nulls_last()).limit(k))


def q6_7_last_loan(lib: Library) -> DataFrame:
    """Per lent book: latest loan date and that loan's borrower (latest loan_id
    on a tie), in aggregates instead of two correlated subqueries.

    The arg-max decomposes: the latest (date, loan) per copy is found on the
    loans alone (map-side combined), so only one row per copy is joined to
    the copies; the books then take the latest of their copies."""
    latest = F.struct("loan_date", "loan_id", "member_id")
    per_copy = lib.loans.groupBy("copy_id").agg(F.max(latest).alias("last"))
    per_book = (per_copy.join(lib.book_copies.select("copy_id", "book_id"), "copy_id")
                .groupBy("book_id").agg(F.max("last").alias("last")))
    names = lib.members.select(F.col("member_id").alias("last_member"), full_name().alias("last_borrower"))
    return (per_book.join(book_author(lib), "book_id")
            .select("book_id", "title", "author_name", F.col("last.loan_date").alias("most_recent_loan"),
                    F.col("last.member_id").alias("last_member"))
            .join(names, "last_member", "left")
            .orderBy(F.col("most_recent_loan").desc(), "book_id")
            .select(F.col("title").alias("book_title"), F.col("author_name").alias("author"),
                    "most_recent_loan", "last_borrower"))


def q6_8_recommendations(lib: Library, k: int = 5) -> DataFrame:
    """Unread books of each member's favourite genre; the first k rows in
    (member_id, book_id) order.

    A member has something unread if the genre has more books than the member
    read of it. The k smallest such members hold the first k rows (each has at
    least one), so only their genres' books and their own loans are looked at.
    """
    read = (lib.loans.select("member_id", "copy_id").join(copy_dim(lib, "genre"), "copy_id")
            .groupBy("member_id", "genre", "book_id").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("member_id", "genre").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("books_read")))
    favourite = (read.groupBy("member_id")
                 .agg(F.min_by(F.struct("genre", "books_read"), F.struct(-F.col("c"), F.col("genre"))).alias("f"))
                 .select("member_id", "f.*"))
    books = book_author(lib).select("book_id", "title", "genre")
    in_genre = books.groupBy("genre").agg(F.count(F.lit(1)).alias("books"))
    names = lib.members.select("member_id", full_name().alias("member_name"))
    first = (favourite.join(in_genre, "genre").filter(F.col("books") > F.col("books_read"))
             .join(lib.members.select("member_id"), "member_id", "left_semi")
             .orderBy("member_id").limit(k).select("member_id", "genre"))
    # k rows: a proven bound for the broadcasts below.
    own = (F.broadcast(first.select("member_id")).join(lib.loans.select("member_id", "copy_id"), "member_id")
           .join(lib.book_copies.select("copy_id", "book_id"), "copy_id").select("member_id", "book_id").distinct())
    unread = F.broadcast(first).join(books, "genre").join(own, ["member_id", "book_id"], "left_anti")
    top = unread.orderBy("member_id", "book_id").limit(k)
    return (enrich_top_k(top, (names, "member_id", "inner"))
            .orderBy("member_id", "book_id")
            .select("member_name", F.col("genre").alias("favorite_genre"),
                    F.col("title").alias("recommended_book")))
