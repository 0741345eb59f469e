"""Shared building blocks of the reports.

Reports aggregate the big fact tables (loans, fines, registrations) on their
join key *before* joining descriptive dimension columns back: the partial
(map-side) aggregate shrinks what is shuffled, and a hot key is combined on
the map side instead of landing on one reducer.

Inner joins to a parent table along a declared foreign key (loans→members,
loans→book_copies, book_copies→books, books→authors, fines→loans, ...) neither
drop nor duplicate child rows; several reports rely on this to take a top-k
before the joins. ``folio.quality`` checks those foreign keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.scalar import full_name
from folio.sources.library import Library


def member_names(lib: Library, *extra: str) -> DataFrame:
    """member_id, member_name (+ extra member columns)."""
    return lib.members.select("member_id", full_name().alias("member_name"), *extra)


def loans_per_copy(lib: Library) -> DataFrame:
    """copy_id, n_loans (all loans), n_active (status = 'active')."""
    return lib.loans.groupBy("copy_id").agg(
        F.count("loan_id").alias("n_loans"),
        F.count(F.when(F.col("status") == "active", 1)).alias("n_active"))


def active_loans_per_copy(lib: Library) -> DataFrame:
    """copy_id, k = number of active loans of the copy (copies with k > 0)."""
    return (lib.loans.filter(F.col("status") == "active")
            .groupBy("copy_id").agg(F.count(F.lit(1)).alias("k")))


def loans_per_book(lib: Library) -> DataFrame:
    """book_id, n_loans for books with at least one loan (loans ⋈ copies)."""
    return (loans_per_copy(lib).join(lib.book_copies.select("copy_id", "book_id"), "copy_id")
            .groupBy("book_id").agg(F.sum("n_loans").alias("n_loans")))


def loan_counts_per_book_with_copies(lib: Library) -> DataFrame:
    """book_id, n_loans for books with at least one copy (copies ⟕ loans);
    0 for books whose copies were never lent."""
    per_copy = loans_per_copy(lib)
    return (lib.book_copies.select("copy_id", "book_id")
            .join(per_copy, "copy_id", "left")
            .groupBy("book_id").agg(F.coalesce(F.sum("n_loans"), F.lit(0)).cast("long").alias("n_loans")))


def unpaid_fines_per_loan(lib: Library) -> DataFrame:
    """loan_id, unpaid_sum (DECIMAL(20,2)), unpaid_count for loans with unpaid fines."""
    return (lib.fines.filter(F.col("paid") == F.lit(False))
            .groupBy("loan_id").agg(F.sum("fine_amount").cast("decimal(20,2)").alias("unpaid_sum"),
                                    F.count("fine_id").alias("unpaid_count")))


def book_author(lib: Library) -> DataFrame:
    """book_id, title, genre, publication_year, author_id, author_name (inner)."""
    return (lib.books.select("book_id", "title", "genre", "publication_year", "author_id")
            .join(lib.authors.select("author_id", "author_name"), "author_id"))


def copy_dim(lib: Library, *book_cols: str, author: bool = False, copy_cols: tuple[str, ...] = ()) -> DataFrame:
    """The copy-level dimension: copy_id, book_id, the given book columns
    (and author_name), built from the dimension tables only.

    A fact table (loans) joins it once on copy_id, instead of joining copies,
    then books, then authors in turn — each of those joins would shuffle the
    large joined rows again."""
    books = lib.books.select("book_id", *book_cols, *(["author_id"] if author else []))
    if author:
        books = books.join(lib.authors.select("author_id", "author_name"), "author_id").drop("author_id")
    return lib.book_copies.select("copy_id", "book_id", *copy_cols).join(books, "book_id")
