"""The queries of the index/EXPLAIN exercise (group 11).

The reference tunes them with secondary indexes; on Spark the same work is
done by column pruning and Parquet predicate pushdown (see ``explain()``)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.config import AS_OF
from folio.plans.common import book_author, loans_per_book, loans_per_copy
from folio.sources.library import Library


def q11_1_loans_per_book(lib: Library) -> DataFrame:
    return (loans_per_book(lib).join(book_author(lib), "book_id")
            .orderBy(F.col("n_loans").desc(), "book_id")
            .select("title", "author_name", F.col("n_loans").cast("long").alias("loan_count")))


def q11_3_active_per_member(lib: Library) -> DataFrame:
    per_member = (lib.loans.filter(F.col("status") == "active")
                  .groupBy("member_id").agg(F.count(F.lit(1)).alias("loan_count")))
    return (per_member.join(lib.members.select("member_id", "first_name", "last_name"), "member_id")
            .select("first_name", "last_name", "loan_count"))


def q11_4_loans_and_active(lib: Library) -> DataFrame:
    per_book = (lib.book_copies.select("copy_id", "book_id").join(loans_per_copy(lib), "copy_id", "left")
                .groupBy("book_id").agg(F.sum("n_loans").alias("n"), F.sum("n_active").alias("a")))
    return (lib.books.select("book_id", "title").join(per_book, "book_id", "left")
            .select("title", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("total_loans"),
                    F.coalesce(F.col("a"), F.lit(0)).cast("long").alias("active_loans")))


def q11_5_overdue_rows(lib: Library, as_of: _dt.date = AS_OF) -> DataFrame:
    return lib.loans.filter((F.col("status") == "active") & (F.col("due_date") < F.lit(as_of))).select("*")
