"""Request and change tables for the batch jobs, derived from the data.

The routines of the reference take one request per call. The batch jobs take
a table of requests; these derivations make such tables out of whole driver
and library tables (no id subsets), so the work grows with the data:

* checkout requests — one per order: the order's customer asks for a book
  (and a copy of it); some requests name an unknown member or copy, some
  leave the due date to the default rule;
* return requests — one per order key, read as a loan id (most are not active
  loans, as at a real returns desk);
* fine payments — every fine that is not for a lost item;
* batch returns — every member whose membership is not active; suspended
  members are asked for twice;
* member changes — the suspension run: active members with an unpaid fine
  become suspended;
* loan changes — every active loan returned on the as-of date.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.config import AS_OF
from folio.sources.driver import read_driver
from folio.sources.library import Library

# Fixed values of the request derivation (shared with the oracle SQL).
UNKNOWN_ID = -1
CHECKOUT_DUE_DATE = _dt.date(2001, 7, 10)


def checkout_requests(spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF) -> DataFrame:
    """request_id, member_id, book_id, copy_id, loan_date, due_date."""
    orders = read_driver(spark, sf_dir, "orders")
    n_parts = read_driver(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()
    ok = F.col("o_orderkey")
    book = (ok * 17) % n_parts
    return orders.select(
        ok.alias("request_id"),
        F.when(ok % 35 == 0, F.lit(UNKNOWN_ID).cast("long")).otherwise(F.col("o_custkey")).alias("member_id"),
        book.alias("book_id"),
        F.when(ok % 45 == 0, F.lit(UNKNOWN_ID).cast("long")).otherwise(book * 10 + 1).alias("copy_id"),
        F.lit(as_of).alias("loan_date"),
        F.when(ok % 2 == 0, F.lit(None).cast("date")).otherwise(F.lit(CHECKOUT_DUE_DATE)).alias("due_date"),
    )


def return_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """request_id, loan_id."""
    return read_driver(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"), F.col("o_orderkey").alias("loan_id"))


def pay_requests(lib: Library) -> DataFrame:
    """request_id, fine_id: every fine that is not for a lost item."""
    return lib.fines.filter(F.col("fine_reason") != "lost").select(
        F.col("fine_id").alias("request_id"), "fine_id")


def batch_return_requests(lib: Library) -> DataFrame:
    """request_id, member_id: every member whose status is not 'active', newest
    first, and every suspended one a second time."""
    who = lib.members.filter(F.col("status") != "active")
    again = who.filter(F.col("status") == "suspended")
    last = lib.members.select(F.max("member_id")).scalar()
    return (who.select((last - F.col("member_id")).alias("request_id"), "member_id")
            .unionByName(again.select((last + 1 + F.col("member_id")).alias("request_id"), "member_id")))


def member_changes(lib: Library) -> tuple[DataFrame, DataFrame]:
    """(old, new) images of the suspension run."""
    unpaid_members = (lib.fines.filter(F.col("paid") == F.lit(False)).select("loan_id")
                      .join(lib.loans.select("loan_id", "member_id"), "loan_id").select("member_id"))
    old = (lib.members.filter(F.col("status") == "active")
           .join(unpaid_members, "member_id", "left_semi"))
    new = old.withColumn("status", F.lit("suspended"))
    return old, new


def loan_changes(lib: Library, as_of: _dt.date = AS_OF) -> tuple[DataFrame, DataFrame]:
    """(old, new) images: every active loan returned on ``as_of``."""
    old = lib.loans.filter(F.col("status") == "active")
    new = old.withColumn("return_date", F.lit(as_of)).withColumn("status", F.lit("returned"))
    return old, new
