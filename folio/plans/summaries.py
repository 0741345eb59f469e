"""Summaries the catalogue's reports cannot give: figures from mergeable states, all grouping sets at once, and who is
linked with whom through the books read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.cube import distinct_cube
from folio.operators.reach import reach
from folio.operators.sketches import DISTINCT_BOUND, RANK_BOUND, distinct_over, distinct_states, quantile_over, value_states
from folio.plans.common import copy_dim
from folio.sources.library import Library

MEDIAN = 0.5


def payments(lib: Library) -> DataFrame:
    """``payment_date, cents`` of the paid fines."""
    return lib.fines.where("paid AND payment_date IS NOT NULL").select("payment_date", (F.col("fine_amount") * 100).cast("long").alias("cents"))


def quarter_estimates(lib: Library) -> DataFrame:
    """Per quarter the borrowers and the median of the paid fines (in cents), each exact, by monthly sketches, and whether
    the sketch kept its bound: ``DISTINCT_BOUND`` of the count, ``RANK_BOUND`` of the rank."""
    borrowers = (lib.loans.groupBy(F.trunc("loan_date", "quarter").alias("quarter")).agg(F.count_distinct("member_id").alias("borrowers"))
                 .join(distinct_over(distinct_states(lib.loans, "loan_date", "member_id"), "quarter").selectExpr("period AS quarter", "estimate AS borrowers_estimate"), "quarter")
                 .withColumn("borrowers_close", F.abs(F.col("borrowers_estimate") - F.col("borrowers")) <= F.col("borrowers") * DISTINCT_BOUND))
    paid = payments(lib)
    middle = quantile_over(value_states(paid, "payment_date", "cents"), "quarter", MEDIAN).selectExpr("period AS quarter", "estimate AS median_estimate")
    # Amounts are few (days late times a rate): counted first, the exact figures come from the counts.
    amounts = paid.groupBy(F.trunc("payment_date", "quarter").alias("quarter"), "cents").agg(F.count("*").alias("n"))
    fines = (amounts.join(middle, "quarter").groupBy("quarter", "median_estimate")
             .agg(F.sum("n").alias("fines"), F.percentile("cents", MEDIAN, F.col("n")).alias("median_cents"),
                  F.sum(F.expr("if(cents < median_estimate, n, 0)")).alias("below"), F.sum(F.expr("if(cents <= median_estimate, n, 0)")).alias("upto"))
             .withColumn("median_close", F.expr(f"below <= ({MEDIAN} + {RANK_BOUND}) * fines AND upto >= ({MEDIAN} - {RANK_BOUND}) * fines"))
             .drop("below", "upto"))
    return borrowers.join(fines, "quarter", "full_outer")


def x5_quarter_sketches(lib: Library) -> DataFrame:
    """``quarter_estimates``: the exact figures, and whether the sketches' estimates lie within their bounds."""
    return quarter_estimates(lib).select("quarter", "borrowers", "borrowers_close", "fines", "median_cents", "median_close")


def x6_reading_circle(lib: Library) -> DataFrame:
    """The members linked with a borrower of the library's first loan day through books that both lent, over any number of others: the
    fewest such steps (0: that borrower)."""
    lent = lib.loans.select("member_id", "copy_id", "loan_date").join(lib.book_copies.select("copy_id", "book_id"), "copy_id")
    first = lib.loans.where(F.col("loan_date") == lib.loans.agg(F.min("loan_date")).scalar()).select("member_id")
    return reach(lent, "member_id", "book_id", first)


def x7_lending_cube(lib: Library) -> DataFrame:
    """Loans and distinct members for every grouping set of genre, month and membership type; ``level`` is GROUPING_ID."""
    months = (lib.loans.select("member_id", "copy_id", F.trunc("loan_date", "month").alias("month")).join(copy_dim(lib, "genre"), "copy_id")
              .groupBy("genre", "month", "member_id").agg(F.count("*").alias("n")))
    facts = months.join(lib.members.select("member_id", "membership_type"), "member_id")
    cube = distinct_cube(facts, ["genre", "month", "membership_type"], "member_id", "n", determined=["membership_type"])
    return cube.withColumnsRenamed({"total": "loans", "keys": "members"})
