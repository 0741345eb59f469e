"""Checkout routines as batch jobs: W2 CheckoutBook, W5 SafeCheckout,
W7 CheckoutWithLimit, and the two BEFORE INSERT triggers on loans (W10, W11).

Requests carry a ``request_id`` that stands for call order: each job returns
what calling the routine once per request, in that order, would leave
behind. Competition between requests (the same copy, the same book, a
member's loan cap) is settled with aggregates or block-wise numbering, never
with a per-request loop, and a rejected request consumes nothing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.config import AS_OF, LOAN_DAYS, MAX_ACTIVE_LOANS
from folio.jobs import messages as msg
from folio.jobs.keys import assign_keys
from folio.jobs.sink import settle
from folio.operators.ranking import sequence_within
from folio.sources.library import Library

AUDIT_COLUMNS = ("table_name", "action", "record_id", "changed_by", "description")


def _active_copies(lib: Library) -> DataFrame:
    return lib.loans.filter(F.col("status") == "active").select("copy_id").distinct()


def _new_loan_rows(winners: DataFrame, lib: Library, as_of: _dt.date) -> DataFrame:
    rows = winners.select("request_id", "member_id", "copy_id",
                          F.lit(as_of).alias("loan_date"),
                          F.date_add(F.lit(as_of), LOAN_DAYS).alias("due_date"),
                          F.lit(None).cast("date").alias("return_date"),
                          F.lit("active").alias("status"))
    keyed = assign_keys(rows, lib.loans, "loan_id", "request_id")
    return keyed.select("request_id", "loan_id", "member_id", "copy_id", "loan_date", "due_date",
                        "return_date", "status")


def checkout_batch(requests: DataFrame, lib: Library, as_of: _dt.date = AS_OF) -> dict[str, DataFrame]:
    """W2: requests(request_id, member_id, copy_id) →
    results(request_id, due_date, message), new_loans.

    Checks in the routine's order: member known, member active, copy known,
    copy free (no active loan). Among the requests that pass, a copy goes to
    the lowest request_id; the others find it taken.
    """
    req = requests.select("request_id", "member_id", "copy_id")
    # One row a requested copy, joined once: free or on loan; a copy wanted by many is one row here.
    asked = req.select("copy_id").distinct()
    copies = (lib.book_copies.select("copy_id").join(asked, "copy_id", "left_semi")
              .join(_active_copies(lib).withColumn("_on_loan", F.lit(True)), "copy_id", "left")
              .select("copy_id", F.coalesce("_on_loan", F.lit(False)).alias("_on_loan")))
    staged = (req.join(lib.members.select("member_id", "status"), "member_id", "left")
              .join(copies, "copy_id", "left")
              .withColumn("_early",
                          F.when(F.col("status").isNull(), msg.MEMBER_NOT_FOUND)
                          .when(F.col("status") != "active", msg.MEMBER_NOT_ACTIVE)
                          .when(F.col("_on_loan").isNull(), msg.COPY_NOT_FOUND)
                          .when(F.col("_on_loan"), msg.COPY_NOT_AVAILABLE)))
    staged = settle(staged, "w2-staged")
    # A copy's winner is one request, so the join back is on the request and spreads evenly.
    winners = (staged.filter(F.col("_early").isNull()).groupBy("copy_id").agg(F.min("request_id").alias("request_id"))
               .select("request_id", F.lit(True).alias("_wins")))
    decided = staged.join(winners, "request_id", "left").withColumn("_won", F.coalesce("_wins", F.lit(False)))
    due = F.date_add(F.lit(as_of), LOAN_DAYS)
    results = decided.select(
        "request_id",
        F.when(F.col("_won"), due).alias("due_date"),
        F.when(F.col("_early").isNotNull(), F.col("_early"))
         .when(F.col("_won"), F.concat(F.lit(msg.CHECKED_OUT_PREFIX), due.cast("string")))
         .otherwise(msg.COPY_NOT_AVAILABLE).alias("message"))
    new_loans = _new_loan_rows(decided.filter(F.col("_won")), lib, as_of)
    return {"results": results, "new_loans": new_loans}


def safe_checkout_batch(requests: DataFrame, lib: Library, as_of: _dt.date = AS_OF) -> dict[str, DataFrame]:
    """W5: requests(request_id, member_id, book_id) → results(request_id,
    copy_id, message), new_loans, audit.

    The i-th valid request for a book (by request_id) gets the i-th free copy
    of that book (by copy_id): both sides are numbered per book, block-wise,
    and joined on (book_id, number). Requests of unknown or non-active
    members are rejected first (the loan trigger / foreign key would refuse
    their insert).
    """
    req = requests.select("request_id", "member_id", "book_id")
    checked = settle(req.join(lib.members.select("member_id", "status"), "member_id", "left"), "w5-checked")
    valid = checked.filter(F.col("status") == "active").select("request_id", "member_id", "book_id")
    # Only the copies of requested books are looked at and numbered.
    asked = (lib.book_copies.select("copy_id", "book_id")
             .join(valid.select("book_id").distinct(), "book_id", "left_semi"))
    free = asked.join(_active_copies(lib), "copy_id", "left_anti")
    slots_free = sequence_within(free, ["book_id"], ["copy_id"], out_col="_slot")
    slots_req = sequence_within(valid, ["book_id"], ["request_id"], out_col="_slot")
    served = settle(slots_req.join(slots_free, ["book_id", "_slot"]).select("request_id", "member_id", "book_id", "copy_id"),
                    "w5-served")
    results = (checked.join(served.select("request_id", "copy_id"), "request_id", "left")
               .select("request_id", "copy_id",
                       F.when(F.col("status").isNull(), msg.UNKNOWN_MEMBER)
                        .when(F.col("status") != "active", msg.LOAN_REJECTED_INACTIVE)
                        .when(F.col("copy_id").isNull(), msg.NO_COPY_AVAILABLE)
                        .otherwise(msg.CHECKOUT_SUCCESSFUL).alias("message")))
    new_loans = _new_loan_rows(served, lib, as_of)
    audit = new_loans.select(F.lit("loans").alias("table_name"), F.lit("INSERT").alias("action"),
                             F.col("loan_id").alias("record_id"), F.lit("SYSTEM").alias("changed_by"),
                             F.lit(msg.AUDIT_CHECKED_OUT).alias("description"))
    return {"results": results, "new_loans": new_loans, "audit": audit}


def checkout_with_limit_batch(requests: DataFrame, lib: Library, as_of: _dt.date = AS_OF,
                              cap: int = MAX_ACTIVE_LOANS) -> dict[str, DataFrame]:
    """W7: insert, then roll back if the member has more than ``cap`` active loans.

    Calls in request order commit while the member's active count stays within
    the cap, so the first (cap - existing active loans) eligible requests of a
    member commit. Eligible = active member (W10) and known copy (foreign key);
    as in the reference, whether the copy is free is not tested.
    """
    req = requests.select("request_id", "member_id", "copy_id")
    checked = (req.join(lib.members.select("member_id", "status"), "member_id", "left")
               .join(lib.book_copies.select("copy_id", F.lit(True).alias("_copy_known")), "copy_id", "left"))
    checked = settle(checked, "w7-checked")
    eligible = checked.filter((F.col("status") == "active") & F.col("_copy_known").isNotNull())
    # Only the loans of members who ask are counted.
    active = (lib.loans.filter(F.col("status") == "active").select("member_id")
              .join(eligible.select("member_id").distinct(), "member_id", "left_semi")
              .groupBy("member_id").agg(F.count(F.lit(1)).alias("_active")))
    numbered = sequence_within(eligible.select("request_id", "member_id", "copy_id"), ["member_id"],
                               ["request_id"], out_col="_n")
    decided = (numbered.join(active, "member_id", "left")
               .withColumn("_commit", F.coalesce(F.col("_active"), F.lit(0)) + F.col("_n") <= cap))
    decided = settle(decided, "w7-decided")
    results = (checked.join(decided.select("request_id", "_commit"), "request_id", "left")
               .select("request_id",
                       F.when(F.col("status").isNull(), msg.UNKNOWN_MEMBER)
                        .when(F.col("status") != "active", msg.LOAN_REJECTED_INACTIVE)
                        .when(F.col("_copy_known").isNull(), msg.UNKNOWN_COPY)
                        .when(F.col("_commit"), msg.COMMITTED)
                        .otherwise(msg.ROLLED_BACK).alias("message")))
    new_loans = _new_loan_rows(decided.filter(F.col("_commit")), lib, as_of)
    return {"results": results, "new_loans": new_loans}


def reject_inactive_loans(new_loans: DataFrame, lib: Library) -> dict[str, DataFrame]:
    """W10 (BEFORE INSERT on loans): a loan of a member whose status is not
    'active' is rejected. An unknown member passes this check (its NULL
    status compares as unknown) and is left to the foreign-key check."""
    cols = new_loans.columns
    j = new_loans.join(lib.members.select("member_id", F.col("status").alias("_member_status")), "member_id", "left")
    bad = F.coalesce(F.col("_member_status") != "active", F.lit(False))
    accepted = j.filter(~bad).select(*cols)
    rejected = j.filter(bad).select(*cols, F.lit(msg.LOAN_REJECTED_INACTIVE).alias("reason"))
    return {"accepted": accepted, "rejected": rejected}


def default_due_date(new_loans: DataFrame, days: int = LOAN_DAYS) -> DataFrame:
    """W11 (BEFORE INSERT on loans): due_date = loan_date + 14 when NULL."""
    return new_loans.withColumn("due_date", F.coalesce(F.col("due_date"), F.date_add(F.col("loan_date"), days)))
