"""Return routines as batch jobs: W3 ReturnBook, W8 BatchReturn, and the
AFTER UPDATE trigger on loans that fines late returns (W13).

Each job only computes rows; nothing fires implicitly. Callers that model
the reference with triggers loaded chain the jobs themselves (W3 already
emits the late-return fine, so W13 is never chained after it).
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.config import AS_OF
from folio.functions.scalar import fine_days, fine_for_days
from folio.jobs import messages as msg
from folio.jobs.keys import assign_keys
from folio.jobs.sink import settle
from folio.session import scratch_dir
from folio.sources.library import LIBRARY_SCHEMAS, Library
from folio.sources.versions import VersionedTable

LOAN_COLUMNS = ("loan_id", "member_id", "copy_id", "loan_date", "due_date", "return_date", "status")
FINE_COLUMNS = ("fine_id", "loan_id", "fine_amount", "fine_reason", "paid", "payment_date")


def _overdue_fine_rows(rows: DataFrame, amount_col: str, order_col: str, lib: Library, within: str | None = None) -> DataFrame:
    fines = rows.select(*dict.fromkeys([order_col, "loan_id"]), F.col(amount_col).alias("fine_amount"),
                        F.lit("overdue").alias("fine_reason"), F.lit(False).alias("paid"),
                        F.lit(None).cast("date").alias("payment_date"))
    return assign_keys(fines, lib.fines, "fine_id", order_col, within).select(*FINE_COLUMNS)


def return_batch(requests: DataFrame, lib: Library, as_of: _dt.date = AS_OF) -> dict[str, DataFrame]:
    """W3: requests(request_id, loan_id) → results(request_id, loan_id,
    fine_amount, message), updated_loans, new_fines.

    An active loan is returned on ``as_of``; days late = W1(due_date, as_of);
    a late return is fined 0.25 per day with reason 'overdue'. When a loan is
    asked for twice, only the first request (lowest request_id) finds it active.
    """
    req = requests.select("request_id", "loan_id")
    first = req.groupBy("loan_id").agg(F.min("request_id").alias("_first"))
    j = (req.join(first, "loan_id", "left")
         .join(lib.loans.filter(F.col("status") == "active").select(*LOAN_COLUMNS), "loan_id", "left"))
    ok = F.coalesce(F.col("status").isNotNull() & (F.col("request_id") == F.col("_first")), F.lit(False))
    days_late = fine_days("due_date", F.lit(as_of))
    staged = settle(j.withColumn("_ok", ok).withColumn("_days", days_late)
                    .withColumn("_late", F.col("_ok") & (F.col("_days") > 0)), "w3-decided")
    amount = F.when(F.col("_late"), fine_for_days(F.col("_days"))).otherwise(F.lit(0).cast("decimal(10,2)"))
    results = staged.select(
        "request_id", "loan_id", amount.alias("fine_amount"),
        F.when(~F.col("_ok"), msg.LOAN_NOT_FOUND)
         .when(F.col("_late"), F.concat(F.lit(msg.RETURNED_LATE_PREFIX), F.col("_days").cast("string"),
                                        F.lit(msg.RETURNED_LATE_MIDDLE), amount.cast("string")))
         .otherwise(msg.RETURNED_ON_TIME).alias("message"))
    returned = staged.filter(F.col("_ok"))
    updated_loans = returned.select("loan_id", "member_id", "copy_id", "loan_date", "due_date",
                                    F.lit(as_of).alias("return_date"), F.lit("returned").alias("status"))
    late = returned.filter(F.col("_late")).withColumn("_amount", fine_for_days(F.col("_days")))
    new_fines = _overdue_fine_rows(late, "_amount", "request_id", lib)
    return {"results": results, "updated_loans": updated_loans, "new_fines": new_fines}


def batch_return(requests: DataFrame, lib: Library, as_of: _dt.date = AS_OF) -> dict[str, DataFrame]:
    """W8: requests(request_id, member_id) → updated_loans, new_fines, audit.

    Equals one call a request, in the order of request_id: a member's first
    request does all below, a later one finds nothing and reports 0.

    1. every active loan of the members is returned on ``as_of``;
    2. every loan of the members that is now returned, came back after its due
       date, and has no fine yet is fined (as_of - due_date) * 0.25 — this also
       covers loans returned late earlier, counted up to as_of as in the
       reference;
    3. one audit row per request; its count is the number of fines
       inserted in step 2 (the reference's ROW_COUNT() follows that insert).
    """
    first = requests.groupBy("member_id").agg(F.min("request_id").alias("request_id"))
    theirs = lib.loans.join(first, "member_id").select("request_id", *LOAN_COLUMNS)
    is_active = F.col("status") == "active"
    updated_loans = theirs.filter(is_active).select(
        "loan_id", "member_id", "copy_id", "loan_date", "due_date",
        F.lit(as_of).alias("return_date"), F.lit("returned").alias("status"))
    after = theirs.select(
        "request_id", "loan_id", "due_date",
        F.when(is_active, F.lit(as_of)).otherwise(F.col("return_date")).alias("return_date"),
        F.when(is_active, F.lit("returned")).otherwise(F.col("status")).alias("status"))
    fined = lib.fines.select("loan_id").distinct()
    late = settle(after.filter((F.col("status") == "returned") & (F.col("return_date") > F.col("due_date")))
                  .join(fined, "loan_id", "left_anti")
                  .withColumn("_amount", fine_for_days(fine_days("due_date", F.lit(as_of)))), "w8-late")
    new_fines = _overdue_fine_rows(late, "_amount", "request_id", lib, within="loan_id")
    per_request = late.groupBy("request_id").agg(F.count(F.lit(1)).alias("_n"))
    audit = (requests.select("request_id", "member_id").join(per_request, "request_id", "left")
             .select(F.lit("loans").alias("table_name"), F.lit("UPDATE").alias("action"),
                     F.col("member_id").alias("record_id"), F.lit("SYSTEM").alias("changed_by"),
                     F.concat(F.lit(msg.BATCH_RETURN_PREFIX), F.col("member_id").cast("string"), F.lit(": "),
                              F.coalesce(F.col("_n"), F.lit(0)).cast("string"),
                              F.lit(msg.BATCH_RETURN_SUFFIX)).alias("description")))
    return {"updated_loans": updated_loans, "new_fines": new_fines, "audit": audit}


def commit_returns(spark: SparkSession, lib: Library, folder: str | None, updated_loans: DataFrame, new_fines: DataFrame) -> dict[str, DataFrame]:
    """W8's outputs applied: its loans replace those of equal ids, its fines are inserted, each as one commit on the
    stored table; the tables read back after it. ``folder`` holds the stored tables (none: they are stored as version 0 first).

    The batch is named after the stored tables, so a job that runs again finds it committed.
    """
    root = f"{folder or scratch_dir(spark, f'versions-{uuid.uuid4().hex}')}/versions"
    out = {}
    for name, key, change in (("loans", "loan_id", {"updates": updated_loans}), ("fines", "fine_id", {"inserts": new_fines})):
        table = VersionedTable(spark, f"{root}/{name}", LIBRARY_SCHEMAS[name], [key])
        if folder:
            table.start_from(f"{folder}/{name}")
        else:
            table.commit("base", inserts=lib.table(name))
        out[name] = table.read(table.commit("batch-return", **change).number)
    return out


def overdue_fines_from_changes(old: DataFrame, new: DataFrame, lib: Library) -> DataFrame:
    """W13 (AFTER UPDATE on loans): a loan that went from 'active' to
    'returned' after its due date gets an 'overdue' fine of 0.25 per day."""
    o = old.select("loan_id", F.col("status").alias("_old_status"))
    j = new.select("loan_id", "due_date", "return_date", "status").join(o, "loan_id")
    days_late = F.datediff("return_date", "due_date")
    late = (j.filter((F.col("status") == "returned") & (F.col("_old_status") == "active") & (days_late > 0))
            .withColumn("_amount", fine_for_days(days_late)))
    return _overdue_fine_rows(late, "_amount", "loan_id", lib)
