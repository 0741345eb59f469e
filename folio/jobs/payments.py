"""W6 PayFine as a batch job."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.config import AS_OF
from folio.jobs import messages as msg
from folio.sources.library import Library


def pay_fines_batch(requests: DataFrame, lib: Library, as_of: _dt.date = AS_OF) -> dict[str, DataFrame]:
    """requests(request_id, fine_id) → updated_fines, audit, reactivated.

    * every known fine of the batch is marked paid on ``as_of``;
    * one audit row per request, 'Fine paid: $<amount>' (NULL text for an
      unknown fine id, as CONCAT with NULL gives in the reference);
    * a suspended member becomes active when at least one of their fines is in
      the batch and no unpaid fine of theirs is left outside it — the state
      that paying the fines one call at a time, in any order, ends in.
    """
    req = requests.select("request_id", "fine_id")
    batch = req.select("fine_id").distinct()
    known = lib.fines.join(batch, "fine_id", "left_semi")
    updated_fines = known.select("fine_id", "loan_id", "fine_amount", "fine_reason",
                                 F.lit(True).alias("paid"), F.lit(as_of).alias("payment_date"))
    audit = (req.join(lib.fines.select("fine_id", "fine_amount"), "fine_id", "left")
             .select(F.lit("fines").alias("table_name"), F.lit("UPDATE").alias("action"),
                     F.col("fine_id").alias("record_id"), F.lit("SYSTEM").alias("changed_by"),
                     F.concat(F.lit(msg.FINE_PAID_PREFIX), F.col("fine_amount").cast("string")).alias("description")))
    loans = lib.loans.select("loan_id", "member_id")
    touched = known.select("loan_id").join(loans, "loan_id").select("member_id").distinct()
    still_unpaid = (lib.fines.filter(F.col("paid") == F.lit(False)).join(batch, "fine_id", "left_anti")
                    .select("loan_id").join(loans, "loan_id").select("member_id").distinct())
    reactivated = (lib.members.filter(F.col("status") == "suspended")
                   .join(touched, "member_id", "left_semi")
                   .join(still_unpaid, "member_id", "left_anti")
                   .withColumn("status", F.lit("active")))
    return {"updated_fines": updated_fines, "audit": audit, "reactivated": reactivated}
