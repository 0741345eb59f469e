"""W4 ``GenerateMemberReport`` for many members at once.

The routine returns four result sets for one member id. Here the member ids
are a DataFrame and each result set is a DataFrame keyed by member_id, so one
job serves any number of members.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.config import AS_OF_EVENTS
from folio.plans.common import copy_dim
from folio.sources.library import Library


def member_report(lib: Library, member_ids: DataFrame,
                  as_of_events: _dt.date = AS_OF_EVENTS) -> dict[str, DataFrame]:
    ids = member_ids.select("member_id").distinct()
    profile = lib.members.join(ids, "member_id", "left_semi").select(
        "member_id", "first_name", "last_name", "email", "membership_type", "status")
    current = (lib.loans.filter(F.col("status") == "active").join(ids, "member_id", "left_semi")
               .select("member_id", "copy_id", "loan_date", "due_date")
               .join(copy_dim(lib, "title"), "copy_id")
               .select("member_id", "title", "loan_date", "due_date"))
    their_loans = lib.loans.select("loan_id", "member_id").join(ids, "member_id", "left_semi")
    unpaid = (lib.fines.filter(F.col("paid") == F.lit(False)).select("loan_id", "fine_amount")
              .join(their_loans, "loan_id")
              .groupBy("member_id", "loan_id").agg(F.sum("fine_amount").alias("s"))
              .groupBy("member_id").agg(F.sum("s").alias("s")))
    unpaid_total = ids.join(unpaid, "member_id", "left").select(
        "member_id", F.coalesce(F.col("s"), F.lit(0)).cast("decimal(20,2)").alias("total_unpaid"))
    events = lib.lib_events.filter(F.col("event_date") >= F.lit(as_of_events)).select(
        "event_id", "event_name", "event_date")
    upcoming = (lib.event_registrations.select("member_id", "event_id").join(ids, "member_id", "left_semi")
                .join(events, "event_id").select("member_id", "event_name", "event_date"))
    return {"profile": profile, "current_loans": current, "unpaid_total": unpaid_total,
            "upcoming_events": upcoming}
