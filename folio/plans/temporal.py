"""Reports over time: as-of joins, overlapping periods, peaks and sessions.

They answer questions the catalogue's windows cannot: which loan came last before a payment, which copies were lent
twice at once, how many loans of a genre were open at most, and how members' clicks fall into visits. Each is one
shuffle of the fact rows on (key, piece of time), whatever a key's size (see ``operators.carry`` and ``operators.intervals``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.config import AS_OF
from folio.operators.carry import asof_join, sessions
from folio.operators.intervals import overlapping_pairs, peak_open
from folio.plans.common import copy_dim
from folio.sources.driver import read_driver
from folio.sources.library import Library

#: Days of a bin of loan periods, and of a block of the sweep over them.
BIN_DAYS = 128
SESSION_GAP = "INTERVAL '30' MINUTE"

_DAY = "datediff({}, DATE'1970-01-01')"


def x1_payment_after_loan(lib: Library) -> DataFrame:
    """Each paid fine with its member's latest loan before the payment day (of several on a day, the highest id)."""
    owner = lib.loans.select("loan_id", "member_id")
    paid = lib.fines.filter(F.col("paid")).select("fine_id", "loan_id", "payment_date").join(owner, "loan_id")
    loans = lib.loans.select("member_id", F.col("loan_id").alias("id"), "loan_date", "status")
    found = asof_join(paid, loans, "member_id", "payment_date", "loan_date", "fine_id", "id", ["loan_date", "status"], _DAY.format("_time"))
    return found.selectExpr("fine_id", "loan_id", "member_id", "payment_date", "latest_id AS latest_loan_id", "latest_loan_date", "latest_status",
                            "CAST(datediff(payment_date, latest_loan_date) AS INT) AS days_after")


def loan_periods(lib: Library, as_of: _dt.date = AS_OF) -> DataFrame:
    """``loan_id, copy_id, first_day, end_day`` as days since 1970: a loan lasts from its loan date until its return (an active one
    until ``as_of``, a lost one until it was due), the last day not included; at least the day it began."""
    end = F.when(F.col("status") == "active", F.greatest(F.lit(as_of), "loan_date")).otherwise(F.coalesce("return_date", "due_date"))
    day = lambda c: F.datediff(c, F.lit(_dt.date(1970, 1, 1)))
    return lib.loans.select("loan_id", "copy_id", day(F.col("loan_date")).alias("first_day"),
                            F.greatest(day(end), day(F.col("loan_date")) + 1).alias("end_day"))


def x2_copies_lent_twice(lib: Library) -> DataFrame:
    """Pairs of loans of one copy whose periods overlap, with the first common day and how many there are."""
    pairs = overlapping_pairs(loan_periods(lib), "copy_id", "loan_id", "first_day", "end_day", BIN_DAYS)
    return pairs.selectExpr("copy_id", "first_id AS first_loan_id", "second_id AS second_loan_id", "date_add(DATE'1970-01-01', CAST(overlap_start AS INT)) AS overlap_from",
                            "CAST(overlap_end - overlap_start AS INT) AS overlap_days")


def x3_peak_open_loans(lib: Library) -> DataFrame:
    """Per genre the most loans that were open on one day, and the first such day."""
    periods = loan_periods(lib).join(copy_dim(lib, "genre"), "copy_id").select("genre", "first_day", "end_day")
    return (peak_open(periods, ["genre"], "first_day", "end_day", BIN_DAYS)
            .selectExpr("genre", "peak AS peak_open", "date_add(DATE'1970-01-01', CAST(reached AS INT)) AS reached"))


def x4_click_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits of the site: runs of a user's clicks without a pause of more than half an hour."""
    clicks = read_driver(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    found = sessions(clicks, "user_id", "ts", "event_id", SESSION_GAP, _DAY.format("cast(ts AS DATE)"))
    return found.selectExpr("user_id", "session_start", "session_end", "n_rows AS clicks")
