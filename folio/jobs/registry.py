"""Catalogue of the batch jobs: driver key → (spark, sf_dir) callable.

Every job runs on request/change tables derived from the whole driver and
library tables (``folio.sources.requests``); one key per output table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.scalar import fine_days
from folio.jobs.changes import audit_member_updates, guard_book_delete
from folio.jobs.checkout import (checkout_batch, checkout_with_limit_batch, default_due_date,
                                 reject_inactive_loans, safe_checkout_batch)
from folio.jobs.keys import assign_keys
from folio.jobs.payments import pay_fines_batch
from folio.jobs.returns import batch_return, commit_returns, overdue_fines_from_changes, return_batch
from folio.operators.bags import bag_changes
from folio.oracle.jobs_sql import JOB_SQL
from folio.oracle.temporal_sql import SESSIONS_SQL
from folio.plans.temporal import x4_click_sessions
from folio.quality.registry import QUALITY_QUERIES, QUALITY_SQL
from folio.sources import requests as rq
from folio.sources.catalog import fingerprint, library_for, stored_folder
from folio.sources.library import Library

Query = Callable[[SparkSession, str], DataFrame]


def _lib(spark: SparkSession, sf_dir: str) -> Library:
    return library_for(spark, sf_dir)


def w1_fine_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = _lib(spark, sf_dir).loans.filter(F.col("return_date").isNotNull())
    return loans.select("loan_id", "due_date", "return_date",
                        fine_days("due_date", "return_date").alias("fine_days"))


def _w2(spark, sf_dir):
    return checkout_batch(rq.checkout_requests(spark, sf_dir), _lib(spark, sf_dir))


def _w3(spark, sf_dir):
    return return_batch(rq.return_requests(spark, sf_dir), _lib(spark, sf_dir))


def _w5(spark, sf_dir):
    return safe_checkout_batch(rq.checkout_requests(spark, sf_dir), _lib(spark, sf_dir))


def _w6(spark, sf_dir):
    lib = _lib(spark, sf_dir)
    return pay_fines_batch(rq.pay_requests(lib), lib)


def _w7(spark, sf_dir):
    return checkout_with_limit_batch(rq.checkout_requests(spark, sf_dir), _lib(spark, sf_dir))


def _w8(spark, sf_dir):
    lib = _lib(spark, sf_dir)
    return batch_return(rq.batch_return_requests(lib), lib)


def _w8_next(spark, sf_dir):
    """W8 committed: the next versions of the loans and the fines."""
    outputs = _part(_w8, "updated_loans")(spark, sf_dir), _part(_w8, "new_fines")(spark, sf_dir)
    return commit_returns(spark, _lib(spark, sf_dir), stored_folder(spark, sf_dir), *outputs)


def x8_loans_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows in which the version of the loans after W8's commit differs from the one before."""
    return bag_changes(_lib(spark, sf_dir).loans, _part(_w8_next, "loans")(spark, sf_dir))


def w9_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = rq.member_changes(_lib(spark, sf_dir))
    return audit_member_updates(old, new)


def _new_loans(spark, sf_dir):
    return rq.checkout_requests(spark, sf_dir).select("request_id", "member_id", "copy_id", "loan_date", "due_date")


def _w10(spark, sf_dir):
    return reject_inactive_loans(_new_loans(spark, sf_dir), _lib(spark, sf_dir))


def w11_new_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return default_due_date(_w10(spark, sf_dir)["accepted"])


def w12_new_loan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W10 → W11 → W12: accepted loan rows with defaulted due dates and keys."""
    lib = _lib(spark, sf_dir)
    accepted = default_due_date(reject_inactive_loans(_new_loans(spark, sf_dir), lib)["accepted"])
    return assign_keys(accepted, lib.loans, "loan_id", "request_id")


def w13_new_fines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lib = _lib(spark, sf_dir)
    old, new = rq.loan_changes(lib)
    return overdue_fines_from_changes(old, new, lib)


def _w14(spark, sf_dir):
    lib = _lib(spark, sf_dir)
    return guard_book_delete(lib.books.select("book_id"), lib)


_outputs: dict = {}


def _part(job: Callable[[SparkSession, str], dict], name: str) -> Query:
    """One output of a job. A job decides its requests once per session and
    input (its decided tables are written; see ``jobs.sink.settle``), and its
    keys derive their outputs from them. Changed inputs have another
    fingerprint and are decided anew."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (job.__name__, fingerprint(sf_dir, spark))
        hit = _outputs.get(key)
        if hit is None or hit[0] is not spark:
            hit = (spark, job(spark, sf_dir))
            _outputs[key] = hit
        return hit[1][name]
    run.__name__ = f"{job.__name__}_{name}"
    return run


JOB_QUERIES: dict[str, Query] = {
    "w1_fine_days": w1_fine_days,
    "w2_results": _part(_w2, "results"),
    "w2_new_loans": _part(_w2, "new_loans"),
    "w3_results": _part(_w3, "results"),
    "w3_updated_loans": _part(_w3, "updated_loans"),
    "w3_new_fines": _part(_w3, "new_fines"),
    "w5_results": _part(_w5, "results"),
    "w5_new_loans": _part(_w5, "new_loans"),
    "w5_audit": _part(_w5, "audit"),
    "w6_updated_fines": _part(_w6, "updated_fines"),
    "w6_audit": _part(_w6, "audit"),
    "w6_reactivated": _part(_w6, "reactivated"),
    "w7_results": _part(_w7, "results"),
    "w7_new_loans": _part(_w7, "new_loans"),
    "w8_updated_loans": _part(_w8, "updated_loans"),
    "w8_new_fines": _part(_w8, "new_fines"),
    "w8_audit": _part(_w8, "audit"),
    "w8_loans_next": _part(_w8_next, "loans"),
    "w8_fines_next": _part(_w8_next, "fines"),
    "w9_audit": w9_audit,
    "w10_accepted": _part(_w10, "accepted"),
    "w10_rejected": _part(_w10, "rejected"),
    "w11_new_loans": w11_new_loans,
    "w12_new_loan_keys": w12_new_loan_keys,
    "w13_new_fines": w13_new_fines,
    "w14_deletable": _part(_w14, "deletable"),
    "w14_blocked": _part(_w14, "blocked"),
}
JOB_QUERIES.update(QUALITY_QUERIES)
JOB_QUERIES["x4_click_sessions"] = x4_click_sessions
JOB_QUERIES["x8_loans_changed"] = x8_loans_changed
JOB_SQL = {**JOB_SQL, **QUALITY_SQL, **SESSIONS_SQL}
