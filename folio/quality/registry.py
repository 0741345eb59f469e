"""Driver keys of the data-quality jobs. Each rule job runs on the clean library
and on one where every rule is broken (``quality.dirty``). The oracle states
the rules by hand, predicate by predicate, apart from the lists that the jobs use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.jobs.checkout import default_due_date, reject_inactive_loans
from folio.oracle.jobs_sql import REQUEST_CTES, W10
from folio.oracle.prefix import with_library
from folio.oracle.rules_sql import DEFAULTS_SQL, DELETES_SQL, FOREIGN_KEY_SQL, ROW_RULE_SQL, UNIQUE_SQL
from folio.quality.dirty import AUDIT, BREAKS, broken_columns, dirty_library
from folio.quality.rules import (DEFAULTS, apply_defaults, delete_books_plan, delete_plan, foreign_keys, primary_key,
                                 row_rules, unique_keys)
from folio.sources import requests as rq
from folio.sources.catalog import fingerprint, library_for
from folio.sources.library import Library


def _lib(spark: SparkSession, sf_dir: str) -> Library:
    return library_for(spark, sf_dir)


def v_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_rules(_lib(spark, sf_dir))


def v2_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_keys(_lib(spark, sf_dir))


def v3_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return foreign_keys(_lib(spark, sf_dir))


def v6_loans_with_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New loan rows (checkout requests that pass W10, due date by W11) with
    the declared column defaults filled in."""
    lib = _lib(spark, sf_dir)
    new = rq.checkout_requests(spark, sf_dir).select("request_id", "member_id", "copy_id", "loan_date", "due_date")
    return apply_defaults(default_due_date(reject_inactive_loans(new, lib)["accepted"]), "loans")


def _dirty(rules):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rules(dirty_library(spark, _lib(spark, sf_dir)))
    run.__name__ = f"{rules.__name__}_dirty"
    return run


def _defaults(table: str):
    """Every row of a table as a new row that leaves out the columns with a default where its key is
    even, filled in again."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lib = _lib(spark, sf_dir)
        rows = (lib.members.selectExpr(*[f"{x} AS {c}" for c, x in AUDIT.items()]) if table == "audit_log"
                else lib.table(table))
        left_out = F.col(primary_key(table)) % 2 == 0
        for c in DEFAULTS[table]:
            rows = rows.withColumn(c, F.when(~left_out, F.col(c)))
        return apply_defaults(rows, table).select(primary_key(table), *DEFAULTS[table])
    run.__name__ = f"v6_defaults_{table}"
    return run


def _v7(spark: SparkSession, sf_dir: str):
    lib = _lib(spark, sf_dir)
    return delete_books_plan(lib.books.select("book_id"), lib)


_plans: dict = {}


def _v7_part(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = fingerprint(sf_dir, spark)
        hit = _plans.get(key)
        if hit is None or hit[0] is not spark:
            hit = (spark, _v7(spark, sf_dir))
            _plans[key] = hit
        return hit[1][name]
    run.__name__ = f"v7_{name}"
    return run


def _delete(table: str, name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return delete_plan(table, _lib(spark, sf_dir))[name]
    run.__name__ = f"v7_{table}_{name}"
    return run


QUALITY_QUERIES = {
    "v_row_rules": v_row_rules,
    "v2_unique": v2_unique,
    "v3_foreign_keys": v3_foreign_keys,
    "v_row_rules_dirty": _dirty(row_rules),
    "v2_unique_dirty": _dirty(unique_keys),
    "v3_foreign_keys_dirty": _dirty(foreign_keys),
    "v6_loans_with_defaults": v6_loans_with_defaults,
    **{f"v6_defaults_{t}": _defaults(t) for t in DEFAULTS},
    "v7_deleted_books": _v7_part("deleted_books"),
    "v7_deleted_copies": _v7_part("deleted_copies"),
    "v7_blocked": _v7_part("blocked"),
    "v7_authors_blocked": _delete("authors", "blocked"),
    "v7_authors_deleted": _delete("authors", "deleted"),
    "v7_members_blocked": _delete("members", "blocked"),
    "v7_members_deleted": _delete("members", "deleted"),
    "v7_members_registrations": _delete("members", "cascade_event_registrations"),
    "v7_loans_fines": _delete("loans", "cascade_fines"),
    "v7_events_registrations": _delete("lib_events", "cascade_event_registrations"),
}


def _dirty_ctes() -> str:
    """The broken library over the clean one, under the same table names."""
    audit = ", ".join(f"{x} AS {c}" for c, x in AUDIT.items())
    out = f", clean_audit_log AS (SELECT {audit} FROM members)"
    for t in BREAKS:
        source = "clean_audit_log" if t == "audit_log" else t
        replaced = ", ".join(f"{x} AS {c}" for c, x in broken_columns(t).items())
        out += f", dirty_{t} AS (SELECT * FROM {source} UNION ALL SELECT * REPLACE ({replaced}) FROM {source})"
    return out


_NO_AUDIT = """, audit_log AS (
  SELECT CAST(NULL AS BIGINT) AS log_id, '' AS table_name, '' AS action, '' AS changed_by WHERE false)"""


def _clean(sql: str) -> str:
    return with_library(_NO_AUDIT + "\n" + sql.format(p=""))


def _broken(sql: str) -> str:
    return with_library(_dirty_ctes() + "\n" + sql.format(p="dirty_"))


_V7 = """
, v7_lent AS (
  SELECT c.book_id, MAX(CASE WHEN l.status = 'active' THEN 1 ELSE 0 END) AS any_active
  FROM book_copies c JOIN loans l ON c.copy_id = l.copy_id GROUP BY c.book_id)
"""

QUALITY_SQL = {
    "v_row_rules": _clean(ROW_RULE_SQL),
    "v2_unique": _clean(UNIQUE_SQL),
    "v3_foreign_keys": _clean(FOREIGN_KEY_SQL),
    "v_row_rules_dirty": _broken(ROW_RULE_SQL),
    "v2_unique_dirty": _broken(UNIQUE_SQL),
    "v3_foreign_keys_dirty": _broken(FOREIGN_KEY_SQL),
    **{f"v6_defaults_{t}": with_library(sql) for t, sql in DEFAULTS_SQL.items()},
    **{key: with_library(sql) for key, sql in DELETES_SQL.items()},
    "v6_loans_with_defaults": with_library(REQUEST_CTES + W10 + "SELECT *, 'active' AS status FROM w11"),
    "v7_deleted_books": with_library(_V7 + "SELECT book_id FROM books WHERE book_id NOT IN (SELECT book_id FROM v7_lent)"),
    "v7_deleted_copies": with_library(_V7 + """
SELECT copy_id, book_id FROM book_copies WHERE book_id NOT IN (SELECT book_id FROM v7_lent)"""),
    "v7_blocked": with_library(_V7 + """
SELECT book_id, CASE WHEN any_active = 1 THEN 'Cannot delete book: Active loans exist'
                     ELSE 'Cannot delete book: loans reference its copies' END AS reason FROM v7_lent"""),
}
