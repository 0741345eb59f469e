"""A library in which every declared rule is broken.

Each table holds all its rows, and all of them once more with one column
broken: which one follows from the row's key, so every break is as frequent
as the next. The copies repeat the other columns, so unique keys break as
well. The audit log is derived from the members.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folio.quality.rules import primary_key
from folio.sources.library import Library

_LONG = "repeat('x', 300)"
_NO_ONE = "CAST(-5 AS BIGINT)"

#: Per table the breaks: column and the value it gets (SQL that Spark and DuckDB read alike).
BREAKS = {
    "authors": [("author_id", "NULL"), ("author_name", "NULL"), ("author_name", _LONG), ("country", _LONG)],
    "members": [("member_id", "NULL"), ("first_name", "NULL"), ("last_name", "NULL"), ("email", "NULL"), ("first_name", _LONG),
                ("last_name", _LONG), ("email", _LONG), ("phone", _LONG), ("address", _LONG), ("membership_type", "'unknown'"),
                ("status", "'unknown'")],
    "lib_events": [("event_id", "NULL"), ("event_name", "NULL"), ("event_date", "NULL"), ("event_type", "NULL"),
                   ("event_name", _LONG), ("event_type", "'unknown'")],
    "books": [("book_id", "NULL"), ("title", "NULL"), ("author_id", "NULL"), ("isbn", "NULL"), ("genre", "NULL"), ("title", _LONG),
              ("isbn", _LONG), ("genre", _LONG), ("total_copies", "0"), ("author_id", _NO_ONE)],
    "book_copies": [("copy_id", "NULL"), ("book_id", "NULL"), ("copy_number", "NULL"), ("condition_status", "'unknown'"), ("book_id", _NO_ONE)],
    "loans": [("loan_id", "NULL"), ("member_id", "NULL"), ("copy_id", "NULL"), ("loan_date", "NULL"), ("due_date", "NULL"),
              ("status", "'unknown'"), ("member_id", _NO_ONE), ("copy_id", _NO_ONE)],
    "fines": [("fine_id", "NULL"), ("loan_id", "NULL"), ("fine_amount", "NULL"), ("fine_reason", "NULL"), ("fine_reason", "'unknown'"),
              ("fine_amount", "CAST(-1 AS DECIMAL(10,2))"), ("loan_id", _NO_ONE)],
    "event_registrations": [("registration_id", "NULL"), ("event_id", "NULL"), ("member_id", "NULL"), ("event_id", _NO_ONE),
                            ("member_id", _NO_ONE)],
    "audit_log": [("log_id", "NULL"), ("action", "'unknown'"), ("table_name", _LONG), ("changed_by", _LONG)],
}

#: The key that chooses a row's break, where the primary key leaves out some.
CHOICE = {"book_copies": "book_id + copy_number"}

#: The audit log's columns over the members.
AUDIT = {"log_id": "member_id", "table_name": "'members'", "action": "'UPDATE'", "record_id": "member_id",
         "changed_at": "CAST('2001-06-30' AS TIMESTAMP)", "changed_by": "'SYSTEM'", "description": "email"}


def broken_columns(table: str) -> dict[str, str]:
    """SQL of the columns that differ in a table's broken copies."""
    breaks, choice = BREAKS[table], CHOICE.get(table, primary_key(table))
    cases: dict[str, str] = {}
    for i, (column, value) in enumerate(breaks):
        cases[column] = cases.get(column, "") + f" WHEN {i} THEN {value}"
    return {c: f"CASE CAST(({choice}) % {len(breaks)} AS INT){when} ELSE {c} END" for c, when in cases.items()}


def dirty_library(spark: SparkSession, lib: Library) -> Library:
    tables: dict[str, DataFrame] = {t: lib.table(t) for t in BREAKS if t != "audit_log"}
    tables["audit_log"] = lib.members.selectExpr(*[f"{x} AS {c}" for c, x in AUDIT.items()])
    for name, rows in tables.items():
        broken = broken_columns(name)
        tables[name] = rows.unionByName(rows.selectExpr(*[f"{broken.get(c, c)} AS {c}" for c in rows.columns]))
    return Library.from_frames(spark, **tables)
