"""Declared constraints of the schema, re-aimed as data-quality jobs (V1-V7).

The rules are data (taken from the table definitions); the jobs turn them
into DataFrame checks that return one row per check:
``rule, table_name, check_name, violations``.

* row rules (V1 NOT NULL, V4 ENUM domain, V5 CHECK and VARCHAR length) are
  evaluated together in one aggregate pass per table;
* V2 unique keys: key values occurring more than once (NULL keys exempt);
* V3 foreign keys: child rows whose key is missing from the parent (anti join);
* V6 column defaults are applied to new rows;
* V7 delete plans: ON DELETE CASCADE collects dependants, RESTRICT blocks
  (``delete_plan`` follows ``FOREIGN_KEYS`` for any table).
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.config import AS_OF
from folio.jobs import messages as msg
from folio.operators.skew import q
from folio.sources.library import Library

# The constraints of the table definitions.
NOT_NULL = {
    "authors": ["author_id", "author_name"],
    "members": ["member_id", "first_name", "last_name", "email"],
    "lib_events": ["event_id", "event_name", "event_date", "event_type"],
    "books": ["book_id", "title", "author_id", "isbn", "genre"],
    "book_copies": ["copy_id", "book_id", "copy_number"],
    "loans": ["loan_id", "member_id", "copy_id", "loan_date", "due_date"],
    "fines": ["fine_id", "loan_id", "fine_amount", "fine_reason"],
    "event_registrations": ["registration_id", "event_id", "member_id"],
    "audit_log": ["log_id"],
}
DOMAINS = {
    ("members", "membership_type"): ["standard", "premium", "student"],
    ("members", "status"): ["active", "suspended", "expired"],
    ("lib_events", "event_type"): ["book_club", "workshop", "reading_program", "author_visit"],
    ("audit_log", "action"): ["INSERT", "UPDATE", "DELETE"],
    ("book_copies", "condition_status"): ["excellent", "good", "fair", "poor"],
    ("loans", "status"): ["active", "returned", "lost"],
    ("fines", "fine_reason"): ["overdue", "damage", "lost"],
}
LENGTHS = {
    ("authors", "author_name"): 100, ("authors", "country"): 50,
    ("members", "first_name"): 50, ("members", "last_name"): 50, ("members", "email"): 100,
    ("members", "phone"): 20, ("members", "address"): 200,
    ("lib_events", "event_name"): 100,
    ("audit_log", "table_name"): 50, ("audit_log", "changed_by"): 50,
    ("books", "title"): 200, ("books", "isbn"): 20, ("books", "genre"): 50,
}
CHECKS = {
    ("books", "total_copies > 0"): ("total_copies", ">", 0),
    ("fines", "fine_amount >= 0"): ("fine_amount", ">=", 0),
}
UNIQUE = [
    ("authors", ["author_id"]), ("members", ["member_id"]), ("members", ["email"]),
    ("lib_events", ["event_id"]), ("audit_log", ["log_id"]), ("books", ["book_id"]), ("books", ["isbn"]),
    ("book_copies", ["copy_id"]), ("book_copies", ["book_id", "copy_number"]), ("loans", ["loan_id"]),
    ("fines", ["fine_id"]), ("event_registrations", ["registration_id"]),
    ("event_registrations", ["event_id", "member_id"]),
]
FOREIGN_KEYS = [
    ("books", "author_id", "authors", "author_id", "RESTRICT"),
    ("book_copies", "book_id", "books", "book_id", "CASCADE"),
    ("loans", "member_id", "members", "member_id", "RESTRICT"),
    ("loans", "copy_id", "book_copies", "copy_id", "RESTRICT"),
    ("fines", "loan_id", "loans", "loan_id", "CASCADE"),
    ("event_registrations", "event_id", "lib_events", "event_id", "CASCADE"),
    ("event_registrations", "member_id", "members", "member_id", "CASCADE"),
]
DEFAULTS = {
    "members": {"membership_type": "standard", "status": "active", "join_date": "AS_OF"},
    "audit_log": {"changed_at": "AS_OF", "changed_by": "SYSTEM"},
    "books": {"total_copies": 1},
    "book_copies": {"condition_status": "good"},
    "loans": {"status": "active"},
    "fines": {"paid": False},
    "event_registrations": {"registration_date": "AS_OF"},
}

def _sql_lit(v) -> str:
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def row_rule_checks(table: str) -> list[tuple[str, str, str]]:
    """(rule, check_name, violation predicate as a SQL expression) of the row
    rules of a table; NULL passes domain, check and length rules."""
    out = [("not_null", c, f"`{c}` IS NULL") for c in NOT_NULL.get(table, [])]
    out += [("domain", c, f"`{c}` IS NOT NULL AND `{c}` NOT IN ({', '.join(_sql_lit(v) for v in values)})")
            for (t, c), values in DOMAINS.items() if t == table]
    out += [("check", name, f"NOT (`{col}` {op} {_sql_lit(v)})")
            for (t, name), (col, op, v) in CHECKS.items() if t == table]
    out += [("length", c, f"length(`{c}`) > {n}") for (t, c), n in LENGTHS.items() if t == table]
    return out


def row_rules(lib: Library, tables: list[str] | None = None) -> DataFrame:
    """V1, V4, V5: one aggregate pass per table, one output row per check."""
    parts = []
    for table in tables or list(NOT_NULL):
        checks = row_rule_checks(table)
        if not checks:
            continue
        counts = lib.table(table).agg(*[F.expr(f"count_if(coalesce({pred}, false)) AS c{i}")
                                        for i, (_, _, pred) in enumerate(checks)])
        cells = ", ".join(f"struct({_sql_lit(rule)} AS rule, {_sql_lit(table)} AS table_name, "
                          f"{_sql_lit(name)} AS check_name, c{i} AS violations)"
                          for i, (rule, name, _) in enumerate(checks))
        parts.append(counts.select(F.expr(f"inline(array({cells}))")))
    return reduce(DataFrame.unionByName, parts)


def _report_row(df: DataFrame, rule: str, table: str, check: str) -> DataFrame:
    return df.selectExpr(f"{_sql_lit(rule)} AS rule", f"{_sql_lit(table)} AS table_name",
                         f"{_sql_lit(check)} AS check_name", "violations")


def unique_keys(lib: Library, tables: list[str] | None = None) -> DataFrame:
    """V2: per unique key, the number of key values that occur more than once."""
    parts = []
    for table, keys in UNIQUE:
        if tables and table not in tables:
            continue
        not_null = " AND ".join(f"{q(k)} IS NOT NULL" for k in keys)
        dupes = (lib.table(table).where(not_null).groupBy(*keys).agg(F.expr("count(1) AS _c")).where("_c > 1")
                 .agg(F.expr("count(1) AS violations")))
        parts.append(_report_row(dupes, "unique", table, ",".join(keys)))
    return reduce(DataFrame.unionByName, parts)


def foreign_keys(lib: Library) -> DataFrame:
    """V3: child rows whose (non-NULL) key has no parent row."""
    parts = []
    for child, ck, parent, pk, _ in FOREIGN_KEYS:
        parents = lib.table(parent).selectExpr(f"{q(pk)} AS {q(ck)}")
        orphans = (lib.table(child).select(ck).where(f"{q(ck)} IS NOT NULL").join(parents, ck, "left_anti")
                   .agg(F.expr("count(1) AS violations")))
        parts.append(_report_row(orphans, "foreign_key", child, f"{ck}->{parent}.{pk}"))
    return reduce(DataFrame.unionByName, parts)


def apply_defaults(df: DataFrame, table: str, as_of: _dt.date = AS_OF) -> DataFrame:
    """V6: fill the declared default into NULL or missing columns of new rows."""
    out = df
    for col, value in DEFAULTS.get(table, {}).items():
        default = F.lit(as_of) if value == "AS_OF" else F.lit(value)
        if col == "changed_at":
            default = default.cast("timestamp")
        out = out.withColumn(col, F.coalesce(F.col(col), default) if col in out.columns else default)
    return out


PRIMARY_KEYS = {keys[0]: t for t, keys in reversed(UNIQUE) if len(keys) == 1 and keys[0].endswith("_id")}


def primary_key(table: str) -> str:
    return next(k for k, t in PRIMARY_KEYS.items() if t == table)


def delete_plan(table: str, lib: Library) -> dict[str, DataFrame]:
    """V7 for deleting rows of any table (here: every row is asked to go).

    A row that a RESTRICT child refers to, directly or through rows that
    CASCADE would delete with it, is blocked. Returns ``blocked`` (id),
    ``deleted`` (id) and, per dependent table that CASCADE reaches, the rows
    that go with the deleted ones (``cascade_<table>``: root id, row id)."""
    root = primary_key(table)
    ids = lib.table(table).select(F.col(root).alias("root"))
    blocked, cascades = [], {}

    def follow(parent: str, reached: DataFrame) -> None:
        for child, ck, to, _, action in FOREIGN_KEYS:
            if to != parent:
                continue
            if action == "RESTRICT":
                used = lib.table(child).select(F.col(ck).alias("key")).distinct()
                blocked.append(reached.join(used, "key", "left_semi").select("root"))
            else:
                rows = (lib.table(child).select(F.col(ck).alias("key"), F.col(primary_key(child)).alias("row"))
                        .join(reached, "key").select("root", "row"))
                cascades[child] = rows
                follow(child, rows.withColumnRenamed("row", "key"))

    follow(table, ids.withColumn("key", F.col("root")))
    stuck = reduce(DataFrame.unionByName, blocked).distinct() if blocked else ids.limit(0)
    out = {"blocked": stuck.select(F.col("root").alias(root)),
           "deleted": ids.join(stuck, "root", "left_anti").select(F.col("root").alias(root))}
    for child, rows in cascades.items():
        out[f"cascade_{child}"] = (rows.join(stuck, "root", "left_anti")
                                   .select(F.col("root").alias(root), F.col("row").alias(primary_key(child))))
    return out


def delete_books_plan(book_ids: DataFrame, lib: Library) -> dict[str, DataFrame]:
    """V7 for deleting books: the W14 trigger blocks books with an active loan;
    ON DELETE CASCADE would remove their copies, but loans reference copies
    with RESTRICT, so a book whose copies were ever lent cannot be deleted.
    Returns deleted_books, deleted_copies (the cascade) and blocked (reason)."""
    ids = book_ids.select("book_id").distinct().join(lib.books.select("book_id"), "book_id", "left_semi")
    copies = lib.book_copies.select("copy_id", "book_id").join(ids, "book_id", "left_semi")
    lent = copies.join(lib.loans.select("copy_id", "status"), "copy_id")
    per_book = lent.groupBy("book_id").agg(F.max(F.col("status") == "active").alias("_active"))
    blocked = per_book.select(
        "book_id", F.when(F.col("_active"), msg.BOOK_DELETE_BLOCKED)
        .otherwise("Cannot delete book: loans reference its copies").alias("reason"))
    deleted_books = ids.join(per_book, "book_id", "left_anti")
    deleted_copies = copies.join(deleted_books, "book_id", "left_semi")
    return {"deleted_books": deleted_books, "deleted_copies": deleted_copies, "blocked": blocked}
