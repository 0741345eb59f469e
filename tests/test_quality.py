"""Data-quality jobs: each rule broken once by a dirty row."""
import datetime as dt
from decimal import Decimal

from conftest import rows
from folio.quality.rules import apply_defaults, delete_books_plan, foreign_keys, row_rules, unique_keys
from folio.sources.library import Library

D = dt.date


def dirty(spark):
    return Library.from_rows(
        spark,
        authors=[(1, "A" * 101, None, None)],                                    # length
        members=[(1, "Ada", "Lane", "same@x", None, None, D(2000, 1, 1), "gold", "active"),   # domain
                 (2, "Ben", "Moss", "same@x", None, None, D(2000, 1, 1), "standard", None)],  # unique email
        books=[(10, "T", 1, "i10", 2000, "G", 0), (20, "U", 7, "i20", 2000, "G", 1)],        # check, FK
        book_copies=[(101, 10, 1, "good", None), (201, 20, 1, "good", None)],
        loans=[(1, 9, 101, D(2001, 1, 1), D(2001, 1, 15), None, "active"),               # FK member
               (2, 1, 201, D(2001, 1, 1), D(2001, 1, 15), D(2001, 1, 9), "returned")],
        fines=[(1, 1, Decimal("-1.00"), "overdue", False, None)],                        # check
    )


def violations(df):
    return {(r[0], r[1], r[2]): r[3] for r in rows(df) if r[3]}


def test_row_rules(spark):
    got = violations(row_rules(dirty(spark)))
    assert got == {("length", "authors", "author_name"): 1, ("domain", "members", "membership_type"): 1,
                   ("check", "books", "total_copies > 0"): 1, ("check", "fines", "fine_amount >= 0"): 1}


def test_unique_and_foreign_keys(spark):
    lib = dirty(spark)
    assert violations(unique_keys(lib)) == {("unique", "members", "email"): 1}
    assert violations(foreign_keys(lib)) == {("foreign_key", "books", "author_id->authors.author_id"): 1,
                                             ("foreign_key", "loans", "member_id->members.member_id"): 1}


def test_defaults(spark):
    new = spark.createDataFrame([(7, "X", "Y", "z@x", None)], "member_id long, first_name string, "
                                "last_name string, email string, status string")
    out = rows(apply_defaults(new, "members", D(2001, 6, 30)), "status", "membership_type", "join_date")
    assert out == [("active", "standard", D(2001, 6, 30))]


def test_delete_plan(spark):
    lib = dirty(spark)
    plan = delete_books_plan(spark.createDataFrame([(10,), (20,), (30,)], "book_id long"), lib)
    assert sorted(rows(plan["blocked"])) == [(10, "Cannot delete book: Active loans exist"),
                                             (20, "Cannot delete book: loans reference its copies")]
    assert rows(plan["deleted_books"]) == []
