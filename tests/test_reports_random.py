"""Every report against its DuckDB SQL on random libraries.

The random libraries keep the declared constraints (keys, foreign keys) but
stress the semantics: namesakes (8.4 partitions by name, 7.1 / 7.4 are
DISTINCT), one member with a third of the loans, one address shared by a
third of the members, duplicate titles, NULL paid / payment dates / join
dates / capacities, zero capacities, loans with several fines, copies with
several active loans. Tables are written as Parquet by Spark and read by
DuckDB, so both engines see identical typed inputs.
"""
import datetime as dt
import os
import random
import tempfile
from decimal import Decimal

import duckdb
import pytest

from folio.oracle import reports_sql
from folio.oracle.compare import compare
from folio.plans.registry import REPORTS
from folio.sources.library import TABLES, Library

D = dt.date
AS_OF = D(2001, 6, 30)
EV = D(2024, 1, 17)


def random_library(spark, seed, tied_dates=False):
    rnd = random.Random(seed)
    authors = [(a, f"Author {a % 5}", 1900 + a, None if a % 4 == 0 else "C") for a in range(1, 9)]
    firsts, lasts = ["Ann", "Bo", "Cy"], ["Ng", "Li", "Ode", "Park"]
    members = []
    for m in range(1, 61):
        members.append((m, rnd.choice(firsts), rnd.choice(lasts), f"m{m}@x",
                        None if m % 5 == 0 else f"+{m}",
                        "HOT" if m % 3 == 0 else (None if m % 7 == 0 else f"addr {m % 11}"),
                        None if m % 13 == 0 else AS_OF - dt.timedelta(days=rnd.randint(0, 900)),
                        rnd.choice(["standard", "premium", "student"]),
                        rnd.choice(["active", "active", "active", "suspended", "expired"])))
    books, copies = [], []
    for b in range(1, 41):
        books.append((b, f"Title {b % 17}", rnd.randint(1, 8), f"isbn{b}",
                      None if b % 9 == 0 else rnd.randint(1990, 2010), rnd.choice(["PROMO", "A", "B"]),
                      rnd.randint(1, 4)))
        for n in range(1, (0 if b == 40 else rnd.randint(1, 3)) + 1):
            copies.append((b * 10 + n, b, n, rnd.choice(["excellent", "good", "fair", "poor"]),
                           D(2000, 1, 1) + dt.timedelta(days=rnd.randint(0, 300))))
    loans, fines, fid = [], [], 1
    for lid in range(1, 301):
        member = 1 if lid % 3 == 0 else rnd.randint(1, 60)
        ld = AS_OF - dt.timedelta(days=0 if tied_dates and lid % 4 else rnd.randint(0, 150))
        status = rnd.choice(["active", "active", "returned", "lost"])
        ret = min(AS_OF, ld + dt.timedelta(days=rnd.randint(1, 30))) if status == "returned" else None
        loans.append((lid, member, rnd.choice(copies)[0], ld, ld + dt.timedelta(days=14), ret, status))
        for _ in range(rnd.choice([0, 0, 1, 2])):
            paid = rnd.choice([True, False, False, None])
            fines.append((fid, lid, Decimal(rnd.randint(1, 2000)) / 100 if rnd.random() > 0.1 else Decimal("5.00"),
                          rnd.choice(["overdue", "damage", "lost"]), paid,
                          (ld + dt.timedelta(days=rnd.randint(1, 40))) if paid and rnd.random() > 0.2 else None))
            fid += 1
    events = [(e, f"Event {e}", EV + dt.timedelta(days=rnd.randint(-10, 40)),
               rnd.choice(["book_club", "workshop", "reading_program", "author_visit"]),
               rnd.choice([None, 0, 10, 25])) for e in range(1, 13)]
    regs, seen, rid = [], set(), 1
    for _ in range(150):
        pair = (rnd.randint(1, 12), rnd.randint(1, 60))
        if pair in seen:
            continue
        seen.add(pair)
        regs.append((rid, pair[0], pair[1], EV - dt.timedelta(days=rnd.randint(0, 20))))
        rid += 1
    fines = [(f, l, a.quantize(Decimal("0.01")), r, p, d) for f, l, a, r, p, d in fines]
    return Library.from_rows(spark, authors=authors, members=members, books=books, book_copies=copies,
                             loans=loans, fines=fines, lib_events=events, event_registrations=regs)


@pytest.fixture(scope="module", params=[11, 12])
def stored(request, spark):
    lib = random_library(spark, request.param)
    path = tempfile.mkdtemp(prefix="folio-random-lib-")
    lib.write_parquet(path)
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(path, name)}/*.parquet')")
    return Library.from_parquet(spark, path), con


def statement(key):
    """The report's SQL over the tables themselves, without their derivation."""
    body = reports_sql._SQL[key].strip()
    return ("WITH _unused AS (SELECT 1) " + body) if body.startswith(",") else body


@pytest.mark.parametrize("key", sorted(REPORTS))
def test_report_matches_sql_on_random_library(stored, key):
    lib, con = stored
    result = compare(key, REPORTS[key](lib), con, statement(key))
    assert result.ok, result.detail


@pytest.mark.parametrize("seed", [21, 22])
def test_activity_log_with_most_loans_on_one_date(spark, seed):
    """7.2 when three quarters of all loans share the newest date."""
    lib = random_library(spark, seed, tied_dates=True)
    path = tempfile.mkdtemp(prefix="folio-tied-lib-")
    lib.write_parquet(path)
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(path, name)}/*.parquet')")
    stored = Library.from_parquet(spark, path)
    for key in ("q7_2_activity_log", "q5_1_loan_history"):
        result = compare(key, REPORTS[key](stored), con, statement(key))
        assert result.ok, result.detail
